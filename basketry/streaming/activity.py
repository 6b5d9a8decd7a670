"""Session activity rollup over arriving events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def delivered_once(events: DataFrame, event_id: str = "activity_id", lateness: str = "1 hour") -> DataFrame:
    """Timed events, each id once; adds the event time ``at`` with its watermark.

    Of a repeated id the first to arrive stays; an event without an id is repeated if all its columns are.
    Ids are remembered until the watermark has passed their event, and a repeat after that is late itself, so
    state is bounded and no repeat gets through. Events without a time belong to no session and are left out.
    """
    nameless = F.when(F.col(event_id).isNull(), F.sha2(F.to_json(F.struct(*events.columns)), 256))
    timed = (events.withColumns({"at": F.col("activity_timestamp").cast("timestamp"), "__nameless": nameless})
             .where(F.col("at").isNotNull()).withWatermark("at", lateness))
    keys = [event_id, "__nameless"]
    once = timed.dropDuplicatesWithinWatermark(keys) if events.isStreaming else timed.dropDuplicates(keys)
    return once.drop("__nameless")


def session_rollup(events: DataFrame, gap: str = "12 hours", lateness: str = "1 hour",
                   event_id: str = "activity_id") -> DataFrame:
    """Activity measures per user session; a session closes ``gap`` after its last event.

    Repeated events count once. Events later than the watermark are dropped, so state is bounded by the
    sessions still open; ``drain`` counts them. Works on batch and streaming frames.
    """
    def of(kind: str):
        return F.count_if(F.col("activity_type") == kind)
    return (delivered_once(events, event_id, lateness)
            .groupBy(F.session_window("at", gap).alias("session"), "customer_id")
            .agg(F.count("*").alias("n_events"), of("product_view").alias("n_product_views"),
                 of("search").alias("n_searches"), of("add_to_cart").alias("n_add_to_cart"),
                 F.sum("add_to_cart_quantity").alias("total_cart_qty"),
                 (F.sum("scroll_percent") / F.count("scroll_percent")).alias("avg_scroll"),
                 (F.sum("duration_seconds") / F.count("duration_seconds")).alias("avg_page_duration"))
            .select("customer_id", F.col("session.start").alias("session_start"),
                    F.col("session.end").alias("closes_at"), "n_events", "n_product_views",
                    "n_searches", "n_add_to_cart", "total_cart_qty", "avg_scroll", "avg_page_duration"))


def write_rollup(rollup: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed sessions to parquet, draining what has arrived."""
    return (rollup.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


DELIVERY = "batch long, watermark string, n_input long, n_late long, n_repeated long"


def drain(spark: SparkSession, query: StreamingQuery, path: str) -> None:
    """Wait until a query has drained what had arrived, and count what it did not take.

    One row for each batch goes to ``path``: rows read, rows later than the watermark, and repeated rows. The
    counts are those of the stateful operators and are written when the query ends, so a run whose driver
    dies leaves none; its batches show as a gap in the batch numbers.
    """
    seen: dict[int, tuple] = {}
    done = False
    while not done:
        done = query.awaitTermination(2)
        for progress in query.recentProgress:
            operators = progress["stateOperators"]
            found = (progress["batchId"], progress["eventTime"].get("watermark"), progress["numInputRows"],
                     sum(o["numRowsDroppedByWatermark"] for o in operators),
                     sum(o["customMetrics"].get("numDroppedDuplicateRows", 0) for o in operators))
            # A trigger without work reports its batch number again, with nothing in it.
            seen[found[0]] = max(seen.get(found[0], found), found, key=lambda row: row[2:])
    rows = spark.createDataFrame(sorted(seen.values()), DELIVERY)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={query.runId}")
