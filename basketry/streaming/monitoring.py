"""Monitoring of arriving scored orders: rolling error, drift against stored bins, retraining triggers.

``rolling_error`` and ``period_psi`` are plans for batch and streaming frames. On a stream they give a day or
a period once the watermark has passed its end; state is bounded by the periods still open. On a batch frame
all of them are closed. Rows without a time, and on a stream rows later than the watermark, do not count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry import fixed_values as fv
from basketry.operators.quantile import unpivot
from basketry.plans.drift import psi_against


def _timed(df: DataFrame, time: str, lateness: str) -> DataFrame:
    return df.withColumn("at", F.col(time).cast("timestamp")).withWatermark("at", lateness)


def rolling_error(scored: DataFrame, time: str, truth: str, predicted: str, days: int = 7,
                  limit: float = fv.WAPE_THRESHOLD, lateness: str = "1 day") -> DataFrame:
    """(day, wape_pct, breach) as ``metrics.rolling_wape``, by two chained event-time windows.

    Orders fold to days; only the sums of closed days slide through the wide window. Days without orders
    have no row. A window whose true values add up to 0 has neither a ratio nor a breach.
    """
    rows = _timed(scored, time, lateness).select(
        "at", F.abs(F.col(truth) - F.col(predicted)).alias("error"), F.abs(F.col(truth)).alias("value"))
    daily = rows.groupBy(F.window("at", "1 day").alias("day")).agg(
        F.sum("error").alias("error"), F.sum("value").alias("value"))
    closed = daily.select(F.window_time("day").alias("ended"), "error", "value")
    rolled = closed.groupBy(F.window("ended", f"{days} days", "1 day").alias("span")).agg(
        F.sum("error").alias("error"), F.sum("value").alias("value"), F.max("ended").alias("newest"))
    last_day = F.col("span.end") - F.expr("INTERVAL 1 DAY")
    wape = F.try_divide("error", "value") * 100
    return rolled.where(F.col("newest") >= last_day).select(
        F.to_date(last_day).alias("day"), wape.alias("wape_pct"),
        F.coalesce(wape > limit, F.lit(False)).alias("breach"))


def period_psi(rows: DataFrame, time: str, features: Sequence[str], reference: DataFrame, period: str = "1 day",
               limit: float = fv.PSI_THRESHOLD, lateness: str = "1 day") -> DataFrame:
    """(period, feature, n, psi, breach): each period of event time against ``drift.reference_bins``.

    ``period`` is a fixed length ("1 day", "7 days"), counted from 1970-01-01; the column holds its first
    day. State is one row of bin counts per open period and feature.
    """
    long = unpivot(rows.withColumn("at", F.col(time).cast("timestamp")), features, ["at"])
    spans = long.withWatermark("at", lateness).withColumn("span", F.window("at", period))
    found = psi_against(spans, reference, ["span"])
    return found.select(F.to_date("span.start").alias("period"), "feature", "n", "psi",
                        (F.col("psi") > limit).alias("breach"))


def batch_psi(batch: DataFrame, features: Sequence[str], reference: DataFrame,
              limit: float = fv.PSI_THRESHOLD) -> DataFrame:
    """(feature, n, psi, breach) of one micro-batch: an early sign, as noisy as the batch is short."""
    found = psi_against(unpivot(batch, features), reference)
    return found.withColumn("breach", F.col("psi") > limit)


def write_with_triggers(found: DataFrame, subject: Column, value: str, source: str, out: str, checkpoint: str,
                        per_batch: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Write rows with a ``breach`` to ``out/source`` and one trigger row for each breach to ``out/triggers``.

    Drains what has arrived. A batch always overwrites its own folders, so a replay after a failure leaves
    the same files and no trigger twice. ``per_batch`` turns a batch into the rows first.
    """
    def write(batch: DataFrame, number: int) -> None:
        rows = (per_batch(batch) if per_batch else batch).persist()  # read for both outputs
        try:
            rows.write.mode("overwrite").parquet(f"{out}/{source}/batch={number}")
            triggers = rows.where("breach").select(
                F.lit(source).alias("reason"), subject.alias("subject"), F.col(value).alias("value"))
            triggers.write.mode("overwrite").parquet(f"{out}/triggers/source={source}/batch={number}")
        finally:
            rows.unpersist()
    return (found.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", f"{checkpoint}/{source}").trigger(availableNow=True).start())


def monitor(scored: DataFrame, time: str, truth: str, predicted: str, features: Sequence[str], reference: DataFrame,
            out: str, checkpoint: str, period: str = "1 day", lateness: str = "1 day") -> list[StreamingQuery]:
    """Start the three watches over a stream of scored orders: ``error``, ``drift`` by period, ``batch`` drift.

    Their rows go to folders of these names in ``out``; whoever retrains reads ``out/triggers``.
    """
    error = rolling_error(scored, time, truth, predicted, lateness=lateness)
    drift = period_psi(scored, time, features, reference, period, lateness=lateness)
    where = F.concat_ws(" ", F.col("period").cast("string"), F.col("feature"))
    return [write_with_triggers(error, F.col("day").cast("string"), "wape_pct", "error", out, checkpoint),
            write_with_triggers(drift, where, "psi", "drift", out, checkpoint),
            write_with_triggers(scored, F.col("feature"), "psi", "batch", out, checkpoint,
                                lambda rows: batch_psi(rows, features, reference))]
