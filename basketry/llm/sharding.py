"""Contiguous shards of equal bytes from global prefix sums.

Rows in key order fall into ranges; the bytes of each range are summed, a running sum over the ranges
gives where each range starts, and a running sum inside the range gives where each row starts. The row
goes to the shard in which its middle byte falls, so shards are contiguous in the order and differ from
an equal cut by less than one row at each border. Only built-in functions run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.ordering import RANGE, key_ranges

SHARDS = 8


def shard_by_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Add size, text_crc32, shard and slot to every document (other columns stay, but for equal names).

    Size is the text's UTF-8 bytes plus 1 (a null text has none, so size 1 and checksum 0). The order is
    key (nulls first), then checksum, then size; rows equal in all three are interchangeable. Slots count
    from 0 in each shard without gaps. Fewer rows than shards leave some shards empty; an empty table
    gives an empty result.
    """
    others = [c for c in docs.columns if c not in {"size", "text_crc32", "shard", "slot"}]
    ranges = key_ranges(docs.select(key), key)
    sized = docs.select(*others, (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0).cast("long")).alias("text_crc32"),
                        ranges.of(F.col(key)).alias(RANGE))
    # One row for each range; the only window without a key runs over these.
    totals = sized.groupBy(RANGE).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(RANGE, F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("__from"),
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__rows"),
                           F.sum("bytes").over(Window.partitionBy()).alias("__all"))
    order = [F.col(key).asc_nulls_first(), "text_crc32", "size"]
    inside = Window.partitionBy(RANGE).orderBy(*order)
    placed = sized.join(F.broadcast(starts), RANGE).select(  # a row for each range
        *others, "size", "text_crc32",
        (F.col("__rows") + F.row_number().over(inside) - 1).alias("__row"),
        (2 * (F.col("__from") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))) - F.col("size"))
        .alias("__twice_middle"), "__all", RANGE)
    placed = placed.withColumn("shard", F.expr(f"({shards} * __twice_middle) div (2 * __all)").cast("int"))
    # The first row of each shard: the least row number there, from one row for each range and shard.
    firsts = placed.groupBy("shard").agg(F.min("__row").alias("__first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        *others, "size", "text_crc32", "shard", (F.col("__row") - F.col("__first")).alias("slot"))
