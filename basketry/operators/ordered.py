"""Per-key order operators that survive a hot key.

First-row and mode are plain aggregates with map-side combine. Lag and running
total split every key by calendar bucket: rows are ordered inside
(key, bucket), and one summary row per (key, bucket) carries the state of the
earlier buckets across. No task ever holds more than one bucket of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "__bucket"
_SLOT = "__slot"
BLOCK = 64


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], copies: str | None = None,
                  numbered: str | None = None) -> DataFrame:
    """Keep the row that sorts first in each key group (remaining columns break ties).

    ``copies`` names a column with the number of rows of the group. ``numbered`` names the key that numbers
    the rows of the other keys: BLOCK neighbours of these then come out side by side, so that a sum over
    them is combined before it moves, while a key with very many numbers still spreads over its blocks.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    by = list(keys)
    if numbered:
        by.append("__block")
        df = df.withColumn("__block", F.floor(F.col(numbered) / BLOCK)).repartition(
            *[k for k in keys if k != numbered], "__block")
    picked = df.groupBy(*by).agg(F.min(F.struct(*order, *rest)).alias("__row"), F.count("*").alias("__n"))
    return picked.select(*[c if c in keys else F.col(f"__row.{c}") for c in df.columns if c != "__block"],
                         *([F.col("__n").alias(copies)] if copies else []))


def group_mode(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent non-null value per group; the smallest on ties."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("__best")).select(*keys, F.col("__best.v").alias(name))


def _with_bucket(df: DataFrame, time: str, unit: str) -> DataFrame:
    return df.withColumn(_BUCKET, F.date_trunc(unit, F.col(time)))


def _carry(df: DataFrame, key: str, summary: DataFrame) -> DataFrame:
    """Attach the per-bucket state to the rows; the row side keeps its partitioning."""
    state = summary.withColumnsRenamed({key: "__k", _BUCKET: "__b"})
    return df.join(
        state, df[key].eqNullSafe(state["__k"]) & df[_BUCKET].eqNullSafe(state["__b"]), "left"
    ).drop("__k", "__b")


def lag_in_key(df: DataFrame, key: str, order: Sequence[str], value: str, name: str,
               unit: str = "day") -> DataFrame:
    """``value`` of the previous row of the key; ``order[0]`` is the event time."""
    rows = _with_bucket(df, order[0], unit)
    inside = Window.partitionBy(key, _BUCKET).orderBy(*order)
    across = Window.partitionBy(key).orderBy(_BUCKET)
    last = F.max_by(F.col(value), F.struct(*order))
    summary = (rows.groupBy(key, _BUCKET).agg(last.alias("__last"))
               .select(key, _BUCKET, F.lag("__last").over(across).alias("__carried")))
    lagged = rows.withColumn("__lag", F.lag(value).over(inside)).withColumn(
        "__at", F.row_number().over(inside))
    out = _carry(lagged, key, summary)
    return out.withColumn(
        name, F.when(F.col("__at") == 1, F.col("__carried")).otherwise(F.col("__lag"))
    ).drop("__lag", "__at", "__carried", _BUCKET)


def running_total(df: DataFrame, key: str, order: Sequence[str], value: str, name: str,
                  unit: str = "day") -> DataFrame:
    """Sum of ``value`` over the key's rows up to and including this one."""
    rows = _with_bucket(df, order[0], unit)
    inside = (Window.partitionBy(key, _BUCKET).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = (Window.partitionBy(key).orderBy(_BUCKET)
              .rowsBetween(Window.unboundedPreceding, -1))
    summary = (rows.groupBy(key, _BUCKET).agg(F.sum(value).alias("__sum"))
               .select(key, _BUCKET, F.sum("__sum").over(before).alias("__carried")))
    out = _carry(rows.withColumn("__run", F.sum(value).over(inside)), key, summary)
    return out.withColumn(
        name, F.col("__run") + F.coalesce("__carried", F.lit(0))
    ).drop("__run", "__carried", _BUCKET)


def order_history(df: DataFrame, key: str, time: str, tie: str, unit: str = "hour") -> DataFrame:
    """Add first time, previous time and sequence number of each row within its key.

    One bucketed pass serves all three. Buckets are short, so a key (or the null key) with a large share
    of all rows is spread over its hours. Key and bucket are one struct, never null itself, so that the
    rows move once for their order, their summary and the join with the state of the earlier buckets.
    """
    slot, bucket = F.col(_SLOT), F.date_trunc(unit, F.col(time))
    rows = df.withColumn(_SLOT, F.struct(F.col(key).alias("key"), bucket.alias("bucket"))).drop(key).repartition(slot)
    inside = Window.partitionBy(_SLOT).orderBy(time, tie)
    across = Window.partitionBy(slot["key"]).orderBy(slot["bucket"])
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.struct(time, tie))[time]  # the tie is read here too, or the summary would move rows of its own
    state = (
        rows.groupBy(_SLOT).agg(F.count("*").alias("__n"), F.min(time).alias("__min"), last.alias("__max"))
        .select(slot.alias("__s"), F.sum("__n").over(before).alias("__earlier"),
                F.min("__min").over(across).alias("__first"),
                F.lag("__max").over(across).alias("__carried")))
    ranked = rows.withColumn("__at", F.row_number().over(inside)).withColumn(
        "__lag", F.lag(time).over(inside))
    return ranked.join(state, ranked[_SLOT] == state["__s"], "left").select(
        *[slot["key"].alias(c) if c == key else F.col(c) for c in df.columns],
        F.col("__first").alias("first_at"),
        F.when(F.col("__at") == 1, F.col("__carried")).otherwise(F.col("__lag")).alias("previous_at"),
        (F.col("__at") + F.coalesce("__earlier", F.lit(0))).alias("sequence_no"))
