"""As-of totals: what was known of a key strictly before a point in time.

Events and questions fold to one row for each (key, time), so repeats never meet. Days of a key carry
running totals across as one row a day, and inside a day only that day's distinct times are ordered: a key
with a large share of all rows is spread over its days. Nothing is joined by range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def totals_before(events: DataFrame, questions: DataFrame, key: str, time: str, sums: Sequence[str],
                  unit: str = "day") -> DataFrame:
    """Add to every question the sums over the events of its key at strictly earlier times.

    ``sums`` are numeric columns of the events (null adds nothing); columns of the questions with these
    names are replaced. Without earlier events the sums are 0, and so they are for a question without key
    or time. Events without key or time are never before anything. Questions are neither lost nor repeated.
    """
    sums = list(sums)
    kinds = {c: events.agg(F.sum(c)).schema[0].dataType for c in sums}
    known = lambda df: df.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    happened = known(events).select(F.col(key).alias("__key"), F.col(time).alias("__time"), *sums)
    asked = known(questions).select(F.col(key).alias("__key"), F.col(time).alias("__time"),
                                    *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in sums])
    points = happened.unionByName(asked).groupBy("__key", "__time").agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast(kinds[c])).alias(c) for c in sums]
    ).withColumn("__bucket", F.date_trunc(unit, "__time"))
    across = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    days = points.groupBy("__key", "__bucket").agg(*[F.sum(c).alias(c) for c in sums]).select(
        "__key", "__bucket", *[F.sum(c).over(across).alias(f"__day_{c}") for c in sums])
    inside = Window.partitionBy("__key", "__bucket").orderBy("__time").rowsBetween(Window.unboundedPreceding, -1)
    earlier = points.select("__key", "__time", "__bucket", *[F.sum(c).over(inside).alias(f"__now_{c}") for c in sums])
    found = earlier.join(days, ["__key", "__bucket"]).select(
        "__key", "__time", *[(F.coalesce(f"__day_{c}", F.lit(0)) + F.coalesce(f"__now_{c}", F.lit(0))).cast(kinds[c]).alias(c)
                             for c in sums])
    kept = questions.drop(*sums)
    matched = (kept[key] == found["__key"]) & (kept[time] == found["__time"])
    return kept.join(found, matched, "left").select(
        *kept.columns, *[F.coalesce(F.col(c), F.lit(0).cast(kinds[c])).alias(c) for c in sums])


def first_seen(events: DataFrame, key: str, value: str, time: str, name: str) -> DataFrame:
    """(key, time, name = 1) where each value of a key comes up first: summed, it counts distinct values."""
    present = events.where(F.col(value).isNotNull() & F.col(time).isNotNull())
    return present.groupBy(key, value).agg(F.min(time).alias(time)).select(
        key, time, F.lit(1).cast("long").alias(name))
