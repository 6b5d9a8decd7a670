"""A total order over rows cut into ranges, with built-in functions only.

Rows sorted by a numeric key are dealt to ranges of about equal row counts: between sampled quantiles of
the key, and beyond MOST_BOUNDS of those in even steps of the key between two of them. Range totals are
few, so running sums over ranges are cheap, and each range is ordered by itself: no step sorts or numbers
all rows in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_RANGE = 5_000
# More bounds than these are replaced by even steps, each of at most so many rows.
MOST_BOUNDS = 512
ROWS_PER_STEP = 50_000
RANGE = "__range"


@dataclass(frozen=True)
class Ranges:
    """Bounds from the least to the greatest key, and the steps between two of them."""
    bounds: tuple
    steps: int

    def of(self, key: Column) -> Column:
        """The range of a key, rising with it. A null key is in range 0, before all others."""
        if len(self.bounds) < 2:
            return F.lit(0).cast("long")
        bounds = F.array(*[F.lit(b) for b in self.bounds])
        # How many inner bounds lie below the key: its place between two of them.
        place = F.size(F.filter(F.array(*[F.lit(b) for b in self.bounds[1:-1]]), lambda b: b < key)) \
            if len(self.bounds) > 2 else F.lit(0)
        if self.steps > 1:
            low, high = F.element_at(bounds, place + 1), F.element_at(bounds, place + 2)
            step = F.floor((key - low) / (high - low + 1) * self.steps)
            place = place * self.steps + F.greatest(F.least(step, F.lit(self.steps - 1)), F.lit(0))
        return F.when(key.isNull(), 0).otherwise(place.cast("long") + 1)


def key_ranges(df: DataFrame, key: str) -> Ranges:
    """Ranges for the rows of a frame. Runs one Spark job over the key."""
    first = df.agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    n = min(MOST_BOUNDS, -(-first["n"] // ROWS_PER_RANGE))
    if n < 2 or first["low"] is None:
        return Ranges((), 1)
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    inner = df.agg(F.percentile_approx(key, shares, F.lit(20 * n)).alias("b")).first()["b"]
    bounds = sorted({first["low"], *inner, first["high"]})
    return Ranges(tuple(bounds), -(-first["n"] // (len(bounds) * ROWS_PER_STEP)))
