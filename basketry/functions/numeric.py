"""Numeric, guarded and binned expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry import fixed_values as fv


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip(x: str | Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value on either side; null stays null (greatest/least skip nulls)."""
    value = out = col(x)
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(value.isNotNull(), out)


def ratio(top: str | Column, bottom: str | Column, floor: float = 1) -> Column:
    """Division whose denominator never falls below ``floor``."""
    return col(top) / clip(bottom, low=floor)


def safe_divide(top: str | Column, bottom: str | Column) -> Column:
    """Division that is 0 wherever the denominator is not positive."""
    return F.when(col(bottom) > 0, col(top) / col(bottom)).otherwise(F.lit(0.0))


def finite_or_zero(x: str | Column) -> Column:
    """Null, NaN and both infinities become 0."""
    value = col(x).cast("double")
    usable = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.when(usable, value).otherwise(F.lit(0.0))


def sigmoid(x: str | Column, bound: float = 20.0) -> Column:
    return 1.0 / (1.0 + F.exp(-clip(x, -bound, bound)))


def haversine_km(lat1: str | Column, lng1: str | Column, lat2: str | Column,
                 lng2: str | Column) -> Column:
    """Great-circle distance; a missing coordinate takes the default position."""
    y1, y2 = (F.radians(F.coalesce(col(c), F.lit(fv.DEFAULT_LAT))) for c in (lat1, lat2))
    x1, x2 = (F.radians(F.coalesce(col(c), F.lit(fv.DEFAULT_LNG))) for c in (lng1, lng2))
    half_chord = (F.pow(F.sin((y2 - y1) / 2), 2)
                  + F.cos(y1) * F.cos(y2) * F.pow(F.sin((x2 - x1) / 2), 2))
    return 2 * fv.EARTH_RADIUS_KM * F.asin(F.sqrt(half_chord))


def right_closed_bins(x: str | Column, edges: Sequence[float], labels: Sequence[str],
                      outside: str = "nan") -> Column:
    """Label of the (low, high] interval holding the value; ``outside`` beyond the edges."""
    value = col(x)
    ladder = F.when(value.isNull() | (value <= edges[0]), outside)
    for edge, label in zip(edges[1:], labels):
        ladder = ladder.when(value <= edge, label) if edge != math.inf else ladder.when(
            value.isNotNull(), label)
    return ladder.otherwise(outside)


def quantile_label(x: str | Column, edges: Sequence[Column], prefix: str = "Q") -> Column:
    """Q1.. by right-closed cuts at the inner quantiles."""
    value, ladder = col(x), None
    for i, edge in enumerate(edges, start=1):
        step = value <= edge
        ladder = F.when(step, f"{prefix}{i}") if ladder is None else ladder.when(step, f"{prefix}{i}")
    return ladder.when(value.isNotNull(), f"{prefix}{len(edges) + 1}")


def equal_width_bin(x: str | Column, low: Column, high: Column, bins: int) -> Column:
    """Left-closed bin 0..bins-1 over [low, high]; the top edge joins the last bin."""
    span = high - low
    position = F.floor((col(x) - low) / span * bins)
    return F.when(span > 0, F.least(position, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")


def right_closed_bucket(x: str | Column, low: Column, high: Column, bins: int) -> Column:
    """Bucket 1..bins over (low, high] steps; the minimum joins bucket 1."""
    span = high - low
    position = F.ceil((col(x) - low) / span * bins)
    return F.when(span > 0, F.greatest(position, F.lit(1))).otherwise(F.lit(1)).cast("int")


def money_total(x: str | Column) -> Column:
    """Exact sum of a currency column: added up in whole cents, 0 for no rows."""
    cents = F.round(col(x) * 100).cast("long")
    return F.coalesce(F.sum(cents), F.lit(0)) / 100.0


def money_mean(x: str | Column) -> Column:
    """Mean of a currency column from its exact sum in cents."""
    cents = F.round(col(x) * 100).cast("long")
    return F.sum(cents) / F.count(cents) / 100.0
