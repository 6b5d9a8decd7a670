"""Lookups by literal tables, and repeatable per-key randomness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.functions.numeric import col


def tier_rank(tier: str | Column) -> Column:
    """Loyalty tier as 1..4; 1 for anything else."""
    rank = F.lit(1)
    for i, name in reversed(list(enumerate(fv.LOYALTY_TIERS, start=1))):
        rank = F.when(col(tier) == name, i).otherwise(rank)
    return rank


def urban_flag(city: str | Column) -> Column:
    return F.coalesce(F.lower(col(city)).isin(*fv.MAJOR_CITIES), F.lit(False)).cast("int")


def page_group(activity: str | Column) -> Column:
    """Page the event type lives on; page views share the front page."""
    kind = col(activity)
    return (F.when(kind == "search", "/search").when(kind == "product_view", "/product")
            .when(kind == "add_to_cart", "/cart").when(kind == "checkout", "/checkout")
            .when(kind == "page_view", "/"))


def hash_uniform(key: str | Column) -> Column:
    """Number in [0, 1) fixed by the key, the same on every run and engine."""
    digest = F.substring(F.md5(col(key).cast("string")), 1, 8)
    return F.conv(digest, 16, 10).cast("double") / 4294967296.0


def shifted_segment(key: str | Column, shift: str | Column, labels: Sequence[str],
                    shares: Sequence[float]) -> Column:
    """Segment drawn by inverse CDF after tilting the base shares.

    A positive shift favours later segments. Each tilted weight is at least
    0.001 before the weights are normalised; the draw is the key's hash number.
    """
    last = len(labels) - 1
    tilted = []
    for i, share in enumerate(shares):
        tilt = 1 + col(shift) * (2.0 * i / last - 1.0)
        tilted.append(F.greatest(F.lit(0.001), F.lit(share) * tilt))
    total = sum(tilted[1:], tilted[0])
    draw, reached, label = hash_uniform(key), F.lit(0.0), None
    for name, weight in zip(labels[:-1], tilted):
        reached = reached + weight / total
        label = F.when(draw < reached, name) if label is None else label.when(draw < reached, name)
    return label.otherwise(labels[-1])
