"""Feature encoders. Fitted parameters are small frames that can be saved as parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.functions.numeric import finite_or_zero
from basketry.operators.quantile import scalars
from basketry.session import hinted, lookup

def category_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct levels of each column, in one Spark job; the distinct is combined on the map side.

    Every level becomes a column of the matrix, so the list is as long as the matrix is wide.
    """
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    long = df.select(*texts).unpivot([], list(columns), "column", "level")
    rows = long.where(F.col("level").isNotNull()).distinct().collect()
    return {c: sorted(r.level for r in rows if r.column == c) for c in columns}


def one_hot_names(levels: Mapping[str, Sequence[str]]) -> list[tuple[str, str, str]]:
    """(column, level, output name) for every level but 'unknown'."""
    return [(c, level, f"{c}_{level}") for c, found in levels.items() for level in found
            if level != fv.UNKNOWN and not level.endswith(f"_{fv.UNKNOWN}")]


def one_hot(levels: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """0/1 column per level; a null or unseen value is 0 everywhere."""
    return {name: F.coalesce(F.col(c).cast("string") == level, F.lit(False)).cast("double")
            for c, level, name in one_hot_names(levels)}


def fit_target_encoding(train: DataFrame, columns: Sequence[str], target: str,
                        smoothing: float = fv.TARGET_SMOOTHING) -> DataFrame:
    """(column, category, encoded): smoothed target means; the null category is the global mean."""
    fallback = train.agg(F.avg(target).alias("encoded")).select(
        F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("category"), "encoded")
    if not columns:
        return fallback
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    long = train.select(F.col(target).alias("y"), *texts).unpivot(
        ["y"], list(columns), "column", "category")
    overall = scalars(train.agg(F.avg(target).alias("m")))["m"]
    groups = long.where(F.col("category").isNotNull()).groupBy("column", "category").agg(
        F.sum("y").alias("total"), F.count("y").alias("n"))
    fitted = groups.select("column", "category",
                           ((F.col("total") + smoothing * overall) / (F.col("n") + smoothing)).alias("encoded"))
    return fitted.unionByName(fallback)


def apply_target_encoding(df: DataFrame, columns: Sequence[str], encoding: DataFrame) -> DataFrame:
    """Add ``{column}_te``; null and unseen categories take the global mean.

    The encoding is stored and counted (Spark jobs); a small one is broadcast.
    """
    encoding, small = lookup(encoding)
    overall = scalars(encoding.where(F.col("column").isNull()).select("encoded"))["encoded"]
    for c in columns:
        table = encoding.where(F.col("column") == c).select(
            F.col("category").alias("__category"), F.col("encoded").alias("__encoded"))
        df = df.join(hinted(table, small), F.col(c).cast("string") == F.col("__category"), "left").withColumn(
            f"{c}_te", F.coalesce("__encoded", overall)).drop("__category", "__encoded")
    return df


def fit_scaling(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mean, std): population deviation, null and infinity counted as 0."""
    zeroed = train.select(*[finite_or_zero(c).alias(c) for c in columns])
    moments = zeroed.agg(*[F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
                           for c in columns])
    return moments.select(F.inline(F.array(*columns)))


def scale(df: DataFrame, columns: Sequence[str], scaling: DataFrame) -> DataFrame:
    """Standardise columns in place; a constant column is only centred.

    The scaling table has one row per column, so its values become literals.
    """
    fitted = {r.feature: (r["mean"] or 0.0, r["std"] or 0.0) for r in scaling.collect()}
    out = {}
    for c in columns:
        mean, std = fitted[c]
        out[c] = (finite_or_zero(c) - F.lit(mean)) / F.lit(std if std > 0 else 1.0)
    return df.withColumns(out)
