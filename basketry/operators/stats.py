"""Distribution statistics whose output does not grow with the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import equal_width_bin
from basketry.operators.quantile import attach_row, number, quantiles, scalars
from basketry.session import cut_lineage


def adjusted_skew(x: str) -> Column:
    """Sample skewness with the bias correction sqrt(n(n-1))/(n-2)."""
    n = F.count(x).cast("double")
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def profile(df: DataFrame, x: str) -> DataFrame:
    """Count, mean, median, sample deviation, p95, p99, maximum and skew, as one row; NaN is as null."""
    df = df.select(number(x).alias(x))
    probs, names = [0.5, 0.95, 0.99], ["median", "p95", "p99"]
    moments = [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
               F.max(x).alias("max"), adjusted_skew(x).alias("skewness")]
    order = ["n", "mean", "median", "std", "p95", "p99", "max", "skewness"]
    row = attach_row(df.agg(*moments), quantiles(df, [], x, probs, names), "cuts")
    return row.withColumns({n: F.col(f"cuts.{n}") for n in names}).select(*order)


def outliers(df: DataFrame, x: str, reach: float = 3.0) -> DataFrame:
    """Upper fence q3 + reach * IQR, and the count and percent of values beyond it."""
    cut = scalars(quantiles(df, [], x, [0.25, 0.75], ["q1", "q3"]))
    fence = cut["q3"] + reach * (cut["q3"] - cut["q1"])
    marked = df.select(F.col(x).alias("x"), fence.alias("fence"))
    return marked.agg(F.max("fence").alias("fence"), F.count_if(F.col("x") > F.col("fence")).alias("n_outliers"),
                      (F.count_if(F.col("x") > F.col("fence")) * 100.0 / F.count("*")).alias("pct_outliers"))


def box_stats(df: DataFrame, keys: Sequence[str], x: str) -> DataFrame:
    """Quartiles, whisker ends inside 1.5 IQR, and points beyond, per group. Stores the rows (a Spark job)."""
    present = number(x).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    rows = cut_lineage(df.where(present).select(*keys, x))
    cuts = quantiles(rows, keys, x, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(x).between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.join(cuts, list(keys)).groupBy(*keys, "q1", "median", "q3").agg(
        F.count("*").alias("n"), F.min(F.when(inside, F.col(x))).alias("whisker_low"),
        F.max(F.when(inside, F.col(x))).alias("whisker_high"), F.count_if(~inside).alias("n_outside"))


def histogram(df: DataFrame, x: str, bins: int = 100) -> DataFrame:
    """(bin, low, high, n) for the non-empty equal-width bins over the data range."""
    rows = df.where(F.col(x).isNotNull())
    edge = scalars(rows.agg(F.min(x).alias("low"), F.max(x).alias("high")))
    width = (edge["high"] - edge["low"]) / bins
    counts = rows.groupBy(equal_width_bin(x, edge["low"], edge["high"], bins).alias("bin")).agg(
        F.count("*").alias("n"))
    return counts.select("bin", (edge["low"] + width * F.col("bin")).alias("low"),
                         (edge["low"] + width * (F.col("bin") + 1)).alias("high"), "n")


def density_2d(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """(x_bin, y_bin, n): what a scatter plot shows, in at most bins squared rows."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    edge = scalars(rows.agg(F.min(x).alias("x0"), F.max(x).alias("x1"),
                            F.min(y).alias("y0"), F.max(y).alias("y1")))
    return rows.groupBy(equal_width_bin(x, edge["x0"], edge["x1"], bins).alias("x_bin"),
                        equal_width_bin(y, edge["y0"], edge["y1"], bins).alias("y_bin")).agg(
        F.count("*").alias("n"))


# Correlations in one aggregate: more of them side by side compile to slower code.
PAIRS_AT_ONCE = 12


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(column_a, column_b, r) for pairs of numeric columns, from a few aggregates over the rows.

    A pair uses the rows where both columns are present; null and NaN are one thing. A column has no
    correlation, itself included, while it does not vary. The columns are stored first (a Spark job).
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    df = cut_lineage(df.select(*[number(c).alias(c) for c in names]))
    parts = [pairs[i:i + PAIRS_AT_ONCE] for i in range(0, len(pairs), PAIRS_AT_ONCE)]
    found = None
    for part in parts:
        cells = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                          (F.when(F.var_pop(a) > 0, 1.0) if a == b else F.corr(a, b)).alias("r"))
                 for a, b in part]
        rows = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
        found = rows if found is None else found.unionByName(rows)
    return found


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_a, column_b, position_a, position_b, r) for all ordered pairs."""
    columns = list(columns)
    half = correlations(df, [(a, b) for i, a in enumerate(columns) for b in columns[i:]])
    sides = F.when(F.col("column_a") == F.col("column_b"), F.array(F.struct("column_a", "column_b"))).otherwise(
        F.array(F.struct("column_a", "column_b"), F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"))))
    names = F.array(*[F.lit(c) for c in columns])
    return half.select("r", F.explode(sides).alias("at")).select(
        "at.*", (F.array_position(names, F.col("at.column_a")) - 1).cast("int").alias("position_a"),
        (F.array_position(names, F.col("at.column_b")) - 1).cast("int").alias("position_b"), "r")


def shares(df: DataFrame, x: str) -> DataFrame:
    """(category, n, share) of the non-null values."""
    counts = df.where(F.col(x).isNotNull()).groupBy(x).agg(F.count("*").alias("n"))
    total = scalars(df.agg(F.count(x).alias("t")))["t"]
    return counts.select(F.col(x).alias("category"), "n", (F.col("n") / total).alias("share"))
