"""Feature drift between a reference and a current window, all features in one job."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import fixed_values as fv
from basketry.operators.quantile import attach_row, quantiles, quantiles_of_counts, unpivot, value_bins
from basketry.session import cut_lineage, ship_package


def labelled(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Both windows in one frame, told apart by ``is_ref``."""
    return reference.withColumn("is_ref", F.lit(True)).unionByName(current.withColumn("is_ref", F.lit(False)))


def labelled_by_time(df: DataFrame, time: str, date: str) -> DataFrame:
    """One frame split in two windows at a date; it is read once, not once per window."""
    return df.where(F.col(time).isNotNull()).withColumn(
        "is_ref", F.col(time) < F.lit(date).cast("timestamp_ntz"))


def _long(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long form (is_ref, feature, value); null and NaN left out."""
    return unpivot(rows, features, ["is_ref"]).where(F.col("value").isNotNull() & ~F.isnan("value"))


def _folded(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, v, n, r): distinct values with their rows and those of the reference, stored. Reads the rows once."""
    return cut_lineage(_long(rows, features).groupBy("feature", F.col("value").alias("v")).agg(
        F.count("*").alias("n"), F.count_if("is_ref").alias("r")))


def _edge_names(bins: int) -> list[str]:
    return [f"e{i}" for i in range(1, bins)]


def bin_edges(reference: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, e1, e2, ...): the inner edges of equally full bins."""
    return quantiles(_long(reference, features), ["feature"], "value", [i / bins for i in range(1, bins)],
                     _edge_names(bins))


def _placed(long: DataFrame, edges: DataFrame, bins: int) -> DataFrame:
    """Long rows with their bin: the number of inner edges not above the value."""
    # One row of edges per feature: the list of features bounds it.
    edges = edges.select("feature", *_edge_names(bins))
    bin_no = sum(((F.col("value") >= F.col(e)).cast("int") for e in _edge_names(bins)), F.lit(0))
    return long.join(F.broadcast(edges), "feature").withColumn("bin", bin_no)


def _psi(bins: int) -> Column:
    """The index from bin counts r0, r1, ... of the reference and c0, c1, ..., smoothed by one per bin."""
    totals = {tag: sum((F.col(f"{tag}{i}") for i in range(bins)), F.lit(bins)) for tag in "rc"}
    terms = []
    for i in range(bins):
        r, c = ((F.col(f"{tag}{i}") + 1) / totals[tag] for tag in "rc")
        terms.append((c - r) * F.log(c / r))
    return sum(terms[1:], terms[0])


def psi(rows: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, psi): population stability over quantile bins of the reference rows.

    A value's bin is the number of inner edges not above it, so repeated edges
    give empty bins. Counts are smoothed by one per bin. The rows are read once: they fold to distinct values
    with counts, which are stored (a Spark job), and edges and bin counts come from these.
    """
    values = _folded(rows, features)
    edges = quantiles_of_counts(values.where("r > 0").select("feature", "v", F.col("r").alias("n")), ["feature"],
                                [i / bins for i in range(1, bins)], _edge_names(bins))
    sizes = {"r": F.col("r"), "c": F.col("n") - F.col("r")}
    counts = _placed(values.withColumnRenamed("v", "value"), edges, bins).groupBy("feature").agg(*[
        F.coalesce(F.sum(F.when(F.col("bin") == i, size)), F.lit(0)).alias(f"{tag}{i}")
        for i in range(bins) for tag, size in sizes.items()])
    return counts.select("feature", _psi(bins).alias("psi"))


def reference_bins(reference: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, e1, ..., r0, r1, ...): edges and counts of the reference, to be stored. Runs a Spark job.

    Any later rows are held against it without the reference rows. A feature without values has no row.
    """
    rows = cut_lineage(reference.select(*features).withColumn("is_ref", F.lit(True)))
    edges = bin_edges(rows, features, bins)
    counts = _placed(_long(rows, features), edges, bins).groupBy(F.col("feature").alias("f")).agg(*[
        F.count_if(F.col("bin") == i).alias(f"r{i}") for i in range(bins)])
    return edges.join(counts, F.col("feature") == F.col("f")).drop("f")


def psi_against(long: DataFrame, reference: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., feature, n, psi) of long rows (keys' columns, feature, value) against stored reference bins.

    Works on batch and streaming frames. A feature without values in a group, or not in the reference, has
    no row there.
    """
    bins = sum(c.startswith("r") for c in reference.columns)
    usable = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = _placed(usable, reference, bins).groupBy(*keys, "feature").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("bin") == i).alias(f"c{i}") for i in range(bins)])
    known = F.broadcast(reference.select("feature", *[f"r{i}" for i in range(bins)]))  # a row a feature
    return counts.join(known, "feature").select(*keys, "feature", "n", _psi(bins).alias("psi"))


def drift_report(scores: DataFrame, limit: float = fv.PSI_THRESHOLD) -> DataFrame:
    """One row: features monitored and drifted, maximum, ten highest, retrain flag."""
    ranked = F.sort_array(F.collect_list(F.struct("psi", "feature")), asc=False)
    top = F.transform(F.slice(ranked, 1, 10), lambda s: s["feature"])
    return scores.agg(
        F.count("*").alias("n_features"), F.count_if(F.col("psi") > limit).alias("n_drifted"),
        F.max("psi").alias("max_psi"), F.array_join(top, ",").alias("top_features")
    ).withColumns({"drift_threshold": F.lit(limit), "retrain": F.col("n_drifted") > 0})


def ks_distance(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, ks): largest gap between the two cumulative distributions, exact. Runs a Spark job."""
    return numeric_tests(rows, features).select("feature", "ks")


def numeric_tests(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, n_ref, n_cur, ks, ks_p, wasserstein, wasserstein_norm), exact. Runs Spark jobs.

    Both distances come from the gap between the two cumulative distributions at each distinct value: its
    largest, and its sum over the way to the next value. Distinct values carry counts; cumulative counts
    run inside value bins and are offset by the totals of the lower bins, so no task holds a feature
    whole. ``ks_p`` is the asymptotic p-value; the norm is the reference's population deviation (null if
    that is 0). Null and NaN are left out; with a window empty the figures are null, and a feature without
    any value has no row. A gap that reaches to an infinite value makes the distance infinite.
    """
    counts = _folded(rows, features)
    binned, _ = value_bins(counts, ["feature"])
    binned = binned.withColumn("c", F.col("n") - F.col("r"))
    by_bin = Window.partitionBy("feature").orderBy("bin")
    lower, whole = by_bin.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("feature")
    per_bin = binned.groupBy("feature", "bin").agg(F.sum("r").alias("r"), F.sum("c").alias("c"), F.min("v").alias("least"))
    offsets = per_bin.select(
        F.col("feature").alias("f"), F.col("bin").alias("b"), F.lead("least").over(by_bin).alias("after"),
        *[F.coalesce(F.sum(x).over(lower), F.lit(0)).alias(f"{x}_before") for x in "rc"],
        *[F.sum(x).over(whole).alias(f"{x}_all") for x in "rc"])
    inside = Window.partitionBy("feature", "bin").orderBy("v")
    up_to = inside.rowsBetween(Window.unboundedPreceding, 0)
    steps = binned.join(offsets, (F.col("feature") == F.col("f")) & (F.col("bin") == F.col("b")))
    share = {x: F.try_divide(F.sum(x).over(up_to) + F.col(f"{x}_before"), F.col(f"{x}_all")) for x in "rc"}
    gaps = steps.select("feature", "r_all", "c_all", "v", F.abs(share["r"] - share["c"]).alias("gap"),
                        F.coalesce(F.lead("v").over(inside), "after").alias("next"))
    way = F.when(F.col("next").isNull() | (F.col("gap") == 0), F.when(F.col("gap").isNotNull(), 0.0)).otherwise(
        F.col("gap") * (F.col("next") - F.col("v")))
    found = gaps.groupBy("feature").agg(F.max("r_all").alias("n_ref"), F.max("c_all").alias("n_cur"),
                                        F.max("gap").alias("ks"), F.sum(way).alias("wasserstein"))
    spread = _deviations(counts.where("r > 0"))  # a row a feature: their list bounds it
    size = F.sqrt(F.try_divide(F.col("n_ref").cast("double") * F.col("n_cur"), F.col("n_ref") + F.col("n_cur")))
    return found.join(F.broadcast(spread), "feature", "left").select(
        "feature", "n_ref", "n_cur", "ks", kolmogorov_tail(size * F.col("ks")).alias("ks_p"), "wasserstein",
        F.when(F.col("deviation") > 0, F.col("wasserstein") / F.col("deviation")).alias("wasserstein_norm"))


def _deviations(values: DataFrame) -> DataFrame:
    """(feature, deviation): the reference's population deviation, from its distinct values around their mean."""
    def mean(x: Column) -> Column:
        return F.sum(F.col("r") * x) / F.sum("r")
    middle = values.groupBy(F.col("feature").alias("f")).agg(mean(F.col("v")).alias("middle"))
    off = F.col("v") - F.col("middle")
    return values.join(F.broadcast(middle), F.col("feature") == F.col("f")).groupBy("feature").agg(
        F.sqrt(mean(off * off)).alias("deviation"))


def kolmogorov_tail(x: Column) -> Column:
    """The chance that the limit of the scaled KS distance exceeds x: two series, each where it converges fast."""
    near = sum((F.exp(-F.lit((2 * k - 1) ** 2 * math.pi ** 2 / 8) / (x * x)) for k in range(1, 6)), F.lit(0.0))
    far = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * x * x) for k in range(1, 6)), F.lit(0.0))
    return F.when(x <= 0, 1.0).when(x < 1.0, 1 - F.lit(math.sqrt(2 * math.pi)) / x * near).when(x.isNotNull(), far)


# Categories expected less often than this in either window share one cell.
LEAST_EXPECTED = 5.0


def category_tests(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, n_ref, n_cur, cells, chi2, chi2_p): does a category's share differ between the windows?

    Categories with fewer than LEAST_EXPECTED expected rows in a window are one cell together; there is no
    continuity correction. Null is left out. One cell only, or a window without rows, gives chi2 0 and
    p-value 1. A feature without any value has no row.
    """
    long = rows.select("is_ref", *[F.col(c).cast("string").alias(c) for c in features]).unpivot(
        ["is_ref"], list(features), "feature", "category").where("category IS NOT NULL")
    counts = long.groupBy("feature", "category").agg(F.count_if("is_ref").alias("r"), F.count_if(~F.col("is_ref")).alias("c"))
    sizes = counts.groupBy("feature").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    share = (F.col("r") + F.col("c")) / (F.col("n_ref") + F.col("n_cur"))
    rare = share * F.least("n_ref", "n_cur") < LEAST_EXPECTED
    cells = counts.join(F.broadcast(sizes), "feature").groupBy(  # a row for each feature
        "feature", "n_ref", "n_cur", F.when(~rare, F.col("category")).alias("cell")).agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    parts = [F.when(e > 0, (F.col(x) - e) ** 2 / e).otherwise(0.0) for x, e in
             ((x, share * F.col(n)) for x, n in (("r", "n_ref"), ("c", "n_cur")))]
    found = cells.groupBy("feature", "n_ref", "n_cur").agg(F.count("*").alias("cells"), F.sum(parts[0] + parts[1]).alias("chi2"))
    usable = (F.col("cells") > 1) & (F.least("n_ref", "n_cur") > 0)
    found = found.withColumn("chi2", F.when(usable, F.col("chi2")).otherwise(0.0))
    ship_package(rows.sparkSession)
    return found.withColumn("chi2_p", chi_square_tail(F.col("chi2"), F.when(usable, F.col("cells") - 1).otherwise(0)))


def chi_square_tail(x: Column, freedom: Column) -> Column:
    """The chance that a chi-square value exceeds x; without degrees of freedom 1."""

    @F.arrow_udf("double")
    def tails(xs: pa.Array, ks: pa.Array) -> pa.Array:
        return pa.array([upper_gamma(k / 2, v / 2) if k else 1.0 for v, k in zip(xs.to_pylist(), ks.to_pylist())])

    return tails(x.cast("double"), freedom.cast("long"))


def upper_gamma(a: float, x: float) -> float:
    """The regularised upper incomplete gamma function for a that is a multiple of a half."""
    if x <= 0:
        return 1.0
    b = a % 1 or 1.0
    found = math.erfc(math.sqrt(x)) if b == 0.5 else math.exp(-x)
    while b < a:  # Q(b + 1, x) = Q(b, x) + x^b e^-x / gamma(b + 1)
        found += math.exp(b * math.log(x) - x - math.lgamma(b + 1))
        b += 1
    return min(found, 1.0)


# A numeric feature has drifted from this distance in deviations on, a category below this p-value.
WASSERSTEIN_LIMIT, CHI2_LIMIT = 0.1, 0.05


def feature_tests(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, test, n_ref, n_cur, score, p_value, drifted): the test that fits each column's type. Runs Spark jobs.

    Numbers: normed Wasserstein distance with the p-value of KS. Texts and Booleans: chi-square. A
    numeric feature whose reference does not vary has drifted if the distance is above 0.
    """
    kinds = {f.name: f.dataType for f in rows.schema}
    numeric = [c for c in features if isinstance(kinds[c], T.NumericType)]
    category = [c for c in features if c not in numeric]
    parts = []
    if numeric:
        moved = F.when(F.col("wasserstein_norm").isNotNull(), F.col("wasserstein_norm") >= WASSERSTEIN_LIMIT).otherwise(
            F.col("wasserstein") > 0)
        parts.append(numeric_tests(rows, numeric).select(
            "feature", F.lit("wasserstein").alias("test"), "n_ref", "n_cur", F.col("wasserstein_norm").alias("score"),
            F.col("ks_p").alias("p_value"), F.coalesce(moved, F.lit(False)).alias("drifted")))
    if category:
        parts.append(category_tests(rows, category).select(
            "feature", F.lit("chi-square").alias("test"), "n_ref", "n_cur", F.col("chi2").alias("score"),
            F.col("chi2_p").alias("p_value"), (F.col("chi2_p") < CHI2_LIMIT).alias("drifted")))
    if not parts:
        raise ValueError("no features")
    return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]


def retrain_decision(scores: DataFrame, rolling: DataFrame, limit: float = fv.PSI_THRESHOLD) -> DataFrame:
    """One row: drifted features, days over the error limit, and whether either calls for retraining."""
    drifted = scores.agg(F.count_if(F.col("psi") > limit).alias("n_drifted"))
    breaches = rolling.agg(F.count_if("breach").alias("n_breaches"))
    both = attach_row(drifted, breaches, "__b").select("n_drifted", F.col("__b.n_breaches").alias("n_breaches"))
    return both.withColumn("retrain", (F.col("n_drifted") > 0) | (F.col("n_breaches") > 0))
