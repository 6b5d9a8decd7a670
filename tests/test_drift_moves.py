"""Drift reads and moves no more than it needs, and gives what it gave."""

import math

from pyspark.sql import functions as F

from basketry.operators.quantile import value_bins, value_counts
from basketry.plans import drift, modeling, sketches
from basketry.session import configure
from checks.registry import Tables


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_psi_stores_folded_values_only(spark, monkeypatch):
    stored, store = [], drift.cut_lineage
    monkeypatch.setattr(drift, "cut_lineage", lambda df: stored.append(df.columns) or store(df))
    rows = spark.range(400).select((F.col("id") < 200).alias("is_ref"), (F.col("id") % 7).cast("double").alias("x"),
                                   F.when(F.col("id") > 300, F.lit(float("nan"))).otherwise(F.col("id")).alias("y"))
    found = {r.feature: r.psi for r in drift.psi(rows, ["x", "y"], 4).collect()}
    assert stored == [["feature", "v", "n", "r"]]
    edges = [49.75, 99.5, 149.25]
    share = [[(sum(sum(v >= e for e in edges) == i for v in side) + 1) / (len(side) + 4) for i in range(4)]
             for side in (range(200), range(200, 301))]
    assert math.isclose(found["y"], sum((c - r) * math.log(c / r) for r, c in zip(*share)))
    assert 0 <= found["x"] < 0.01


def test_norm_comes_from_the_folded_values(spark):
    rows = spark.createDataFrame([(True, 1.0), (True, 1.0), (True, 4.0), (True, None), (False, 2.0)], "is_ref boolean, x double")
    found = drift.numeric_tests(rows, ["x"]).first()
    assert math.isclose(found.wasserstein_norm, found.wasserstein / math.sqrt(2))


def test_sketch_groups_are_one_number(spark):
    rows = spark.sql("SELECT timestamp_ntz'1969-12-15' + make_dt_interval(id) AS t, id AS a, CAST(id % 3 AS DOUBLE) AS b FROM range(60)")
    found = sketches.period_sketches(rows, "t", ["a", "b"], "month")
    assert "keys=[slot" in plan_of(found) or "keys=[_groupingexpression" in plan_of(found)
    assert "Expand" not in plan_of(found)
    assert sorted((str(r.period), r.feature, r.n) for r in found.collect()) == [
        (month, c, n) for month, n in (("1969-12-01", 17), ("1970-01-01", 31), ("1970-02-01", 12)) for c in "ab"]


def test_bins_are_the_edges_below(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), (F.col("id") % 900).cast("double").alias("v"))
    for bins in (2, 64, 1024):
        binned, edges = value_bins(value_counts(df, ["k"], "v"), ["k"], bins)
        cuts = edges.first().edges
        assert all(r.bin == sum(e < r.v for e in cuts) for r in binned.collect())


def test_dataset_of_some_columns_has_the_same_rows(spark, data):
    names = ["order_id", "order_value", "review_score", "payment_type", "avg_scroll"]
    tables = Tables(configure(spark), data)
    part = modeling.modeling_dataset(tables, columns=names)
    assert part.columns == names
    whole = modeling.modeling_dataset(tables).select(*names)
    assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect()))
