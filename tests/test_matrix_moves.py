"""The feature matrix: what its rows carry, and how batches are read."""

import numpy as np
import pyarrow as pa

from basketry import job
from basketry.operators import gram
from basketry.plans import facts, features, modeling
from basketry.session import configure
from checks import linear
from checks.registry import Tables


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_order_count_needs_no_move_of_the_rows(spark, data):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the customers were many
    try:
        rows = modeling.modeling_dataset(Tables(configure(spark), data), order_count=True)
        plain = rows.drop("customer_order_count")
        want = facts.customer_order_count(plain).select("order_id", "customer_order_count")
        assert sorted(map(tuple, rows.select("order_id", "customer_order_count").collect())) == sorted(map(tuple, want.collect()))
        used = features.matrix_input(features.engineer_features(features.with_target(rows)), job.KEPT)
        moved = "hashpartitioning(customer_unique_id"  # the fills' medians have exchanges of their own
        assert moved not in plan_of(used)
        assert moved in plan_of(features.engineer_features(features.with_target(plain)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not {"session_id", "session_start", "customer_id", "occupation"} & set(used.columns)
    assert {*job.KEPT, "customer_order_count", "primary_category", "is_weekend"} <= set(used.columns)


def test_rows_by_customer_counts_repeated_sessions_and_skips_orders_without_value(spark):
    tables = {"customers": spark.createDataFrame([(1, 11), (2, 11), (3, 12), (4, 13)], "customer_id int, customer_unique_id int"),
              "profile": spark.createDataFrame([(11,), (12,)], "customer_id int")}
    orders = spark.createDataFrame([(100, 1), (101, 2), (102, 3), (103, 4), (104, 3)], "order_id int, customer_id int")
    by_order = spark.createDataFrame([(100,), (101,), (102,), (103,)], "order_id int")
    sessions = spark.createDataFrame([(100,), (100,), (101,), (102,), (103,), (104,)], "order_id int")
    found = modeling.rows_by_customer(tables, orders, by_order, sessions)
    assert sorted(map(tuple, found.collect())) == [(11, 3), (12, 1)]


def test_moments_read_bare_numbers(spark):
    batch = [pa.array([1.0, None, 3.0]), pa.array([float("inf"), float("nan"), -float("inf")])]
    assert gram.finite_matrix(batch).tolist() == [[1.0, 0.0], [0.0, 0.0], [3.0, 0.0]]
    df = spark.createDataFrame([(1.0, True), (None, False), (float("nan"), None), (float("inf"), True)], "a double, b boolean")
    found = gram.moments(df, ["a", "b"])[0]
    assert found.n == 4 and np.allclose(found.mean, [0.25, 0.5])
    assert "isnan" not in plan_of(df.select(*gram._numbers(["a", "b"]))).lower()


def test_models_ask_the_dataset_for_what_the_matrix_reads(spark, data, monkeypatch):
    asked, build = [], linear.modeling_dataset
    monkeypatch.setattr(linear, "modeling_dataset", lambda t, **options: asked.append(build(t, **options)) or asked[-1])
    matrix, columns, _ = linear.full_matrix(Tables(configure(spark), data))
    assert set(asked[0].columns) <= set(features.matrix_sources(["order_id"]))
    want = job.training_matrix(build(Tables(configure(spark), data), order_count=True), linear.SPLIT)
    assert columns == want[2] and matrix.columns == want[1].columns
    rounded = [[r[0], *(round(float(x), 6) for x in r[2:])] for r in matrix.orderBy("order_id").collect()]
    assert np.allclose(rounded, [[r[0], *map(float, r[2:])] for r in want[1].orderBy("order_id").collect()], atol=1e-5)
