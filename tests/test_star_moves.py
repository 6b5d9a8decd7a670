"""The star join moves every wide column once, and gives the rows it gave."""

import re

import pytest
from pyspark.sql import functions as F

from basketry.operators.ordered import first_per_key
from basketry.plans import facts, modeling
from basketry.session import configure
from checks.registry import Tables


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("as_of", [False, True])
def test_wide_columns_move_by_order_only(spark, data, as_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the tables were large
    try:
        plan = formatted(modeling.merged_orders(Tables(configure(spark), data), as_of))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moves = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((\w+)#", plan)
    assert {key for columns, key in moves if "device_type#" in columns} == {"order_id"}
    assert sum("device_type#" in columns for columns, _ in moves) == 1
    assert {key for columns, key in moves if "loyalty_tier#" in columns} <= {"order_id", "customer_unique_id", "customer_id_profile",
                                                                            "customer_id"}
    assert not any("n_events#" in columns and "device_type#" in columns for columns, _ in moves)


def test_lines_of_an_order_lie_side_by_side(spark):
    lines = spark.range(3000).select((F.col("id") % 500).alias("o"), (F.col("id") / 1000).cast("int").alias("i"),
                                     F.col("id").alias("v"))
    kept = first_per_key(lines, ["o", "i"], ["v"], "n", numbered="i")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, first_per_key(lines, ["o", "i"], ["v"], "n").collect()))
    assert kept.columns == ["o", "i", "v", "n"]
    placed = kept.select("o", F.spark_partition_id().alias("task")).distinct()
    assert placed.count() == 500


def test_active_sessions_matches_by_session(spark):
    sessions = spark.createDataFrame([(1, 10, "a"), (1, 11, "b"), (2, 12, "c"), (3, None, "d"), (3, 13, "e")],
                                     "order_id int, session_id int, device_type string")
    events = "session_id int, activity_type string, add_to_cart_quantity int, scroll_percent int, duration_seconds int"
    activity = spark.createDataFrame([(10, "search", 0, 5, 9), (10, "add_to_cart", 2, 7, 1), (12, "search", 0, None, None),
                                      (None, "search", 1, 1, 1)], events)
    found = modeling.active_sessions(sessions, activity)
    want = sessions.join(facts.session_activity(activity), "session_id", "left").select(*found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_order_facts_of_many_lines(spark):
    lines = spark.createDataFrame(
        [(1, 2, 7, 5, 1.5, 0.5, "b"), (1, 1, 8, 6, 2.5, 0.25, "a"), (1, 3, 9, 4, None, None, None), (2, 1, 7, 5, 3.0, 1.0, None)],
        "order_id int, order_item_id int, product_id int, seller_id int, price double, freight_value double, "
        "product_category_name_english string")
    assert sorted(map(tuple, facts.order_facts(lines).collect())) == [
        (1, 4.75, 0.75, 3, "a", 2, 6), (2, 4.0, 1.0, 1, "unknown", 0, 5)]
