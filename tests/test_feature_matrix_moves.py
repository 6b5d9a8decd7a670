"""What the query feature_matrix moves and stores, and that its shorter ways give the same."""

import datetime as dt
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.operators.ordered import order_history
from basketry.plans import facts, modeling
from basketry.session import configure
from checks import profiling
from checks.registry import Tables


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture
def large(spark):
    """As if every table were too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield configure(spark)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_engineered_rows_are_the_dataset_copy_unmoved(large, data, monkeypatch):
    monkeypatch.setattr(profiling, "cut_lineage", lambda df: df)
    rows = profiling.engineered(Tables(large, data))
    assert "Exchange" not in plan_of(rows)
    assert not {"session_start", "occupation", "customer_unique_id", "seller_id"} & set(rows.columns)
    assert rows.where("customer_order_count IS NULL OR session_duration_min IS NULL OR age IS NULL").count() == 0


def test_orders_of_a_customer_are_counted_without_the_activity(large, data):
    plans = [plan_of(modeling.merged_orders(Tables(large, data), order_count=counted)) for counted in (False, True)]
    assert len({plan.count("Exchange hashpartitioning(l_orderkey") for plan in plans}) == 1


def test_sums_by_order_read_the_lines_where_the_dedup_left_them(large, data, monkeypatch):
    stored, store = [], modeling.cut_lineage
    monkeypatch.setattr(modeling, "cut_lineage", lambda df: stored.append(df.columns) or store(df))
    modeling.merged_orders(Tables(large, data))
    assert ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "__copies"] in stored
    assert ["order_id", "seller_id", "price", "product_category_name_english"] in stored
    assert not any("order_estimated_delivery_date" in columns for columns in stored)


def test_stored_cells_give_what_the_lines_give(spark):
    lines = spark.createDataFrame(
        [(1, 1, 8, 6, 2.5, 0.25, "a"), (1, 2, 7, 5, 1.5, 0.5, "b"), (1, 3, 9, 4, None, None, None), (1, 4, 8, 6, 2.0, 0.5, "a"),
         (2, 1, 7, 5, 3.0, 1.0, None), (3, 1, 7, 5, 3.0, 1.0, "b"), (None, 1, 7, 5, 4.0, 1.0, "b")],
        "order_id int, order_item_id int, product_id int, seller_id int, price double, freight_value double, "
        "product_category_name_english string")
    cells = facts.category_cells(lines)
    bare = lines.drop("product_category_name_english")
    assert sorted(map(tuple, facts.order_facts(bare, cells).collect())) == sorted(map(tuple, facts.order_facts(lines).collect()))
    assert sorted(map(tuple, facts.category_price_stats(lines, cells).collect())) == sorted(
        map(tuple, facts.category_price_stats(lines).collect())) == [
        ("a", 2.25, pytest.approx(0.353553, abs=1e-6), 1), ("b", pytest.approx(8.5 / 3), pytest.approx(1.258306, abs=1e-6), 2)]


def test_order_history_of_null_keys_and_times_moves_the_rows_once(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 3 == 0 else i % 5, None if i % 11 == 0 else start + dt.timedelta(hours=i * 7 % 90)) for i in range(200)]
    events = spark.createDataFrame(rows, "id int, k int, at timestamp_ntz")
    w = Window.partitionBy("k").orderBy("at", "id")
    want = events.select("id", "k", "at", F.min("at").over(w).alias("first_at"),
                         F.lag("at").over(w).alias("previous_at"), F.row_number().over(w).alias("sequence_no"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = order_history(events, "k", "at", "id", unit="day")
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        moves = re.findall(r"Exchange hashpartitioning\((\w+)", plan_of(got).split("Initial Plan")[-1])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(moves)[:2] == ["__s", "__slot"] and len(set(moves)) == 3  # the third is the running state by key


def test_pairs_of_order_and_session_move_once(large):
    sessions = large.createDataFrame([(1, 10, "a"), (1, 10, "b"), (2, None, "c")], "order_id int, session_id int, device_type string")
    activity = large.createDataFrame([(10, "search", 0, 5, 9), (10, "search", 2, 7, 1)], "session_id int, activity_type string, "
                                     "add_to_cart_quantity int, scroll_percent int, duration_seconds int")
    found = modeling.active_sessions(sessions, activity)
    assert not re.search(r"hashpartitioning\(order_id#\w+, session_id", plan_of(found))
    assert sorted((r.order_id, r.device_type, r.n_events) for r in found.collect()) == [(1, "a", 2), (1, "b", 2), (2, "c", None)]
