"""Scoring requests are built once, from what they read, and the wide rows move by order only."""

import re

from pyspark.sql import functions as F

from basketry.plans import eda, facts
from basketry.session import configure
from checks import modelling, registry
from checks.registry import Tables


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_requests_read_no_category_and_move_by_order(spark, data):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the tables were large
    try:
        t = Tables(configure(spark), data)
        plan, whole = formatted(modelling.requests(t)), formatted(eda.eda_dataset(t))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "part.parquet" in whole and "part.parquet" not in plan
    for text in (plan, whole):
        moves = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(([^#]*)#", text)
        assert {key for columns, key in moves if "device_type#" in columns} - {"product_category_name"} == {"order_id"}
        assert sum("device_type#" in columns for columns, key in moves if key == "order_id") == 1
        assert not any("loyalty_tier#" in columns and "order_id#" in columns for columns, key in moves
                       if key not in ("order_id", "product_category_name"))


def test_some_columns_of_the_dataset_have_the_same_rows(spark, data):
    t = Tables(configure(spark), data)
    whole = eda.eda_dataset(t)
    chosen = ["order_id", "session_duration_min", "total_cart_qty", "household_size", "item_count", "session_end"]
    some = eda.eda_dataset(t, chosen)
    assert some.columns == chosen and sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.select(*chosen).collect()))
    named = eda.eda_dataset(t, ["order_id", "product_category_name_english"])
    assert sorted(map(str, named.collect())) == sorted(map(str, whole.select(*named.columns).collect()))


def test_score_orders_builds_its_requests_once(spark, data, monkeypatch):
    calls, build = [], eda.eda_dataset
    monkeypatch.setattr(eda, "eda_dataset", lambda t, *a: calls.append(a) or build(t, *a))
    found = registry.QUERIES["score_orders"](spark, data)
    assert len(calls) == 1 and found.count() == build(Tables(configure(spark), data), ["order_id"]).count()


def test_request_model_trains_on_values_of_distinct_lines(spark, data):
    t = Tables(configure(spark), data)
    whole = facts.order_value(facts.dedup_items(t["items"]))
    bare = facts.order_value(facts.dedup_items(t["items"].drop("shipping_limit_date")))
    assert whole.exceptAll(bare).isEmpty() and bare.select(F.sum("item_count")).first()[0] < t["items"].count()
