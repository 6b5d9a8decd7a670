"""As-of totals against brute force, and no future row in the dataset built on them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators.asof import first_seen, totals_before
from basketry.plans import facts, modeling
from checks.registry import Tables


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(9)
    start = dt.datetime(2020, 1, 1)

    def at():
        return None if rng.random() < 0.05 else start + dt.timedelta(hours=rng.randint(0, 60))

    rows = [(rng.choice(["a", "a", "a", "b", "c", None]), at(), rng.choice([1, 2, None]), rng.choice("xyz")) for _ in range(400)]
    asked = [(i, rng.choice(["a", "a", "b", "d", None]), at(), -1) for i in range(150)]
    asked += asked[:5]
    return (rows, spark.createDataFrame(rows, "k string, t timestamp_ntz, v long, label string"),
            asked, spark.createDataFrame(asked, "id int, k string, t timestamp_ntz, v int"))


@pytest.mark.parametrize("unit", ["day", "hour", "month"])
def test_totals_before(events, unit):
    rows, happened, asked, questions = events
    found = totals_before(happened, questions, "k", "t", ["v"], unit)
    assert found.columns == ["id", "k", "t", "v"]
    expected = sorted((i, sum(v or 0 for k2, t2, v, _ in rows if k and t and k2 == k and t2 and t2 < t)) for i, k, t, _ in asked)
    assert sorted((r.id, r.v) for r in found.collect()) == expected
    assert totals_before(happened.limit(0), questions, "k", "t", ["v"], unit).agg(F.sum("v")).first()[0] == 0
    assert totals_before(happened, questions.limit(0), "k", "t", ["v"], unit).count() == 0


def test_distinct_values_before(events):
    rows, happened, asked, questions = events
    found = totals_before(first_seen(happened, "k", "label", "t", "n"), questions, "k", "t", ["n"])
    expected = sorted((i, len({x for k2, t2, _, x in rows if k and t and k2 == k and t2 and t2 < t})) for i, k, t, _ in asked)
    assert sorted((r.id, r.n) for r in found.collect()) == expected


def test_first_sales_know_nothing(spark):
    time = dt.datetime(2020, 1, 1, 12)
    orders = spark.createDataFrame([(1, time), (2, time), (3, time + dt.timedelta(seconds=1))],
                                   "order_id int, order_purchase_timestamp timestamp_ntz")
    lines = spark.createDataFrame([(1, 1, 7, 10.0, "s", "toys"), (1, 2, 8, 20.0, "s", "toys"), (2, 1, 7, 6.0, "s", None),
                                   (3, 1, 7, 9.0, "s", "toys")],
                                  "order_id int, order_item_id int, product_id int, price double, seller_id string, "
                                  "product_category_name_english string")
    got = {r.order_id: r for r in facts.seller_stats_as_of(lines, orders).collect()}
    assert [(got[i].seller_order_count, got[i].seller_avg_price) for i in (1, 2)] == [(0, None)] * 2
    assert (got[3].seller_order_count, got[3].seller_avg_price, got[3].seller_item_count, got[3].seller_n_categories) == (2, 12.0, 3, 1)
    price = {r.order_id: r for r in facts.category_price_as_of(lines, orders).collect()}
    assert (price[3].cat_avg_price, round(price[3].cat_std_price, 6), price[3].cat_order_count) == (15.0, 7.071068, 1)
    assert price[2].primary_category == "unknown" and price[2].cat_order_count == 0


def test_dataset_as_of_reads_no_later_order(spark, data):
    t = Tables(spark, data)
    full = modeling.merged_orders(t, as_of=True)
    names = ["order_id", "seller_order_count", "seller_avg_price", "cat_avg_price", "cat_order_count"]
    assert sorted(modeling.merged_orders(t).columns) == sorted(full.columns)
    micros = F.unix_micros(F.col("order_purchase_timestamp").cast("timestamp"))
    early = micros <= full.agg(F.percentile(micros, 0.5)).first()[0]

    class Past(dict):
        def __missing__(self, name):
            return t[name].where(early) if name == "orders" else t[name]

    before = modeling.merged_orders(Past(), as_of=True)
    a = sorted(tuple(r) for r in full.where(early).select(*names).collect())
    b = sorted(tuple(r) for r in before.select(*names).collect())
    assert a and a == b
