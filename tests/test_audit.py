"""The cleaning audit from the writes of the dataset equals the one that counts each step."""

import pytest

from basketry.plans import modeling
from basketry.session import cut_lineage
from checks.registry import Tables


@pytest.fixture(scope="module")
def t(spark, data):
    return dict(Tables(spark, data))


def audits(spark, tables):
    counts = modeling.CleaningCounts()
    cut_lineage(modeling.modeling_dataset(tables, counts=counts))
    counted = modeling.counted_audit(spark, counts)
    return counted, [tuple(r) for r in counted.collect()]


def test_repeated_rows_and_lines_without_orders(spark, t):
    orders = t["orders"].unionByName(t["orders"].where("order_id % 3 = 0")).unionByName(t["orders"].where("order_id % 7 = 0"))
    items = t["items"].where("order_id % 5 > 0").unionByName(t["items"].where("order_id % 2 = 0"))
    tables = {**t, "orders": orders, "items": items}
    counted, rows = audits(spark, tables)
    again = modeling.cleaning_audit(tables)
    assert rows == [tuple(r) for r in again.collect()] and counted.columns == again.columns
    assert rows[0][1] > rows[0][2] and rows[1][1] > rows[1][2]


def test_the_star_join_reads_no_raw_orders_or_lines(t):
    orders, items = cut_lineage(t["orders"]), cut_lineage(t["items"])
    joined = modeling.merged_orders({**t, "orders": orders, "items": items})
    assert not {*orders.inputFiles(), *items.inputFiles()} & set(joined.inputFiles())


def test_no_orders(spark, t):
    _, rows = audits(spark, {**t, "orders": t["orders"].limit(0)})
    assert [r[0] for r in rows] == list(modeling._STEPS)
    lines = rows[1]
    assert [r[1:] for r in rows if r is not lines] == [(0, 0, None)] * 4 and lines[1] > 0
