"""Session rollup over shuffled, repeated and late events."""

import datetime as dt
import random

from pyspark.sql import functions as F

from basketry.streaming.activity import delivered_once, drain, session_rollup, write_rollup

START = dt.datetime(2021, 3, 1)
SCHEMA = ("activity_id long, customer_id long, activity_timestamp timestamp_ntz, activity_type string, "
          "add_to_cart_quantity int, scroll_percent double, duration_seconds int")
KINDS = ["product_view", "search", "add_to_cart", "checkout"]


def events(n=800, hours=90):
    rng = random.Random(11)
    return [(i if i % 50 else None, rng.randint(1, 12), START + dt.timedelta(seconds=rng.randint(0, hours * 3600)),
             rng.choice(KINDS), rng.randint(1, 4), float(i), 5) for i in range(n)]


def arrive(spark, folder, parts):
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_repeated_and_shuffled_events_count_once_and_late_ones_are_counted(spark, tmp_path):
    rng = random.Random(2)
    good = sorted(events(), key=lambda r: r[2])
    # Everything, and every third event again, comes within the bound but out of order.
    sent = sorted(good + good[::3], key=lambda r: r[2] + dt.timedelta(minutes=rng.random() * 50))
    size = len(sent) // 4 + 1
    parts = [sent[i:i + size] for i in range(0, len(sent), size)]
    closing = (10**6, -1, START + dt.timedelta(days=300), "search", None, None, None)
    late = [(10**6 + 1 + i, i, START + dt.timedelta(hours=i), "search", 1, 1.0, 1) for i in range(7)]
    untimed = [(None, 3, None, "search", 1, 1.0, 1)] * 2
    # A late repeat of a known event is late too; the second closing event moves the watermark past both.
    parts += [[closing], [(10**6 + 50, -1, START + dt.timedelta(days=301), "search", None, None, None)],
              late + good[:5] + untimed]
    stream = arrive(spark, str(tmp_path / "in"), parts)
    query = write_rollup(session_rollup(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    drain(spark, query, str(tmp_path / "delivery"))
    got = spark.read.parquet(str(tmp_path / "out")).where("customer_id > 0")
    twin = session_rollup(spark.createDataFrame(sent + untimed, SCHEMA))
    plain = session_rollup(spark.createDataFrame(good, SCHEMA))
    assert plain.agg(F.sum("n_events")).first()[0] == len(good)
    for batch in (twin, plain):
        assert got.count() == batch.count() and got.exceptAll(batch).isEmpty()
    counted = spark.read.parquet(str(tmp_path / "delivery"))
    total = counted.agg(F.sum("n_input").alias("i"), F.sum("n_late").alias("l"), F.sum("n_repeated").alias("r")).first()
    assert (total.i, total.l, total.r) == (len(sent) + 2 + len(late) + 5 + 2, len(late) + 5, len(good[::3]))


def test_events_without_an_id_are_repeated_if_all_columns_are(spark):
    row = (None, 1, START, "search", 1, 1.0, 1)
    rows = [row, row, (None, 1, START, "search", 2, 1.0, 1), (None, 1, None, "search", 2, 1.0, 1), (7, *row[1:]), (7, *row[1:])]
    assert delivered_once(spark.createDataFrame(rows, SCHEMA)).count() == 3
    assert session_rollup(spark.createDataFrame([], SCHEMA)).count() == 0
