"""Streams of scored orders: closed days and periods equal the batch forms, triggers are written once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry.plans import drift, metrics
from basketry.streaming import monitoring

START = dt.datetime(2021, 3, 1)
SCHEMA = "id long, at_time timestamp_ntz, y double, p double, x double"


def orders(seed, days, shift_from, n=1500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = rng.choice([d for d in range(days) if d not in (4, 5)])  # days without orders
        y = float(rng.randint(50, 300))
        p = y + rng.choice([-1, 1]) * (10 if day < shift_from else 120)
        rows.append((i, START + dt.timedelta(days=day, seconds=rng.randint(0, 86_399)), y, p,
                     rng.gauss(0, 1) + (0 if day < shift_from else 2)))
    return sorted(rows, key=lambda r: r[1])


@pytest.fixture(scope="module")
def reference(spark):
    rng = random.Random(5)
    past = spark.createDataFrame([(rng.gauss(0, 1),) for _ in range(2000)] + [(None,), (float("nan"),)], "x double")
    return drift.reference_bins(past, ["x"])


def written(spark, folder, rows, parts):
    """Files in order of arrival: neighbours in time are shuffled, so files overlap by hours."""
    rng = random.Random(1)
    late = sorted(rows, key=lambda r: r[1] + dt.timedelta(hours=rng.random() * 20))
    size = -(-len(late) // parts)
    for k in range(parts):
        spark.createDataFrame(late[k * size:(k + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_closed_days_equal_the_batch_and_replays_leave_the_same(spark, reference, tmp_path):
    rows = orders(3, 20, 14)
    last = (-1, START + dt.timedelta(days=40), 100.0, 100.0, 0.0)  # closes all real days
    odd = [(-2, None, 1.0, 5.0, 9.0), (-3, START, 0.0, 0.0, None)]
    folder = str(tmp_path / "in")
    stream = written(spark, folder, rows + [(i, t or START, *rest) for i, t, *rest in odd[1:]], 5)
    spark.createDataFrame([odd[0], last], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def drained():
        for job in monitoring.monitor(stream, "at_time", "y", "p", ["x"], reference, out, state, "7 days"):
            job.awaitTermination()
        return {name: sorted(map(str, spark.read.parquet(f"{out}/{name}").collect()))
                for name in ("error", "drift", "batch", "triggers")}
    found = drained()
    batch = spark.createDataFrame(rows + odd, SCHEMA)
    days = {r.day: r for r in metrics.rolling_wape(batch, "at_time", "y", "p").collect()}
    got = {r.day: r for r in spark.read.parquet(f"{out}/error").collect()}
    assert set(got) == set(days) and len(days) == 18 and START.date() + dt.timedelta(days=4) not in got
    assert all(abs(got[d].wape_pct - days[d].wape_pct) < 1e-9 and got[d].breach == days[d].breach for d in days)
    assert sum(r.breach for r in got.values()) > 2
    twin = monitoring.rolling_error(batch, "at_time", "y", "p").collect()
    assert {r.day: round(r.wape_pct, 9) for r in twin} == {d: round(r.wape_pct, 9) for d, r in got.items()}

    whole = {(r.period, r.feature): r for r in monitoring.period_psi(batch, "at_time", ["x"], reference, "7 days").collect()}
    parts = {(r.period, r.feature): r for r in spark.read.parquet(f"{out}/drift").collect()}
    assert parts.keys() == whole.keys() and sum(r.n for r in parts.values()) == len(rows)
    assert all(parts[k].n == whole[k].n and abs(parts[k].psi - whole[k].psi) < 1e-9 for k in parts)
    triggers = spark.read.parquet(f"{out}/triggers").collect()
    assert sorted(t.subject for t in triggers if t.reason == "error") == sorted(str(d) for d, r in got.items() if r.breach)
    assert {t.reason for t in triggers} == {"error", "drift", "batch"}

    # The last commit of each watch is lost, as if the driver had died after writing.
    for source in ("error", "drift", "batch"):
        commits = sorted((tmp_path / "state" / source / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
        lost = commits[-1]
        lost.unlink()
        lost.with_name(f".{lost.name}.crc").unlink(missing_ok=True)
    assert drained() == found


def test_psi_against_stored_bins_equals_psi(spark, reference):
    rng = random.Random(9)
    past = spark.createDataFrame([(rng.gauss(0, 1), float(rng.randint(0, 3))) for _ in range(500)], "x double, k double")
    now = spark.createDataFrame([(rng.gauss(1, 1), float(rng.randint(1, 4))) for _ in range(300)], "x double, k double")
    exact = {r.feature: r.psi for r in drift.psi(drift.labelled(past, now), ["x", "k"]).collect()}
    found = {r.feature: r for r in monitoring.batch_psi(now, ["x", "k"], drift.reference_bins(past, ["x", "k"])).collect()}
    assert exact.keys() == found.keys()
    assert all(abs(found[f].psi - exact[f]) < 1e-12 and found[f].n == 300 for f in exact) and found["x"].breach
    assert monitoring.batch_psi(now.limit(0), ["x"], reference).count() == 0
    assert drift.reference_bins(past.limit(0), ["x"]).count() == 0


def test_a_window_of_zero_values_has_no_ratio(spark):
    row = monitoring.rolling_error(spark.createDataFrame([(1, START, 0.0, 3.0, 0.0)], SCHEMA), "at_time", "y", "p").first()
    assert (row.wape_pct, row.breach) == (None, False)
