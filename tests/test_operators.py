"""Quantiles, ordered features, fills, encoders and statistics on small frames."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.operators import encode, stats
from basketry.operators.nulls import fill_by_type, fill_median, null_profile
from basketry.operators.ordered import first_per_key, group_mode, lag_in_key, order_history, running_total
from basketry.operators.quantile import column_quantiles, median, quantiles, value_bins, value_counts
from basketry.operators.sampling import fold_number, split_label, stable_sample, time_split

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
NAMES = [f"q{i}" for i in range(len(PROBS))]


def random_rows(n, seed=7):
    """A third of the rows under one key, values with ties, negatives and far outliers."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 1 / 3 else rng.choice(["a", "b", None])
        value = rng.choice([rng.gauss(0, 1), float(round(rng.uniform(-50, 50))), 1e9 * rng.random(), 3.0, None])
        rows.append((i, key, value))
    return rows


def test_distributed_quantiles_match_numpy(spark):
    rows = random_rows(3000)
    df = spark.createDataFrame(rows, "id int, k string, v double")
    found = {r.k: r for r in quantiles(df, ["k"], "v", PROBS, NAMES).collect()}
    assert set(found) == {"hot", "a", "b", None}
    for key in found:
        values = [v for _, k, v in rows if k == key and v is not None]
        for p, name in zip(PROBS, NAMES):
            assert found[key][name] == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("values", [
    [float(i) for i in range(5000)] + [1e18], [1e6 + i / 5000 for i in range(5000)] + [0.0],
    [float(i) for i in range(5000)] + [float("inf"), float("-inf")], [7.0] * 4000 + [float(i) for i in range(1000)]])
def test_no_bin_holds_most_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("k", F.lit("all"))
    binned, _ = value_bins(value_counts(df, ["k"], "v"), ["k"], 64)
    sizes = [r["count"] for r in binned.groupBy("bin").count().collect()]
    assert sum(sizes) == len(set(values)) and max(sizes) <= 3 * len(set(values)) / 64
    got = quantiles(df, [], "v", PROBS, NAMES).first()
    assert (got[0], got[-1]) == (min(values), max(values))
    assert list(got)[1:-1] == pytest.approx([float(np.quantile(values, p)) for p in PROBS[1:-1]])


def test_quantiles_keep_groups_without_values(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", None), ("b", float("nan")), (None, 5.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    assert {r.k: r.m for r in median(df, ["k"], "v", "m").collect()} == {"a": 2.0, "b": None, None: 5.0}
    assert median(df.where("false"), ["k"], "v", "m").count() == 0


def test_quantile_leaves_out_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,), (4.0,)], "v double")
    assert median(df, [], "v", "m").first().m == 2.5
    empty = quantiles(df.where("v is null"), [], "v", [0.5], ["m"]).collect()
    assert [r.m for r in empty] == [None]


def test_column_quantiles_long_form(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None), (10, 40.0)], "a int, b double")
    row = column_quantiles(df, ["a", "b"], [0.5, 1.0], ["_mid", "_max"]).first()
    assert (row.a_mid, row.a_max, row.b_mid, row.b_max) == (2.5, 10.0, 20.0, 40.0)


@pytest.fixture(scope="module")
def events(spark):
    rng, start = random.Random(3), dt.datetime(2024, 1, 1)
    rows = [(i, 1 if rng.random() < 0.4 else rng.randrange(2, 9),
             start + dt.timedelta(hours=rng.randrange(0, 24 * 20)), rng.randrange(5)) for i in range(800)]
    return spark.createDataFrame(rows, "id int, k int, at timestamp_ntz, v int")


def test_lag_across_buckets_matches_plain_window(events):
    plain = events.withColumn("want", F.lag("at").over(Window.partitionBy("k").orderBy("at", "id")))
    got = lag_in_key(plain, "k", ["at", "id"], "at", "got")
    assert got.where(~F.col("got").eqNullSafe(F.col("want"))).count() == 0
    assert got.count() == 800


def test_running_total_across_buckets_matches_plain_window(events):
    w = Window.partitionBy("k").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = running_total(events.withColumn("want", F.sum("v").over(w)), "k", ["at", "id"], "v", "got")
    assert got.where("got <> want").count() == 0


def test_order_history_matches_plain_window(events):
    w = Window.partitionBy("k").orderBy("at", "id")
    plain = events.withColumns({"n": F.row_number().over(w), "p": F.lag("at").over(w),
                                "f": F.min("at").over(Window.partitionBy("k"))})
    got = order_history(plain, "k", "at", "id", unit="week")
    same = F.col("sequence_no").eqNullSafe(F.col("n")) & F.col("previous_at").eqNullSafe(F.col("p")) \
        & F.col("first_at").eqNullSafe(F.col("f"))
    assert got.where(~same).count() == 0


def test_first_per_key_and_mode_ties(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, 5, None)], "k int, o int, v string")
    assert sorted(map(tuple, first_per_key(df, ["k"], ["o"]).collect())) == [(1, 1, "a"), (2, 5, None)]
    tied = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "b"), ("x", "a"), ("y", None)], "k string, v string")
    assert [tuple(r) for r in group_mode(tied, ["k"], "v", "m").collect()] == [("x", "a")]


def test_fills(spark):
    day = dt.datetime(2020, 1, 1)
    df = spark.createDataFrame(
        [(1, 1.0, "a", day), (2, None, None, None), (3, 4.0, "b", day), (4, 7.0, "b", dt.datetime(2021, 1, 1))],
        "id int, n double, s string, t timestamp_ntz")
    row = fill_by_type(df, ["n", "s", "t"]).where("id = 2").first()
    assert (row.n, row.s, row.t) == (4.0, "unknown", day)
    assert fill_median(df, ["n"]).where("id = 2").first().n == 4.0
    counts = {r["column"]: (r.nulls, r.infinities) for r in null_profile(
        df.withColumn("n", F.when(F.col("id") == 4, float("inf")).otherwise(F.col("n")))).collect()}
    assert counts == {"id": (0, 0), "n": (1, 1), "s": (1, 0), "t": (1, 0)}


def test_fills_take_nan_booleans_and_collections(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, True, [1]), (2.0, None, None), (3.0, True, [2]), (nan, False, None), (nan, None, None)],
                               "n double, b boolean, a array<int>").withColumn("i", F.monotonically_increasing_id())
    rows = fill_by_type(df, ["n", "b", "a"]).orderBy("i").collect()
    assert [r.n for r in rows] == [1, 2, 3, 2, 2] and [r.b for r in rows] == [True, True, True, False, True]
    assert [r.a for r in rows] == [[1], [], [2], [], []]
    assert {r["column"]: r.nulls for r in null_profile(df.drop("i")).collect()} == {"n": 2, "b": 2, "a": 3}
    assert stats.profile(df, "n").first()["median"] == 2


def test_one_hot_drops_unknown_and_ignores_null(spark):
    df = spark.createDataFrame([("a",), ("unknown",), (None,), ("b",)], "c string")
    levels = encode.category_levels(df, ["c"])
    assert [n for _, _, n in encode.one_hot_names(levels)] == ["c_a", "c_b"]
    rows = df.select("c", *[x.alias(n) for n, x in encode.one_hot(levels).items()]).collect()
    assert {r.c: (r.c_a, r.c_b) for r in rows} == {
        "a": (1, 0), "b": (0, 1), "unknown": (0, 0), None: (0, 0)}


def test_one_hot_takes_any_number_of_levels(spark):
    df = spark.range(1200).select(F.col("id").cast("string").alias("c"))
    assert len(encode.category_levels(df, ["c"])["c"]) == 1200


def test_target_encoding_smooths_and_falls_back(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0)], "c string, y double")
    table = encode.fit_target_encoding(train, ["c"], "y", smoothing=2)
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    got = {r.c: r.c_te for r in encode.apply_target_encoding(new, ["c"], table).collect()}
    assert got == pytest.approx({"a": (4 + 2 * 4) / 4, "zzz": 4.0, None: 4.0})


def test_scaling_uses_population_std_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, same double")
    rows = encode.scale(df, ["x", "same"], encode.fit_scaling(df, ["x", "same"])).collect()
    values = np.array([1.0, 3.0, 0.0])
    assert [r.x for r in rows] == pytest.approx(list((values - values.mean()) / values.std()))
    assert [r.same for r in rows] == [0, 0, 0]


def test_skew_histogram_and_correlation(spark):
    xs = [1.0, 2.0, 2.5, 9.0, 4.0]
    df = spark.createDataFrame([(x, 2 * x, 10 - x if x < 9 else None) for x in xs], "x double, y double, z double")
    n, a = len(xs), np.array(xs)
    g1 = ((a - a.mean()) ** 3).mean() / a.std() ** 3
    assert df.agg(stats.adjusted_skew("x").alias("s")).first().s == pytest.approx(
        g1 * (n * (n - 1)) ** 0.5 / (n - 2))
    bins = {r.bin: r.n for r in stats.histogram(df, "x", 4).collect()}
    assert bins == {0: 3, 1: 1, 3: 1} and sum(bins.values()) == n
    r = {(c.column_a, c.column_b): c.r for c in stats.correlation_matrix(df, ["x", "y", "z"]).collect()}
    assert len(r) == 9
    assert r["x", "y"] == pytest.approx(1) and r["z", "x"] == pytest.approx(-1) and r["z", "z"] == 1


def test_box_whiskers(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4, 100)], "g string, x double")
    row = stats.box_stats(df, ["g"], "x").first()
    assert (row.q1, row["median"], row.q3, row.whisker_low, row.whisker_high, row.n_outside) == (2, 3, 4, 1, 4, 1)


def test_splits_are_stable(spark):
    df = spark.range(2000).withColumn("p", split_label("id")).withColumn("f", fold_number("id"))
    test = df.where("p = 'test'").count()
    assert 340 < test < 460
    assert {r.f for r in df.select("f").distinct().collect()} == {0, 1, 2, 3, 4}
    ids = sorted(r.id for r in stable_sample(df, "id", 50).collect())
    assert len(set(ids)) == 50
    assert ids == sorted(r.id for r in stable_sample(df.repartition(7), "id", 50).collect())
    times = spark.createDataFrame([(dt.datetime(2018, 3, 31),), (dt.datetime(2018, 4, 1),)], "t timestamp_ntz")
    before, after = time_split(times, "t", "2018-04-01")
    assert (before.count(), after.count()) == (1, 1)


@pytest.mark.parametrize("limit", [0, 3, 50_000])
def test_quantiles_do_not_depend_on_the_group_limit(spark, monkeypatch, limit):
    from basketry.operators import quantile
    monkeypatch.setattr(quantile, "SMALL_GROUP", limit)
    rng = random.Random(8)
    rows = [(k, rng.choice([None, float("nan"), float("inf"), -1.5, *map(float, range(k))])) for k in (1, 2, 40) for _ in range(90)]
    rows += [(None, 4.0), (None, 5.0), (7, None)]
    found = {r.k: r for r in quantiles(spark.createDataFrame(rows, "k int, v double"), ["k"], "v", PROBS, NAMES).collect()}
    assert set(found) == {1, 2, 40, 7, None} and found[7][NAMES[0]] is None
    for k in (1, 2, 40, None):
        values = [v for key, v in rows if key == k and v is not None and v == v]
        for p, name in zip(PROBS, NAMES):
            finite = sorted(values)
            at = p * (len(finite) - 1)
            low, high = finite[int(at)], finite[min(int(at) + 1, len(finite) - 1)]
            want = low if low == high or at == int(at) else low + (high - low) * (at - int(at))
            assert found[k][name] == pytest.approx(want, rel=1e-12)
