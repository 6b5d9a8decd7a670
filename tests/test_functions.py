"""Scalar expressions at their edges."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from basketry.functions.labels import hash_uniform, page_group, shifted_segment, tier_rank, urban_flag
from basketry.functions.numeric import (clip, equal_width_bin, finite_or_zero, haversine_km, ratio,
                                        right_closed_bins, right_closed_bucket, safe_divide, sigmoid)
from basketry.functions.temporal import age_years, parse_time, whole_days


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression).collect()]


def test_clip_keeps_null(spark):
    assert column(spark, [-5.0, 5.0, 50.0, None], "double", clip("x", 0.0, 10.0)) == [0, 5, 10, None]


def test_divisions(spark):
    df = spark.createDataFrame([(6.0, 3.0), (6.0, 0.0), (6.0, -2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [2, 0, 0]
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [2, 6, 6]


def test_finite_or_zero(spark):
    values = [1.5, None, float("nan"), float("inf"), float("-inf")]
    assert column(spark, values, "double", finite_or_zero("x")) == [1.5, 0, 0, 0, 0]


def test_right_closed_labels_at_the_edges(spark):
    label = right_closed_bins("x", [0, 3, 7, 14, math.inf], ["fast", "normal", "slow", "very_slow"])
    assert column(spark, [0, 1, 3, 4, 7, 14, 15, None], "int", label) == [
        "nan", "fast", "fast", "normal", "normal", "slow", "very_slow", "nan"]
    bounded = right_closed_bins("x", [-1, 0, 5, 15, 100], ["none", "low", "medium", "high"])
    assert column(spark, [-1, 0, 5, 15, 100, 101], "int", bounded) == ["nan", "none", "low", "medium", "high", "nan"]


def test_equal_width_bins_at_the_edges(spark):
    low, high = F.lit(0.0), F.lit(10.0)
    assert column(spark, [0.0, 2.0, 9.9, 10.0], "double", equal_width_bin("x", low, high, 5)) == [0, 1, 4, 4]
    assert column(spark, [0.0, 2.0, 2.1, 10.0], "double", right_closed_bucket("x", low, high, 5)) == [1, 1, 2, 5]
    assert column(spark, [3.0], "double", equal_width_bin("x", F.lit(3.0), F.lit(3.0), 5)) == [0]


def test_sigmoid_is_bounded(spark):
    found = column(spark, [0.0, 1e6, -1e6], "double", sigmoid("x"))
    assert found[0] == 0.5 and found[1] == pytest.approx(1 / (1 + math.exp(-20))) and found[2] > 0


def test_haversine_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None), (0.0, 0.0, 0.0, 90.0)],
                               "a double, b double, c double, d double")
    km = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert km == pytest.approx([0, 6371 * math.pi / 2])


def test_whole_days_floor(spark):
    rows = [(dt.datetime(2020, 1, 1, 23), dt.datetime(2020, 1, 2, 1)), (dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 1, 23)),
            (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 3))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(whole_days("a", "b")).collect()] == [0, -1, 2]


def test_age_is_bounded(spark):
    births = [dt.datetime(1900, 1, 1), dt.datetime(2016, 1, 1), dt.datetime(1988, 1, 1)]
    ages = column(spark, births, "timestamp_ntz", age_years("x"))
    assert ages[0] == 70 and ages[1] == 15 and ages[2] == pytest.approx(30, abs=0.01)


def test_parse_time_is_lenient(spark):
    assert column(spark, ["2018-02-03 04:05:06", "soon", None], "string", parse_time("x")) == [
        dt.datetime(2018, 2, 3, 4, 5, 6), None, None]


def test_lookups(spark):
    assert column(spark, ["gold", "platinum", "none", None], "string", tier_rank("x")) == [3, 4, 1, 1]
    assert column(spark, ["São Paulo", "RECIFE", "x", None], "string", urban_flag("x")) == [1, 1, 0, 0]
    assert column(spark, ["search", "page_view", "?"], "string", page_group("x")) == ["/search", "/", None]


def test_hash_uniform_known_value(spark):
    assert column(spark, ["0"], "string", hash_uniform("x"))[0] == pytest.approx(0.8117237398400903)


def test_segment_shift_moves_the_shares(spark):
    df = spark.range(4000)
    labels, shares = ("a", "b", "c", "d"), (0.25, 0.25, 0.25, 0.25)

    def share(shift):
        seg = shifted_segment("id", F.lit(shift), labels, shares)
        return df.where(seg == "d").count() / 4000
    assert share(-0.9) < 0.06 < 0.2 < share(0.0) < 0.3 < 0.4 < share(0.9)
