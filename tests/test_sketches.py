"""Sketches by period: merging, adding a day, and drift close to the exact figure."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry.plans import drift, sketches

START = dt.datetime(2021, 3, 1)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = [(START + dt.timedelta(minutes=rng.randint(0, 20 * 1440 - 1)), rng.gauss(0, 1), float(rng.randint(0, 4))) for _ in range(12_000)]
    data = [(t, x + (0.6 if t >= START + dt.timedelta(days=10) else 0.0), s) for t, x, s in data]
    data += [(None, 99.0, 99.0), (START, None, float("nan"))]
    return spark.createDataFrame(data, "t timestamp_ntz, x double, step double")


def test_days_added_one_by_one_equal_one_pass(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    for day in range(20):
        sketches.add_period(rows, "t", ["x", "step"], str((START + dt.timedelta(days=day)).date()), path)
    sketches.add_period(rows, "t", ["x", "step"], "2021-03-05", path)  # again: nothing is counted twice
    stored = sketches.read_sketches(spark, path)
    found = {r.feature: r.n for r in sketches.merged(stored).collect()}
    assert found == {"x": 12_000, "step": 12_000}
    some = {r.feature: r.n for r in sketches.merged(stored, "2021-03-03", "2021-03-06").collect()}
    inside = F.col("t").between(dt.datetime(2021, 3, 3), dt.datetime(2021, 3, 5, 23, 59, 59))
    assert some["x"] == rows.where(inside).count()
    files = sketches.merged(stored, "2021-03-03", "2021-03-04").inputFiles()
    plan = sketches.merged(stored, "2021-03-03", "2021-03-04")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len(files) >= 1


def test_ranks_are_within_the_stated_error(rows):
    whole = sketches.merged(sketches.period_sketches(rows, "t", ["x"]))
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = sketches.sketch_quantiles(whole, probs, [f"q{i}" for i in range(5)]).first()
    values = sorted(r.x for r in rows.where("t IS NOT NULL AND x IS NOT NULL").collect())
    for p, q in zip(probs, list(got)[2:]):
        assert abs(sum(v <= q for v in values) / len(values) - p) < 2.6 / sketches.SIZE


def test_psi_is_close_to_the_exact_one(rows):
    split = "2021-03-11"
    stored = sketches.period_sketches(rows, "t", ["x", "step"])
    got = {r.feature: r.psi for r in sketches.psi_from_sketches(
        sketches.merged(stored, last=split), sketches.merged(stored, first=split)).collect()}
    exact = {r.feature: r.psi for r in drift.psi(drift.labelled_by_time(rows, "t", split), ["x", "step"]).collect()}
    assert exact["x"] > 0.25 and abs(got["x"] - exact["x"]) < 0.05
    assert got["step"] < 0.02
    alone = sketches.psi_from_sketches(sketches.merged(stored, last=split), sketches.merged(stored, first="2030-01-01"))
    assert {r.feature for r in alone.collect()} == {"x", "step"}
    assert sketches.psi_from_sketches(sketches.merged(stored, last="2000-01-01"), sketches.merged(stored)).count() == 0


def test_tests_beside_psi(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=700).round(2), (rng.normal(size=500) + 0.3).round(2)
    kinds = [(True, float(v), "pq"[i % 2] if i else "rare", None) for i, v in enumerate(a)]
    kinds += [(False, float(v), "pq"[i % 3 == 0], 1.0) for i, v in enumerate(b)] + [(True, None, None, None)]
    rows = spark.createDataFrame(kinds, "is_ref boolean, x double, kind string, late double")
    found = drift.numeric_tests(rows, ["x", "late"]).collect()
    r = {f.feature: f for f in found}["x"]
    grid = np.unique(np.concatenate([a, b]))
    f, g = (np.searchsorted(np.sort(v), grid, side="right") / len(v) for v in (a, b))
    assert abs(r.ks - np.abs(f - g).max()) < 1e-12
    assert abs(r.wasserstein - (np.abs(f - g)[:-1] * np.diff(grid)).sum()) < 1e-9
    assert abs(r.wasserstein_norm - r.wasserstein / a.std()) < 1e-9
    x = np.sqrt(700 * 500 / 1200) * r.ks
    assert abs(r.ks_p - 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * x * x) for k in range(1, 100))) < 1e-9
    late = {f.feature: f for f in found}["late"]
    assert (late.n_ref, late.n_cur, late.ks, late.ks_p) == (0, 500, None, None)
    c = drift.category_tests(rows, ["kind"]).first()
    counts = np.array([[349, 333], [350, 167], [1, 0]], dtype=float)  # rare is folded into a cell of its own
    q = sum(1 for i in range(500) if i % 3 == 0)
    counts = np.array([[349.0, 500 - q], [350.0, q], [1.0, 0.0]])
    expected = counts.sum(1, keepdims=True) * counts.sum(0) / counts.sum()
    assert c.cells == 3 and abs(c.chi2 - ((counts - expected) ** 2 / expected).sum()) < 1e-9
    assert abs(c.chi2_p - np.exp(-c.chi2 / 2)) < 1e-12  # two degrees of freedom
    both = {t.feature: t for t in drift.feature_tests(rows, ["x", "kind", "late"]).collect()}
    assert both["x"].drifted and both["kind"].drifted and not both["late"].drifted
    assert both["x"].test == "wasserstein" and both["kind"].test == "chi-square"


@pytest.mark.parametrize("k, x, p", [(1, 3.841458820694124, 0.05), (2, 5.991464547107979, 0.05), (5, 11.070497693516351, 0.05),
                                     (10, 18.307038053275146, 0.05), (3, 0.0, 1.0)])
def test_chi_square_tail(k, x, p):
    assert abs(drift.upper_gamma(k / 2, x / 2) - p) < 1e-9
