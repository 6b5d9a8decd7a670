"""The whole job on the adapter tables, its reports read back."""

import pytest

from basketry import job
from basketry.plans import validation
from checks.registry import SPLIT, Tables


@pytest.fixture(scope="module")
def t(spark, data):
    return Tables(spark, data)


def test_a_failed_check_stops_the_job(spark, t, tmp_path, monkeypatch):
    failing = spark.createDataFrame([("profile rows", False, 0.0)], "check string, passed boolean, observed double")
    monkeypatch.setattr(validation, "validate", lambda tables: failing)
    assert job.run(spark, t, str(tmp_path)) is False
    assert sorted(p.name for p in tmp_path.iterdir()) == ["validation"]


def test_the_job_writes_all_reports(spark, t, tmp_path, monkeypatch):
    passing = spark.createDataFrame([("profile rows", True, 9.0)], "check string, passed boolean, observed double")
    monkeypatch.setattr(validation, "validate", lambda tables: passing)
    assert job.run(spark, t, str(tmp_path), SPLIT, ["linear", "ridge", "lasso"])
    comparison = spark.read.parquet(f"{tmp_path}/model_comparison")
    rows = {r.model: r for r in comparison.collect()}
    assert set(rows) == {"linear", "ridge", "lasso"}
    inflation = {r.feature: r for r in spark.read.csv(f"{tmp_path}/variance_inflation", header=True, inferSchema=True).collect()}
    matrix = spark.read.parquet(f"{tmp_path}/feature_matrix")
    dropped = {f for f, r in inflation.items() if r.dropped}
    assert dropped and not dropped & set(matrix.columns)
    assert all(r.vif <= 10 for r in inflation.values() if not r.dropped)
    folds = {r.model: r for r in spark.read.csv(f"{tmp_path}/cross_validation", header=True, inferSchema=True).collect()}
    assert set(folds) == {"linear", "ridge", "lasso"} and all(r.folds == 5 for r in folds.values())
    written = spark.read.parquet(f"{tmp_path}/predictions")
    assert written.count() == {r.n for r in rows.values()}.pop()
    best = spark.read.parquet(f"{tmp_path}/model/metrics").first()
    assert best.r2_log == max(r.r2_log for r in rows.values())
    report = spark.read.json(f"{tmp_path}/drift_report").first()
    assert report.n_features == len(matrix.columns) - len(job.KEPT)
    assert spark.read.json(f"{tmp_path}/cleaning_audit").count() == 5
    assert spark.read.json(f"{tmp_path}/kpi_status").count() == 4
