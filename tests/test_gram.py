"""One-scan moments and the linear models on them, against numpy and MLlib."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from basketry.operators import gram
from basketry.operators.sampling import fold_number
from basketry.plans import features, models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 1_200
    x = rng.normal(size=(n, 40)) * rng.uniform(0.5, 3, 40) + rng.normal(size=40) * 100
    x[:, 5] = (x[:, 5] > x[:, 5].mean()).astype(float)
    y = x[:, :8] @ np.arange(-4, 4) / 4 + rng.normal(size=n) + 1e4
    table = spark.createDataFrame([(i, float(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))],
                                  ["id", "target_log", *(f"f{i}" for i in range(40))]).repartition(7)
    return table, [f"f{i}" for i in range(40)], x, y


def test_moments_equal_numpy(rows, monkeypatch):
    table, names, x, y = rows
    monkeypatch.setattr(gram, "FAN_IN", 2)
    whole = gram.moments(table, [*names, "target_log"])[0]
    both = np.column_stack([x, y])
    assert whole.n == len(y)
    assert np.allclose(whole.mean, both.mean(axis=0), rtol=1e-12)
    assert np.allclose(whole.cross, np.cov(both.T, ddof=0) * len(y), rtol=1e-9, atol=1e-6)
    parts = gram.moments(table, [*names, "target_log"], fold_number("id"))
    assert set(parts) == set(range(5))
    summed = gram.total(parts)
    assert np.allclose(summed.cross, whole.cross, rtol=1e-9, atol=1e-6)
    fold = np.array([r[0] for r in table.orderBy("id").select(fold_number("id")).collect()])
    rest = both[fold != 2]
    less = whole - parts[2]
    assert less.n == len(rest) and np.allclose(less.mean, rest.mean(axis=0))
    assert np.allclose(less.cross, np.cov(rest.T, ddof=0) * len(rest), rtol=1e-8, atol=1e-5)
    assert np.allclose(less.of(["f3", "f1"]).cross[0, 1], less.cross[3, 1])


def test_lines_equal_mllib(rows):
    table, names, _, _ = rows
    lines = models.fit_lines(table, names)
    theirs = {"linear": models.linear(), "ridge": models.ridge(table), "lasso": models.lasso(tol=1e-12)}
    for name, estimator in theirs.items():
        fitted = models.assembled(names, estimator).fit(table).stages[-1]
        own = lines[name].stages[-1].line()
        assert np.allclose(own.coefficients, fitted.coefficients.toArray(), atol=1e-6), name
        assert abs(own.intercept - fitted.intercept) < 1e-4 * abs(fitted.intercept)


def test_cross_validation_equals_mllib(rows):
    table, names, _, _ = rows
    mean, spread = models.cross_validate(table, names, models.linear(), "id")
    own = {r.model: r for r in gram.cross_validated(table, names, "target_log", fold_number("id")).collect()}
    assert set(own) == set(gram.SOLVERS)
    assert abs(own["linear"].mae_mean - mean) < 1e-6 and abs(own["linear"].mae_std - spread) < 1e-6


def test_saved_lines_predict_the_same(rows, tmp_path):
    table, names, _, _ = rows
    model = models.fit_lines(table, names, ["ridge"])["ridge"]
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = (m.transform(table).agg(F.sum("prediction"), F.min("prediction")).first() for m in (model, again))
    assert a == b


def test_dependent_and_constant_columns(spark):
    table = spark.createDataFrame([(float(i), float(2 * i), 5.0, None, 3.0 * i + 1) for i in range(20)],
                                  "a double, b double, c double, d double, target_log double")
    for name, model in models.fit_lines(table, ["a", "b", "c", "d"]).items():
        error = model.transform(table).agg(F.max(F.abs(F.col("prediction") - F.col("target_log")))).first()[0]
        assert error < {"linear": 1e-9, "ridge": 0.05, "lasso": 0.2}[name]
    found = {r.feature: r.dropped for r in features.vif(table, ["a", "b", "c"]).collect()}
    assert found == {"a": False, "b": True, "c": False}


def test_null_labels_and_empty_tables(spark):
    table = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, None), (3, float("nan"), 4.0), (4, 4.0, 5.0)],
                                  "id long, a double, target_log double")
    line = models.fit_lines(table, ["a"], ["linear"])["linear"].stages[-1].line()
    slope = np.polyfit([1.0, 0.0, 4.0], [2.0, 4.0, 5.0], 1)  # NaN counts as 0
    assert np.allclose([line.coefficients[0], line.intercept], slope)
    assert gram.moments(table.limit(0), ["a"]) == {}
    with pytest.raises(ValueError):
        gram.total({})
    with pytest.raises(ValueError):
        gram.cross_validated(table, ["a"], "target_log", F.lit(0))
