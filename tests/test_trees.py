"""Boosted trees against a plain leaf-by-leaf grower, and their explanations."""

import dataclasses

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.operators import trees
from basketry.plans import models, scoring
from checks import boosting


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    n = 900
    x = rng.integers(0, 12, size=(n, 5)).astype(float)
    x[:, 4] = 1.0  # does not vary
    y = np.where(x[:, 0] > 5, 3.0, 0.0) + x[:, 1] * (x[:, 2] < 4) + rng.normal(size=n)
    names = [f"f{i}" for i in range(5)]
    table = spark.createDataFrame([(i, float(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))],
                                  ["order_id", "target_log", *names]).repartition(5)
    return table, names, x, y


def plain_tree(x, g, s):
    """Predictions of one tree grown leaf by leaf, the largest gain first."""
    def shrink(v):
        return np.sign(v) * max(abs(v) - s.l1, 0.0)

    def score(v, n):
        return shrink(v) ** 2 / (n + s.l2)

    def cut(at, depth):
        best = (-np.inf,)
        if depth < s.depth:
            for c in range(x.shape[1]):
                for v in np.unique(x[at, c])[:-1]:
                    low = at[x[at, c] <= v]
                    high = at[x[at, c] > v]
                    if min(len(low), len(high)) >= s.least_rows:
                        gain = score(g[low].sum(), len(low)) + score(g[high].sum(), len(high)) - score(g[at].sum(), len(at))
                        if round(gain, 9) > best[0]:
                            best = (round(gain, 9), low, high)
        return best

    leaves = [(np.arange(len(g)), 0)]
    while len(leaves) < s.leaves:
        cuts = [cut(*leaf) for leaf in leaves]
        k = max(range(len(leaves)), key=lambda i: cuts[i][0])
        if not cuts[k][0] > 1e-9:
            break
        depth = leaves[k][1] + 1
        leaves[k:k + 1] = [(cuts[k][1], depth), (cuts[k][2], depth)]
    return leaves, shrink


@pytest.mark.parametrize("s", [
    trees.Settings(rounds=2, rate=0.5, depth=4, leaves=6, least_rows=15, l1=2.0, l2=1.5),
    trees.Settings(rounds=2, rate=0.3, depth=3, leaves=100, least_rows=5, loss="absolute")])
def test_equals_growing_leaf_by_leaf(rows, s, monkeypatch):
    monkeypatch.setattr(trees, "TREES_PER_COPY", 1)
    monkeypatch.setattr(trees, "FAN_IN", 2)
    monkeypatch.setattr(trees, "COLUMNS_AT_ONCE", 2)
    table, names, x, y = rows
    ensemble = trees.boost(table, names, "target_log", "order_id", s)
    now = np.full(len(y), np.median(y) if s.loss == "absolute" else y.mean())
    for _ in range(s.rounds):
        g = np.sign(now - y) if s.loss == "absolute" else now - y
        leaves, shrink = plain_tree(x, g, s)
        step = np.zeros(len(y))
        for at, _ in leaves:
            step[at] = np.median((y - now)[at]) if s.loss == "absolute" else -shrink(g[at].sum()) / (len(at) + s.l2)
        now = now + s.rate * step
    got = np.array([r[0] for r in table.orderBy("order_id").select(ensemble.prediction()).collect()])
    assert np.allclose(got, now, atol=1e-9)
    assert all(sum(c < 0 for c in t.column) <= s.leaves for t in ensemble.trees)


@pytest.mark.parametrize("s", [
    trees.Settings(rounds=6, rate=0.4, depth=5, leaves=7, least_rows=12, l1=1.0, l2=0.5, row_share=0.7, column_share=0.8),
    trees.Settings(rounds=6, rate=0.3, depth=4, leaves=100, least_rows=5, row_share=0.8, loss="absolute")])
def test_one_task_grows_the_same_trees(rows, s, monkeypatch):
    table, names, x, _ = rows
    table = table.withColumns({"f5": (F.col("f0") > 3).cast("double"), "f6": F.randn(3)})
    names = [*names, "f5", "f6"]
    monkeypatch.setattr(trees, "GATHERED", 400)
    own = trees.boost(table, names, "target_log", "order_id", s)
    monkeypatch.setattr(trees, "FEW", 10)
    apart = trees.boost(table, names, "target_log", "order_id", s)
    for name, value in (("ONE_TASK_CELLS", 0), ("TREES_PER_COPY", 2), ("FAN_IN", 2), ("COLUMNS_AT_ONCE", 2)):
        monkeypatch.setattr(trees, name, value)
    for one, other in ((own, apart), (own, trees.boost(table, names, "target_log", "order_id", s))):
        assert one.base == other.base and len(one.trees) == len(other.trees) == s.rounds
        for a, b in zip(one.trees, other.trees):
            assert (a.column, a.bin, a.left, a.right, a.rows) == (b.column, b.bin, b.left, b.right, b.rows)
            assert np.allclose(a.value, b.value, atol=1e-12)


def test_shares_of_rows_and_columns(rows):
    table, names, _, _ = rows
    s = trees.Settings(rounds=3, depth=2, row_share=0.5, column_share=0.4)
    a, b = (trees.boost(table.repartition(k), names, "target_log", "order_id", s) for k in (2, 6))
    for one, two in zip(a.trees, b.trees):
        assert one.column == two.column and np.allclose(one.value, two.value)
        assert 300 < one.rows[0] < 600
        assert len({c for c in one.column if c >= 0}) <= 2


def test_tuned_settings_are_all_used():
    assert {f.name for f in dataclasses.fields(trees.Settings)} - {"loss", "seed"} == set(fv.TUNED_TREES)
    assert dataclasses.asdict(models.TUNED) | fv.TUNED_TREES == dataclasses.asdict(models.TUNED)


def test_absolute_loss_is_no_worse_than_mllib(rows):
    table, names, _, _ = rows
    s = dataclasses.replace(models.ABSOLUTE, rounds=12, rate=0.3, depth=3)
    own = models.fit_boosted(table, names, s)
    theirs = models.assembled(names, models.boosted(maxIter=12, stepSize=0.3, maxDepth=3)).fit(table)
    mae = [m.transform(table).agg(F.avg(F.abs(F.col("prediction") - F.col("target_log")))).first()[0] for m in (own, theirs)]
    assert mae[0] <= mae[1] * 1.001


def test_save_load_importance_and_table(rows, spark, tmp_path):
    table, names, _, _ = rows
    model = models.fit_boosted(table, names, trees.Settings(rounds=2, depth=2))
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    ensemble = again.stages[-1].ensemble()
    ensemble.table(spark).write.parquet(str(tmp_path / "t"))
    third = trees.Ensemble.of_table(spark.read.parquet(str(tmp_path / "t")))
    sums = [table.select(F.sum(p)).first()[0] for p in
            (model.stages[-1].ensemble().prediction(), ensemble.prediction(), third.prediction())]
    assert sums[0] == sums[1] == sums[2]
    importance = {r.feature: r.importance for r in models.feature_importance(again, names, table).collect()}
    assert set(importance) == set(names) and abs(sum(importance.values()) - 1) < 1e-9 and importance["f4"] == 0


def test_contributions_add_up_and_rank(rows):
    table, names, _, _ = rows
    ensemble = trees.boost(table, names, "target_log", "order_id", trees.Settings(rounds=4, depth=3, rate=0.3))
    got = scoring.tree_contributions(table, "order_id", ensemble, top=5, least=0.0)
    want = {r[0]: r[1] for r in table.select("order_id", ensemble.prediction()).collect()}
    by_row: dict[int, list] = {}
    for r in got.collect():
        by_row.setdefault(r.order_id, []).append(r)
    assert set(by_row) == set(want)
    for key, parts in by_row.items():
        assert abs(parts[0].base_log + sum(p.contribution for p in parts) - want[key]) < 1e-9
        sizes = [abs(p.contribution) for p in sorted(parts, key=lambda p: p["rank"])]
        assert sizes == sorted(sizes, reverse=True)
    mean = sum(want.values()) / len(want)
    assert abs(ensemble.expected - mean) < 1e-6  # all rows were sampled


def test_forest_is_explained(rows, spark):
    table, names, _, _ = rows
    fitted = models.assembled(names, models.forest(numTrees=3, maxDepth=3)).fit(table)
    found = scoring.explained(fitted, table, names, table)
    want = {r.order_id: r.prediction for r in fitted.transform(table).collect()}
    for r in found.collect():
        assert abs(r.predicted_log - want[r.order_id]) < 1e-9


def test_odd_features_and_labels(spark):
    table = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 1.0), (3, None, 5.0), (None, 4.0, float("inf")), (5, 9.0, 3.0)] * 3,
                                  "order_id long, target_log double, a double")
    ensemble = trees.boost(table, ["a"], "target_log", "order_id", trees.Settings(rounds=1, rate=1.0, depth=2, least_rows=1))
    got = {tuple(r) for r in table.select("a", F.round(ensemble.prediction(), 6)).collect()}
    assert got == {(None, 2.5), (1.0, 2.0), (5.0, 9.0), (float("inf"), 2.5), (3.0, 9.0)}
    with pytest.raises(ValueError):
        trees.boost(table.limit(0), ["a"], "target_log", "order_id")
    with pytest.raises(ValueError):
        trees.Settings(loss="huber")


def test_queries_boost_all_rounds(rows, monkeypatch):
    table, names, _, _ = rows
    seen = []
    monkeypatch.setattr(boosting, "split_matrix", lambda t: (table, table, names))
    monkeypatch.setattr(models.trees, "boost", lambda df, columns, label, key, settings: seen.append(settings) or trees.Ensemble(
        list(columns), 0.0, []))
    boosting.boosted_metrics(None)
    boosting.tuned_metrics(None)
    assert [(s.rounds, s.loss) for s in seen] == [(300, "absolute"), (fv.TUNED_TREES["rounds"], "squared")]
