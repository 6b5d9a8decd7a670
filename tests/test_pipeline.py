"""Sources and sinks, saved artifacts, models, scoring, drift, validation and streams."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.operators.quantile import scalars
from basketry.plans import drift, eda, facts, features, legacy, metrics, modeling, models, scoring, validation
from basketry.sources import tables
from basketry.sources.schemas import RAW_TABLES
from checks.star import StarTables
from basketry.streaming.activity import session_rollup, write_rollup
from basketry.streaming.scoring import score_stream
from checks import modelling, profiling
from checks.registry import SPLIT, Tables


@pytest.fixture(scope="module")
def t(spark, data):
    return Tables(spark, data)


@pytest.fixture(scope="module")
def dataset(t):
    from basketry.session import cut_lineage
    return cut_lineage(modeling.modeling_dataset(t))


@pytest.fixture(scope="module")
def fitted(t):
    return modelling.request_model(t)


# --- sources and sinks


def test_csv_roundtrip_with_declared_types_and_pruning(spark, tmp_path):
    rows = [("o1", "c1", "delivered", dt.datetime(2018, 1, 2, 3, 4, 5), None, None, None, None)]
    df = spark.createDataFrame(rows, RAW_TABLES["orders"])
    tables.write_csv(df, str(tmp_path / "orders"))
    back = tables.read_csv(spark, str(tmp_path / "orders"), RAW_TABLES["orders"])
    assert back.schema == df.schema and back.collect() == df.collect()
    slim = tables.read_csv(spark, str(tmp_path / "orders"), RAW_TABLES["orders"], ["order_id", "order_status"])
    assert slim.columns == ["order_id", "order_status"]
    plan = slim._jdf.queryExecution().toString()
    assert "ReadSchema: struct<order_id:string,order_status:string>" in plan
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(tmp_path / "orders"), RAW_TABLES["items"])


def test_commerce_folder_gives_the_same_dataset(spark, t, dataset, tmp_path):
    """CSV and parquet files in the documented form, read back and merged."""
    from pyspark.sql.types import TimestampNTZType
    from basketry.sources.schemas import BEHAVIOUR_TABLES

    def shaped(df, schema):
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in schema])
    for name, schema in RAW_TABLES.items():
        if name != "behavioral_sessions":
            # Ids are text here and sort differently, so duplicate lines are settled first.
            frame = shaped(facts.dedup_items(t[name]) if name == "items" else t[name], schema)
            times = [f.name for f in schema if isinstance(f.dataType, TimestampNTZType)]
            tables.write_csv(frame.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in times})
                             if times else frame, str(tmp_path / f"{name}.csv"))
    for name, schema in BEHAVIOUR_TABLES.items():
        source = t["profile" if name == "customer_profile" else name]
        tables.write_parquet(shaped(source, schema), str(tmp_path / f"{name}.parquet"))
    again = modeling.modeling_dataset(tables.read_commerce(spark, str(tmp_path), str(tmp_path)))
    assert set(again.columns) == set(dataset.columns)
    measures = ["order_value", "item_count", "frequency", "total_cart_qty", "geo_lat", "cat_std_price", "review_score"]

    def rows(df):
        return df.select(F.col("order_id").cast("string"), *[F.round(F.col(c).cast("double"), 6).alias(c)
                                                             for c in measures])
    assert rows(again).exceptAll(rows(dataset)).isEmpty() and again.count() == dataset.count()


def test_parquet_and_json_roundtrip(spark, t, tmp_path):
    tables.write_parquet(t["profile"], str(tmp_path / "p"))
    back = tables.read_parquet(spark, str(tmp_path / "p"))
    assert back.exceptAll(t["profile"]).isEmpty() and back.count() == t["profile"].count()
    audit = modeling.cleaning_audit(t)
    tables.write_json(audit, str(tmp_path / "audit"))
    lines = [json.loads(x) for f in (tmp_path / "audit").glob("part-*") for x in f.read_text().splitlines()]
    assert {x["step"] for x in lines} == {r.step for r in audit.collect()}


def test_filters_and_columns_reach_the_scan(spark, data):
    df = StarTables(spark, data).orders.where("order_id > 100").select("order_id", "customer_id")
    plan = df._jdf.queryExecution().toString()
    assert "GreaterThan(o_orderkey,100)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


# --- modeling dataset and features


def test_modeling_dataset_contract(dataset, t):
    assert len(dataset.columns) == 73
    row = dataset.agg(F.count("*").alias("n"), F.countDistinct("order_id").alias("d"), F.min("order_value").alias("low"),
                      F.sum("item_count").alias("items"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}")
                                                            for c in dataset.columns]).first()
    assert row.n == row.d > 0 and row.low > 0
    assert all(row[f"null_{c}"] == 0 for c in dataset.columns)
    kept = facts.kept_orders(t["orders"]).select("order_id")
    assert row["items"] == facts.dedup_items(t["items"]).join(kept, "order_id", "left_semi").count()


def test_features_have_no_leakage_nulls_or_infinities(dataset):
    df = features.engineer_features(features.with_target(dataset))
    pre = features.fit_preprocessor(df, SPLIT)
    matrix = features.assert_no_leakage(pre.apply(df))
    assert len(pre.feature_names) == len(set(pre.feature_names)) >= 100
    assert not set(fv.LEAKAGE_COLUMNS) & set(matrix.columns)
    bad = matrix.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))).alias(c)
                       for c in matrix.columns]).first()
    assert sum(bad) == 0
    groups = {r.feature_group: r["count"] for r in features.feature_catalog(
        matrix.sparkSession, pre).groupBy("feature_group").count().collect()}
    assert groups["numeric"] == 47 and groups["boolean"] == 3 and groups["target encoded"] == 3
    with pytest.raises(ValueError):
        features.assert_no_leakage(dataset)


def test_preprocessor_save_and_load(spark, fitted, t, tmp_path):
    pre, _ = fitted
    pre.save(str(tmp_path))
    again = features.Preprocessor.load(spark, str(tmp_path))
    assert again.feature_names == pre.feature_names
    rows = scoring.request_features(modelling.requests(t)).limit(20)
    assert again.apply(rows, ["order_id"]).exceptAll(pre.apply(rows, ["order_id"])).isEmpty()


def test_vif_drops_a_dependent_column(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=400), rng.normal(size=400)
    df = spark.createDataFrame([(float(x), float(y), float(x + y), float(z)) for x, y, z in zip(
        a, b, rng.normal(size=400))], "a double, b double, total double, c double")
    got = {r.feature: (r.vif, r.dropped) for r in features.vif(df, ["a", "b", "total", "c"]).collect()}
    assert sum(dropped for _, dropped in got.values()) == 1 and not got["c"][1]
    kept = [c for c in got if not got[c][1]]
    corr = np.corrcoef(np.array([[r[c] for c in kept] for r in df.collect()]).T)
    assert [got[c][0] for c in kept] == pytest.approx(list(np.diag(np.linalg.inv(corr))), rel=1e-6)


def test_legacy_labels_and_thresholds(spark):
    rows = [(float(v), s, s // 100, 2, 10, float(d)) for v, s, d in ((100, 400, 0), (50, 800, 3), (10, 1200, 20))]
    df = spark.createDataFrame(rows, "order_value double, session_duration_seconds int, pages_viewed int, "
                                     "cart_additions int, discount_amount_pct int, delivery_days double")
    out = legacy.transform(df, legacy.fit_thresholds(df)).orderBy("session_duration_seconds").collect()
    assert [r.delivery_speed for r in out] == ["nan", "fast", "very_slow"]
    assert [r.is_high_value_session for r in out] == [0, 0, 1]
    assert out[0].estimated_discount_value == 10


# --- models


def test_models_beat_the_median_and_compare(t, spark, tmp_path):
    train, test = modelling.parts(t)
    found, rows = models.fit_and_measure(train, test, modelling.MODEL_FEATURES, {
        "ridge": models.ridge(train), "lasso": models.lasso(),
        "boosted": models.boosted(maxIter=5, maxDepth=3, stepSize=0.3)})
    scores = {r.model: r for r in rows.collect()}
    middle = train.agg(F.median("target_log").alias("m"))
    flat = test.withColumn("prediction", scalars(middle)["m"])
    base = metrics.regression_metrics(flat, "target_log", "prediction").first()
    assert scores["ridge"].mae_log < base.mae_log and scores["boosted"].mae_log < base.mae_log
    best = metrics.best_model(rows).first().model
    assert scores[best].r2_log == max(r.r2_log for r in scores.values())
    tables.save_model(found[best], rows.where(F.col("model") == best), str(tmp_path))
    model, saved = tables.load_model(spark, str(tmp_path))
    assert saved.first().model == best
    assert model.transform(test).select("prediction").exceptAll(
        found[best].transform(test).select("prediction")).isEmpty()
    finite = model.transform(test).where(F.isnan("prediction") | (F.expm1("prediction") <= 0)).count()
    assert finite == 0


def test_cross_validation_and_tuning(t):
    train, _ = modelling.parts(t)
    mean, std = models.cross_validate(train, modelling.MODEL_FEATURES, models.ridge(train), "order_id")
    assert 0 < std < mean
    best, mae = models.tune(train, modelling.MODEL_FEATURES, trials=2, rounds=(2, 3))
    assert set(best) >= {"maxIter", "maxDepth", "stepSize"} and mae > 0


def test_importance_and_column_sets(t):
    train, _ = modelling.parts(t)
    forest = models.assembled(modelling.MODEL_FEATURES, models.forest(numTrees=5, maxDepth=4)).fit(train)
    table = models.feature_importance(forest, modelling.MODEL_FEATURES, train)
    assert table.count() == len(modelling.MODEL_FEATURES)
    assert models.top_features(table, 1) == ["item_count"]
    assert models.missing_columns(["item_count", "gone"], train.select("item_count", "order_id")) == (
        ["gone"], ["order_id"])


def test_contributions_add_up(t):
    train, test = modelling.parts(t)
    fit = models.assembled(modelling.MODEL_FEATURES, models.linear()).fit(train)
    means = train.agg(*[F.avg(c).alias(c) for c in modelling.MODEL_FEATURES]).first().asDict()
    rows = scoring.linear_contributions(test, "order_id", modelling.MODEL_FEATURES, fit.stages[-1], means)
    sums = rows.groupBy("order_id", "base_log", "predicted_log").agg(
        F.sum("contribution").alias("c"), F.max("rank").alias("k"))
    joined = sums.join(fit.transform(test).select("order_id", "prediction"), "order_id").collect()
    assert max(abs(r.predicted_log - r.prediction) for r in joined) < 1e-9
    assert max(abs(r.base_log + r.c - r.predicted_log) for r in joined) < 0.01
    assert max(r.k for r in joined) <= 10


def test_high_profile_scores_above_low_profile(spark, fitted):
    pre, model = fitted
    columns = ("order_id int, monthly_income double, household_size long, loyalty_tier string, device_type string, "
               "session_duration_min double, item_count long, n_events long, n_product_views long, n_searches long, "
               "total_cart_qty long, avg_scroll double, avg_page_duration double, purchase_hour int, purchase_dow int")
    rows = [(1, 800.0, 1, "bronze", "mobile", 5.0, 1, 3, 1, 0, 1, 20.0, 10.0, 10, 1),
            (2, 9000.0, 4, "platinum", "desktop", 50.0, 8, 9, 4, 2, 12, 60.0, 200.0, 20, 6),
            (3, 10.0, 4, "gold", "desktop", 50.0, 8, 9, 4, 2, 12, 60.0, 200.0, 25, 6)]
    scored, rejected = scoring.score_orders(spark.createDataFrame(rows, columns), "order_id", pre, model)
    found = {r.order_id: r for r in scored.collect()}
    assert set(found) == {1, 2}
    assert found[2].predicted_value > 2 * found[1].predicted_value
    assert all(r.lower_value < r.predicted_value < r.upper_value for r in found.values())
    assert [sorted(r.violations) for r in rejected.collect()] == [["monthly_income", "purchase_hour"]]


def test_actions(spark):
    df = spark.createDataFrame([(250.0, "gold", True, 10.0), (20.0, "bronze", False, 0.0), (100.0, "silver", False, 0.0)],
                               "v double, loyalty_tier string, coupon_applied boolean, discount_amount_pct double")
    out = scoring.recommended_actions(df, "v")
    assert [r.actions for r in out.collect()] == [["HIGH VALUE", "LOYALTY", "COUPON"], ["LOW VALUE"], []]


def test_run_summary(spark):
    runs = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "model string, mae double")
    got = {r.model: (r.runs, r.mae_mean, r.mae_std) for r in metrics.run_summary(runs, "model", ["mae"]).collect()}
    assert got["a"] == (2, 2.0, pytest.approx(2 ** 0.5)) and got["b"] == (1, 5.0, None)


def test_rolling_error_spans_seven_calendar_days(spark):
    days = [(dt.datetime(2020, 1, d), 100.0, 100.0 + e) for d, e in ((1, 70), (7, 10), (8, 20), (30, 5))]
    df = spark.createDataFrame(days, "t timestamp_ntz, y double, p double")
    got = {r.day.day: (round(r.wape_pct, 6), r.breach) for r in metrics.rolling_wape(df, "t", "y", "p").collect()}
    assert got == {1: (70.0, True), 7: (40.0, True), 8: (15.0, False), 30: (5.0, False)}


# --- drift and validation


def test_psi_and_ks_by_brute_force(spark):
    rng = random.Random(11)
    old = [(rng.gauss(0, 1), float(rng.randrange(3))) for _ in range(600)]
    new = [(rng.gauss(0.5, 1), float(rng.randrange(3))) for _ in range(400)]
    kind = "x double, step double"
    reference, current = spark.createDataFrame(old, kind), spark.createDataFrame(new, kind)
    got = {r.feature: r.psi for r in drift.psi(drift.labelled(reference, current), ["x", "step"]).collect()}
    gaps = {r.feature: r.ks for r in drift.ks_distance(drift.labelled(reference, current), ["x", "step"]).collect()}
    for i, name in enumerate(("x", "step")):
        a, b = np.array([r[i] for r in old]), np.array([r[i] for r in new])
        inner = np.percentile(a, np.arange(10, 100, 10))
        counts = [np.bincount(np.searchsorted(inner, v, side="right"), minlength=10) for v in (a, b)]
        r, c = ((n + 1) / (n.sum() + 10) for n in counts)
        assert got[name] == pytest.approx(float(((c - r) * np.log(c / r)).sum()))
        points = np.concatenate([a, b])
        cdf = [np.searchsorted(np.sort(v), points, side="right") / len(v) for v in (a, b)]
        assert gaps[name] == pytest.approx(float(np.abs(cdf[0] - cdf[1]).max()))
    same = drift.psi(drift.labelled(reference, reference), ["x", "step"]).collect()
    assert all(abs(r.psi) < 1e-12 for r in same)
    empty = drift.psi(drift.labelled(reference, current.where("x > 1e9")), ["x", "step"])
    found = {r.feature: r.psi for r in empty.collect()}
    assert found["x"] == pytest.approx(0) and found["step"] > 0  # even bins against none at all
    report = drift.drift_report(drift.psi(drift.labelled(reference, current.withColumn("x", F.col("x") + 3)), ["x", "step"]))
    row = report.first()
    assert row.n_features == 2 and row.n_drifted == 1 and row.retrain and row.top_features == "x,step"


def test_validation_passes_on_a_clean_set_and_flags_faults(spark, t):
    start = dt.datetime(2020, 1, 1)
    n = 40
    income = [1000.0 + 100 * ((i * 7) % 40) for i in range(n)]
    tier = [fv.LOYALTY_TIERS[i // 10] for i in range(n)]
    clean = {
        "profile": spark.createDataFrame([(i, income[i], 1 + i % 10, tier[i]) for i in range(n)],
                                         "customer_id int, monthly_income double, household_size int, loyalty_tier string"),
        "customers": spark.createDataFrame([(i, i) for i in range(n)], "customer_id int, customer_unique_id int"),
        "orders": spark.createDataFrame([(i, i) for i in range(n)], "order_id int, customer_id int"),
        "items": spark.createDataFrame([(i, 10.0 + i // 10 * 5 + ((i * 7) % 40) / 5 + (5 if i % 2 else 0), 1.0) for i in range(n)],
                                       "order_id int, price double, freight_value double"),
        "sessions": spark.createDataFrame(
            [(i, i, i, start, start + dt.timedelta(hours=1), "desktop" if i % 2 else "mobile") for i in range(n)],
            "session_id int, customer_id int, order_id int, session_start timestamp_ntz, session_end timestamp_ntz, device_type string"),
        "session_activity": spark.createDataFrame(
            [(i * 3 + j, i, start + dt.timedelta(minutes=20 * j), kind, int(kind == "add_to_cart"))
             for i in range(n) for j, kind in enumerate(("page_view", "add_to_cart", "checkout"))],
            "activity_id int, session_id int, activity_timestamp timestamp_ntz, activity_type string, add_to_cart_quantity int"),
    }
    rows = {r["check"]: r for r in validation.validate(clean).collect()}
    assert len(rows) == 16
    assert {c for c, r in rows.items() if not r.passed} <= {"income follows value"}
    broken = {**clean, "profile": clean["profile"].withColumn("monthly_income", F.lit(None).cast("double")),
              "session_activity": clean["session_activity"].where("activity_type <> 'checkout'")}
    report = validation.validate(broken)
    failed = {r["check"] for r in report.where("not passed").collect()}
    assert failed >= {"income in range", "checkout in every session", "events per session", "income follows value"}
    assert not validation.all_passed(report)


def test_cart_reconcile_without_cart_event(spark):
    events = spark.createDataFrame([(1, 1, "page_view", 0), (2, 1, "search", 0), (3, 2, "add_to_cart", 1), (4, 2, "checkout", 0)],
                                   "activity_id int, session_id int, activity_type string, add_to_cart_quantity int")
    wanted = spark.createDataFrame([(2, 3)], "session_id int, item_count int")
    got = {r.activity_id: (r.activity_type, r.add_to_cart_quantity)
           for r in facts.reconciled_cart(events, wanted, ["activity_id"]).collect()}
    assert got == {1: ("add_to_cart", 1), 2: ("search", 0), 3: ("add_to_cart", 3), 4: ("checkout", 0)}


# --- streams


def test_stream_rollup_matches_batch(spark, t, tmp_path):
    events = t["events"].withColumn("add_to_cart_quantity", F.col("add_to_cart_quantity").cast("int"))
    # A far later event closes the last real sessions.
    last = events.limit(1).withColumns({"activity_timestamp": F.lit("2030-01-01").cast("timestamp_ntz"),
                                        "customer_id": F.lit(-1).cast("long")})
    events.orderBy("activity_timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    last.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    job = write_rollup(session_rollup(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    job.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).where("customer_id >= 0")
    batch = session_rollup(events)
    assert got.count() == batch.count() == t["event_sessions"].count()
    assert got.select(batch.columns).exceptAll(batch).isEmpty()


def test_stream_scoring_matches_batch_and_replays(spark, t, fitted, tmp_path):
    pre, model = fitted
    rows = modelling.requests(t)
    rows.coalesce(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    score_stream(stream, "order_id", pre, model, str(tmp_path / "ok"), str(tmp_path / "bad"),
                 str(tmp_path / "state")).awaitTermination()
    scored, rejected = scoring.score_orders(rows, "order_id", pre, model)
    got = spark.read.parquet(str(tmp_path / "ok")).drop("batch")
    assert got.count() == scored.count() > 0 and got.exceptAll(scored).isEmpty()
    assert spark.read.parquet(str(tmp_path / "bad")).count() == rejected.count() > 0


def test_profiling_fixture_levels_are_complete(t):
    levels = profiling.encode.category_levels(t["sessions"], ["device_type", "browser"])
    assert levels["device_type"] == list(profiling._LEVELS["device_type"])
    assert eda.delivered(t["orders"]).count() > 0
