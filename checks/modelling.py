"""Metrics, monitoring, validation and model queries."""

from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.operators import stats
from basketry.operators.encode import fit_scaling, scale
from basketry.operators.sampling import stable_sample, time_split
from basketry.plans import drift, eda, facts, features, metrics, modeling, models, scoring, sketches, validation
from basketry.session import cut_lineage
from checks.profiling import _box_sql
from checks.relational import MODEL_COLUMNS, modeling_sql
from checks.registry import SPLIT, query, rounded

# --- metrics on formula predictions: the customer's mean value (p) and mean log value (pl)


def predicted(t):
    kept = facts.kept_orders(t["orders"])
    values = facts.valued_orders(facts.order_value(facts.dedup_items(t["items"])), kept)
    df = values.join(kept.select("order_id", "customer_id", "order_purchase_timestamp"), "order_id")
    cents = F.round(F.col("order_value") * 100).cast("long")
    means = df.groupBy(F.col("customer_id").alias("c")).agg(
        (F.sum(cents) / F.count("*") / 100.0).alias("p"), F.avg(F.log1p("order_value")).alias("pl"))
    return df.join(means, F.col("customer_id") == F.col("c")).select(
        "order_id", "customer_id", "order_purchase_timestamp", F.col("order_value").alias("y"), "p",
        F.log1p("order_value").alias("yl"), "pl")


def _metric_sql(keys: str = "") -> str:
    return f"""
    SELECT {keys} count(*) AS n, round(sqrt(avg((yl - pl) * (yl - pl))), 6) AS rmse_log, round(avg(abs(yl - pl)), 6) AS mae_log,
      round(1 - sum((yl - pl) * (yl - pl)) / (var_pop(yl) * count(*)), 6) AS r2_log,
      round(sqrt(avg((ye - pe) * (ye - pe))), 3) AS rmse, round(avg(abs(ye - pe)), 3) AS mae,
      round(sum(abs(ye - pe)) / sum(abs(ye)) * 100, 6) AS wape_pct, round(median(ape), 6) AS medape_pct,
      round(avg(least(ape, 1000)), 6) AS mape_pct, round(avg(ye - pe), 3) AS mean_error,
      round(stddev_samp(ye - pe), 3) AS std_error FROM v_ape"""


def _metric_columns(df, *keys):
    digits = {"rmse": 3, "mae": 3, "mean_error": 3, "std_error": 3}
    names = ("n", "rmse_log", "mae_log", "r2_log", "rmse", "mae", "wape_pct", "medape_pct", "mape_pct",
             "mean_error", "std_error")
    return df.select(*keys, *[F.col(c) if c == "n" else F.round(c, digits.get(c, 6)).alias(c) for c in names])


@query("regression_metrics", _metric_sql())
def _(t):
    return _metric_columns(metrics.regression_metrics(predicted(t), "yl", "pl"))


@query("performance_by_period", _metric_sql("period,") + " GROUP BY period")
def _(t):
    period = F.when(F.col("order_purchase_timestamp") < F.lit(SPLIT).cast("timestamp_ntz"),
                    "reference").otherwise("current")
    df = predicted(t).withColumn("period", period)
    return _metric_columns(metrics.regression_metrics(df, "yl", "pl", ["period"]), "period")


@query("regression_metrics_legacy", """
    SELECT round(avg(abs(y - p)), 3) AS mae, round(sum(abs(y - p)) / sum(y), 6) AS wape,
      round(median(abs((y - p) / greatest(y, 1e-8))), 6) AS medape FROM v_pred""")
def _(t):
    out = metrics.regression_metrics_legacy(predicted(t), "y", "p")
    return out.select(F.round("mae", 3).alias("mae"), F.round("wape", 6).alias("wape"),
                      F.round("medape", 6).alias("medape"))


@query("kpi_status", """
    WITH m AS (SELECT avg(abs(ye - pe)) AS mae, sum(abs(ye - pe)) / sum(abs(ye)) * 100 AS wape,
      median(ape) AS medape, avg(least(ape, 1000)) AS mape FROM v_ape)
    SELECT 'MAE' AS kpi, 25e0 AS target, round(mae, 3) AS achieved, mae < 25 AS met FROM m
    UNION ALL SELECT 'WAPE', 16e0, round(wape, 3), wape < 16 FROM m
    UNION ALL SELECT 'MedAPE', 12e0, round(medape, 3), medape < 12 FROM m
    UNION ALL SELECT 'MAPE', 15e0, round(mape, 3), mape < 15 FROM m""")
def _(t):
    return rounded(metrics.kpi_status(metrics.regression_metrics(predicted(t), "yl", "pl")), 3)


_BUCKETED = """b AS (SELECT order_id, yl, pl, ye, pe, yl - pl AS residual_log, ye - pe AS residual,
      greatest(CAST(ceil((ye - min(ye) OVER ()) / (max(ye) OVER () - min(ye) OVER ()) * 5) AS INT), 1) AS bucket
    FROM v_ape)"""


@query("residual_buckets", f"""
    WITH {_BUCKETED} SELECT order_id, bucket, round(yl, 6) AS y_log, round(pl, 6) AS predicted_log,
      round(residual_log, 6) + 0e0 AS residual_log, round(ye, 2) AS y, round(pe, 3) AS predicted,
      round(residual, 3) + 0e0 AS residual FROM b""")
def _(t):
    table = metrics.residual_buckets(metrics.residuals(predicted(t), "yl", "pl", ["order_id"]))
    digits = {"y": 2, "predicted": 3, "residual": 3}
    return table.select("order_id", "bucket", *[
        (F.round(c, digits.get(c, 6)) + 0.0).alias(c)
        for c in ("y_log", "predicted_log", "residual_log", "y", "predicted", "residual")])


@query("residual_box", "WITH " + _BUCKETED + _box_sql("b", "bucket", "residual", "bucket").replace(", 4)", ", 3)"))
def _(t):
    table = metrics.residual_buckets(metrics.residuals(predicted(t), "yl", "pl", ["order_id"]))
    box = stats.box_stats(table, ["bucket"], "residual")
    return rounded(box.select(F.lit("bucket").alias("segment"), F.col("bucket").cast("string").alias("level"),
                              *box.columns[1:]), 3)


@query("rolling_wape_7d", """
    WITH d AS (SELECT CAST(order_purchase_timestamp AS DATE) AS day, sum(abs(y - p)) AS e, sum(y) AS v
      FROM v_pred GROUP BY 1),
    w AS (SELECT day, sum(e) OVER k / sum(v) OVER k * 100 AS wape
      FROM d WINDOW k AS (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW))
    SELECT strftime(day, '%Y-%m-%d') AS day, round(wape, 5) AS wape_pct, wape > 18 AS breach FROM w""")
def _(t):
    out = metrics.rolling_wape(predicted(t), "order_purchase_timestamp", "y", "p")
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("wape_pct", 5).alias("wape_pct"),
                      "breach")


# --- serving


@query("prediction_band", """
    SELECT order_id, round(exp(pl) - 1, 2) AS predicted_value, round(pl, 4) AS predicted_log,
      round(exp(pl - 1.28e0 * 0.35e0) - 1, 2) AS lower_value, round(exp(pl + 1.28e0 * 0.35e0) - 1, 2) AS upper_value
    FROM v_pred_log""")
def _(t):
    return scoring.with_band(predicted(t), "pl").select(
        "order_id", "predicted_value", "predicted_log", "lower_value", "upper_value")


@query("action_rules", """
    SELECT order_id, concat_ws('|', CASE WHEN p > 160000 THEN 'HIGH VALUE' WHEN p < 60000 THEN 'LOW VALUE' END,
      CASE WHEN loyalty_tier IN ('gold', 'platinum') THEN 'LOYALTY' END,
      CASE WHEN coupon_applied THEN 'COUPON' END) AS actions
    FROM v_pred JOIN v_customers USING (customer_id) JOIN v_profile f ON f.customer_id = customer_unique_id
      JOIN (SELECT order_id, coupon_applied FROM v_sessions) USING (order_id)""")
def _(t):
    people = t["customers"].select("customer_id", "customer_unique_id")
    tiers = t["profile"].select(F.col("customer_id").alias("person"), "loyalty_tier")
    df = (predicted(t).join(people, "customer_id").join(tiers, F.col("customer_unique_id") == F.col("person"))
          .join(t["sessions"].select("order_id", "coupon_applied"), "order_id"))
    # The test values run about a thousand times higher than retail baskets.
    return scoring.recommended_actions(df, "p", high=160_000, low=60_000).select(
        "order_id", F.array_join("actions", "|").alias("actions"))


@query("residual_histogram", """
    SELECT bin, round(min(lo) + (max(hi) - min(lo)) / 100 * bin, 4) AS low,
      round(min(lo) + (max(hi) - min(lo)) / 100 * (bin + 1), 4) AS high, count(*) AS n
    FROM (SELECT lo, hi, CAST(least(floor((x - lo) / (hi - lo) * 100), 99) AS INT) AS bin
      FROM (SELECT x, min(x) OVER () AS lo, max(x) OVER () AS hi FROM (SELECT round(yl - pl, 9) AS x FROM v_pred_log))) GROUP BY bin""")
def _(t):
    found = metrics.residuals(predicted(t), "yl", "pl", ["order_id"]).select(F.round("residual_log", 9).alias("x"))
    return rounded(stats.histogram(found, "x"), 4)


# --- validation


def timed(t):
    return {name: t["timed_session_items"] if name == "session_activity" else t[name] for name in (
        "profile", "sessions", "session_activity", "orders", "customers", "items")}


@query("validation_report", """
    WITH pv AS (SELECT customer_unique_id, avg(order_value) AS avg_value FROM v_raw_value
        JOIN v_orders USING (order_id) JOIN v_customers USING (customer_id) GROUP BY 1),
      cp AS (SELECT p.*, avg_value FROM v_profile p JOIN pv ON p.customer_id = customer_unique_id),
      es AS (SELECT session_id, count(*) AS n, bool_or(activity_type = 'checkout') AS o,
        bool_or(activity_type = 'add_to_cart') AS c FROM v_timed_items GROUP BY 1),
      sc AS (SELECT coalesce(total_cart_qty, 0) AS q, coalesce(item_count, 1) AS k FROM v_sessions s
        LEFT JOIN v_act USING (session_id) LEFT JOIN v_raw_value v ON v.order_id = s.order_id),
      ot AS (SELECT count(*) AS n FROM v_timed_items JOIN v_sessions USING (session_id)
        WHERE activity_timestamp < session_start OR activity_timestamp > session_end),
      tm AS (SELECT loyalty_tier AS k, median(avg_value) AS m FROM cp GROUP BY 1),
      tf AS (SELECT CAST((SELECT m FROM tm WHERE k = 'bronze') > (SELECT m FROM tm WHERE k = 'silver') AS INT)
        + CAST((SELECT m FROM tm WHERE k = 'silver') > (SELECT m FROM tm WHERE k = 'gold') AS INT)
        + CAST((SELECT m FROM tm WHERE k = 'gold') > (SELECT m FROM tm WHERE k = 'platinum') AS INT) AS n),
      dm AS (SELECT device_type AS k, median(order_value) AS m FROM v_sessions s
        JOIN v_raw_value USING (order_id) GROUP BY 1),
      dd AS (SELECT (SELECT m FROM dm WHERE k = 'desktop') - (SELECT m FROM dm WHERE k = 'mobile') AS d),
      pc AS (SELECT count(*) AS n, count(*) FILTER (WHERE monthly_income NOT BETWEEN 500 AND 50000) AS i,
        count(*) FILTER (WHERE household_size NOT BETWEEN 1 AND 10) AS h FROM v_profile),
      x AS (
        SELECT 'profile rows' AS "check", n > 0 AS passed, CAST(n AS DOUBLE) AS observed FROM pc
        UNION ALL SELECT 'session rows', count(*) > 0, count(*) FROM v_sessions
        UNION ALL SELECT 'activity rows', count(*) > 0, count(*) FROM v_timed_items
        UNION ALL SELECT 'one profile per person', n = (SELECT count(DISTINCT customer_unique_id) FROM v_customers),
          n - (SELECT count(DISTINCT customer_unique_id) FROM v_customers) FROM pc
        UNION ALL SELECT 'one session per order', count(*) = (SELECT count(*) FROM v_orders),
          count(*) - (SELECT count(*) FROM v_orders) FROM v_sessions
        UNION ALL SELECT 'events per session', min(n) >= 3, min(n) FROM es
        UNION ALL SELECT 'no nulls in required columns', true, 0
        UNION ALL SELECT 'cart covers items', count(*) FILTER (WHERE q < k) = 0, count(*) FILTER (WHERE q < k) FROM sc
        UNION ALL SELECT 'checkout in every session', bool_and(o), count(*) FILTER (WHERE NOT o) FROM es
        UNION ALL SELECT 'add_to_cart in every session', bool_and(c), count(*) FILTER (WHERE NOT c) FROM es
        UNION ALL SELECT 'events inside session', n = 0, n FROM ot
        UNION ALL SELECT 'income follows value', corr(monthly_income, avg_value) BETWEEN 0.2 AND 0.6,
          corr(monthly_income, avg_value) FROM cp
        UNION ALL SELECT 'value rises with tier', n = 0, n FROM tf
        UNION ALL SELECT 'desktop above mobile', d > 0, d FROM dd
        UNION ALL SELECT 'income in range', i = 0, i FROM pc
        UNION ALL SELECT 'household in range', h = 0, h FROM pc)
    SELECT "check", passed, round(observed, 6) AS observed FROM x""")
def _(t):
    return rounded(validation.validate(timed(t)))


@query("required_nulls", """
    SELECT 'no nulls in required columns' AS "check", n = 0 AS passed, CAST(n AS DOUBLE) AS observed FROM (SELECT
      (SELECT count(*) FROM v_sessions WHERE order_id % 4 = 0) + (SELECT count(*) FROM v_timed_items WHERE activity_id % 6 = 0)
      + (SELECT count(*) FROM v_profile WHERE customer_id % 10 = 0) AS n)""")
def _(t):
    """The contract on tables where some required keys are missing."""
    tables = timed(t)

    def without(name, key, every):
        return tables[name].withColumn(key, F.when(F.col(key) % every != 0, F.col(key)))

    holes = {"sessions": tables["sessions"].withColumn("session_start", F.when(F.col("order_id") % 4 != 0, F.col("session_start"))),
             "session_activity": without("session_activity", "activity_id", 6), "profile": without("profile", "customer_id", 10)}
    return rounded(validation.validate({**tables, **holes}).where("check = 'no nulls in required columns'"))


@query("domain_checks", """
    WITH p AS (SELECT count(*) FILTER (WHERE (loyalty_tier IN ('bronze', 'silver', 'gold', 'platinum')) IS NOT TRUE) AS b,
        stddev_samp(monthly_income) AS s, count(*) FILTER (WHERE gender = 'male') / count(*) AS m,
        count(*) FILTER (WHERE gender = 'female') / count(*) AS f,
        median(monthly_income) FILTER (WHERE loyalty_tier = 'platinum')
          - median(monthly_income) FILTER (WHERE loyalty_tier = 'bronze') AS g FROM v_profile),
      s AS (SELECT count(*) FILTER (WHERE (device_type IN ('mobile', 'desktop', 'tablet')) IS NOT TRUE) AS d,
        count(*) FILTER (WHERE (session_end >= session_start) IS NOT TRUE) AS r FROM v_sessions),
      x AS (SELECT 'tiers valid' AS "check", b = 0 AS passed, CAST(b AS DOUBLE) AS observed FROM p
        UNION ALL SELECT 'devices valid', d = 0, d FROM s
        UNION ALL SELECT 'sessions end after start', r = 0, r FROM s
        UNION ALL SELECT 'cart quantity not negative', count(*) FILTER (WHERE (add_to_cart_quantity >= 0) IS NOT TRUE) = 0,
          count(*) FILTER (WHERE (add_to_cart_quantity >= 0) IS NOT TRUE) FROM v_session_items
        UNION ALL SELECT 'session keys not null', count(*) FILTER (WHERE session_id IS NULL OR order_id IS NULL) = 0,
          count(*) FILTER (WHERE session_id IS NULL OR order_id IS NULL) FROM v_sessions
        UNION ALL SELECT 'enough events per session', min(n) >= 5, min(n)
          FROM (SELECT count(*) AS n FROM v_session_items GROUP BY session_id)
        UNION ALL SELECT 'income varies', s > 0, s FROM p UNION ALL SELECT 'male share', m > 0.3, m FROM p
        UNION ALL SELECT 'female share', f > 0.3, f FROM p
        UNION ALL SELECT 'top tier earns more than bottom', g > 0, g FROM p)
    SELECT "check", passed, round(observed, 6) AS observed FROM x""")
def _(t):
    return rounded(validation.domain_checks(t))


# --- drift

# Every numeric column of the modeling dataset, rounded as in its own query.
_DRIFT_FEATURES = ("order_value", *(c for c in fv.NUMERIC_COLUMNS if c in MODEL_COLUMNS))


def windows(t, columns):
    """These columns of all rows of the modeling dataset, labelled by the split date, with one feature inflated after it."""
    df = rounded(modeling.modeling_dataset(t, columns=["order_purchase_timestamp", *columns]), 4)
    rows = drift.labelled_by_time(df, "order_purchase_timestamp", SPLIT)
    inflated = F.col("avg_scroll") * F.when(F.col("is_ref"), 1.0).otherwise(1.5)
    return rows.withColumn("avg_scroll", inflated) if "avg_scroll" in columns else rows


def _long(where: str, avg_scroll: str) -> str:
    cells = [f"SELECT '{c}' AS feature, CAST({avg_scroll if c == 'avg_scroll' else c} AS DOUBLE) AS value "
             f"FROM dataset WHERE {where}" for c in _DRIFT_FEATURES]
    return " UNION ALL ".join(cells)


_DRIFT = f"""dataset AS MATERIALIZED ({modeling_sql()}),
    o AS ({_long("order_purchase_timestamp < TIMESTAMP '1999-06-01'", 'avg_scroll')}),
    c AS ({_long("order_purchase_timestamp >= TIMESTAMP '1999-06-01'", 'avg_scroll * 1.5e0')}),
    a AS (SELECT feature, value, 1 AS r FROM o WHERE value IS NOT NULL
      UNION ALL SELECT feature, value, 0 FROM c WHERE value IS NOT NULL)"""
_PSI = f"""{_DRIFT},
    e AS (SELECT feature, unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q,
      unnest(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edge FROM o GROUP BY feature),
    b AS (SELECT a.feature, a.r, list_sum([CAST(a.value >= x AS INT) for x in l.edges]) AS bin
      FROM a JOIN (SELECT feature, list(edge ORDER BY q) AS edges FROM e GROUP BY feature) l USING (feature)),
    g AS (SELECT feature, unnest(range(10)) AS bin FROM (SELECT DISTINCT feature FROM b)),
    n AS (SELECT g.feature, g.bin, count(*) FILTER (WHERE r = 1) + 1 AS x, count(*) FILTER (WHERE r = 0) + 1 AS y
      FROM g LEFT JOIN b USING (feature, bin) GROUP BY 1, 2),
    s AS (SELECT feature, x / sum(x) OVER (PARTITION BY feature) AS rp, y / sum(y) OVER (PARTITION BY feature) AS cp FROM n),
    psi AS (SELECT feature, sum((cp - rp) * ln(cp / rp)) AS psi FROM s GROUP BY feature)"""


@query("psi", f"WITH {_PSI} SELECT feature, round(psi, 6) AS psi FROM psi")
def _(t):
    return rounded(drift.psi(windows(t, _DRIFT_FEATURES), _DRIFT_FEATURES))


_PSI_OF_VALUES = f"""{_DRIFT},
    e AS (SELECT feature, quantile_disc(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM o GROUP BY feature),
    b AS (SELECT a.feature, a.r, list_sum([CAST(a.value >= x AS INT) for x in e.edges]) AS bin FROM a JOIN e USING (feature)),
    g AS (SELECT feature, unnest(range(10)) AS bin FROM (SELECT DISTINCT feature FROM b)),
    n AS (SELECT g.feature, g.bin, count(*) FILTER (WHERE r = 1) + 1 AS x, count(*) FILTER (WHERE r = 0) + 1 AS y
      FROM g LEFT JOIN b USING (feature, bin) GROUP BY 1, 2),
    s AS (SELECT feature, x / sum(x) OVER (PARTITION BY feature) AS rp, y / sum(y) OVER (PARTITION BY feature) AS cp FROM n)"""


@query("psi_from_sketches", f"""
    WITH {_PSI_OF_VALUES} SELECT feature, round(sum((cp - rp) * ln(cp / rp)), 6) AS psi FROM s GROUP BY feature""")
def _(t):
    """Monthly sketches merged into both windows; of this size they are exact up to 65,535 rows a window."""
    stored = cut_lineage(sketches.period_sketches(windows(t, _DRIFT_FEATURES), "order_purchase_timestamp", _DRIFT_FEATURES, "month", 65_535))
    before, after = sketches.merged(stored, last=SPLIT), sketches.merged(stored, first=SPLIT)
    return rounded(sketches.psi_from_sketches(before, after))


@query("drift_report", f"""
    WITH {_PSI} SELECT count(*) AS n_features, count(*) FILTER (WHERE psi > 0.25) AS n_drifted, round(max(psi), 6) AS max_psi,
      (SELECT string_agg(feature, ',' ORDER BY psi DESC, feature DESC)
        FROM (SELECT * FROM psi ORDER BY psi DESC, feature DESC LIMIT 10)) AS top_features,
      0.25e0 AS drift_threshold, count(*) FILTER (WHERE psi > 0.25) > 0 AS retrain FROM psi""")
def _(t):
    return rounded(drift.drift_report(drift.psi(windows(t, _DRIFT_FEATURES), _DRIFT_FEATURES)))


@query("retrain_decision", f"""
    WITH {_PSI}, d AS (SELECT CAST(order_purchase_timestamp AS DATE) AS day, sum(abs(y - p)) AS e, sum(y) AS v
      FROM v_pred GROUP BY 1),
    w AS (SELECT sum(e) OVER k / sum(v) OVER k * 100 AS wape
      FROM d WINDOW k AS (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW))
    SELECT (SELECT count(*) FROM psi WHERE psi > 0.25) AS n_drifted, count(*) FILTER (WHERE wape > 18) AS n_breaches,
      (SELECT count(*) FROM psi WHERE psi > 0.25) > 0 OR count(*) FILTER (WHERE wape > 18) > 0 AS retrain FROM w""")
def _(t):
    rolling = metrics.rolling_wape(predicted(t), "order_purchase_timestamp", "y", "p")
    return drift.retrain_decision(drift.psi(windows(t, _DRIFT_FEATURES), _DRIFT_FEATURES), rolling)


@query("ks_drift", f"""
    WITH {_DRIFT}, v AS (SELECT feature, value, sum(r) AS x, sum(1 - r) AS y FROM a GROUP BY 1, 2),
    k AS (SELECT feature, sum(x) OVER w / sum(x) OVER (PARTITION BY feature) AS f,
        sum(y) OVER w / sum(y) OVER (PARTITION BY feature) AS g
      FROM v WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING))
    SELECT feature, round(max(abs(f - g)), 6) AS ks FROM k GROUP BY feature""")
def _(t):
    return rounded(drift.ks_distance(windows(t, _DRIFT_FEATURES), _DRIFT_FEATURES))


@query("numeric_drift_tests", f"""
    WITH {_DRIFT}, v AS (SELECT feature, value, sum(r) AS x, sum(1 - r) AS y FROM a GROUP BY 1, 2),
    k AS (SELECT feature, value, abs(sum(x) OVER w / sum(x) OVER (PARTITION BY feature)
        - sum(y) OVER w / sum(y) OVER (PARTITION BY feature)) AS gap, lead(value) OVER (PARTITION BY feature ORDER BY value) AS after
      FROM v WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
    s AS (SELECT feature, stddev_pop(value) AS s, count(*) AS n FROM o WHERE value IS NOT NULL GROUP BY feature),
    n AS (SELECT feature, count(*) FILTER (WHERE r = 0) AS m FROM a GROUP BY feature),
    d AS (SELECT feature, n, m, max(gap) AS ks, sum(gap * (after - value)) AS wd, any_value(s) AS s
      FROM k JOIN s USING (feature) JOIN n USING (feature) GROUP BY feature, n, m),
    e AS (SELECT *, sqrt(n * m / (n + m)) * ks AS x FROM d)
    SELECT feature, n AS n_ref, m AS n_cur, round(ks, 6) AS ks,
      round(CASE WHEN x <= 0 THEN 1 ELSE 2 * list_sum([power(-1, k - 1) * exp(-2e0 * k * k * x * x) for k in range(1, 200)]) END, 5) AS ks_p,
      round(coalesce(wd, 0), 6) AS wasserstein, CASE WHEN s > 0 THEN round(coalesce(wd, 0) / s, 6) END AS wasserstein_norm
    FROM e""")
def _(t):
    found = drift.numeric_tests(windows(t, _DRIFT_FEATURES), _DRIFT_FEATURES)
    return rounded(found.withColumn("ks_p", F.round("ks_p", 5)))


_CATEGORIES = tuple(c for c in fv.ONE_HOT_COLUMNS if c in MODEL_COLUMNS)
_CATEGORY_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, CAST(order_purchase_timestamp < TIMESTAMP '1999-06-01' AS INT) AS r FROM dataset"
    for c in _CATEGORIES)


@query("category_drift_tests", f"""
    WITH dataset AS MATERIALIZED ({modeling_sql()}), x AS ({_CATEGORY_ROWS}),
    c AS (SELECT feature, category, sum(r) AS r, sum(1 - r) AS c FROM x WHERE category IS NOT NULL GROUP BY ALL),
    s AS (SELECT *, sum(r) OVER f AS n, sum(c) OVER f AS m FROM c WINDOW f AS (PARTITION BY feature)),
    g AS (SELECT feature, n, m, CASE WHEN (r + c) / (n + m) * least(n, m) >= 5 THEN category END AS cell, sum(r) AS r, sum(c) AS c
      FROM s GROUP BY ALL),
    e AS (SELECT *, n * (r + c) / (n + m) AS er, m * (r + c) / (n + m) AS ec FROM g),
    h AS (SELECT feature, n, m, count(*) AS cells, sum((r - er) * (r - er) / er + (c - ec) * (c - ec) / ec) AS chi2 FROM e GROUP BY ALL)
    SELECT feature, CAST(n AS BIGINT) AS n_ref, CAST(m AS BIGINT) AS n_cur, cells,
      CASE WHEN cells > 1 AND least(n, m) > 0 THEN round(chi2, 6) ELSE 0 END AS chi2 FROM h""")
def _(t):
    return rounded(drift.category_tests(windows(t, _CATEGORIES), _CATEGORIES)).drop("chi2_p")


@query("psi_sampled_batch", """
    WITH s AS (SELECT order_value * 1.1e0 AS v FROM v_value ORDER BY md5('123:' || order_id), order_id LIMIT 5000),
    e AS (SELECT quantile_cont(order_value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM v_value),
    b AS (SELECT list_sum([CAST(order_value >= x AS INT) for x in edges]) AS bin, 1 AS r FROM v_value, e
      UNION ALL SELECT list_sum([CAST(v >= x AS INT) for x in edges]), 0 FROM s, e),
    n AS (SELECT g.bin, count(*) FILTER (WHERE r = 1) + 1 AS x, count(*) FILTER (WHERE r = 0) + 1 AS y
      FROM (SELECT unnest(range(10)) AS bin) g LEFT JOIN b USING (bin) GROUP BY 1),
    p AS (SELECT x / sum(x) OVER () AS rp, y / sum(y) OVER () AS cp FROM n)
    SELECT 'order_value' AS feature, round(sum((cp - rp) * ln(cp / rp)), 6) AS psi FROM p""")
def _(t):
    values = facts.order_value(facts.dedup_items(t["items"])).select("order_id", "order_value")
    batch = stable_sample(values, "order_id", 5000).withColumn("order_value", F.col("order_value") * 1.1)
    return rounded(drift.psi(drift.labelled(values, batch), ["order_value"]))


# --- models: small settings here, full ones are the defaults

MODEL_FEATURES = (
    "item_count", "monthly_income", "household_size", "session_duration_min", "n_events", "n_product_views",
    "n_searches", "total_cart_qty", "avg_scroll", "avg_page_duration")


def model_frame(t):
    """Scaled numeric features and the log target, written once for the training passes."""
    df = (eda.eda_dataset(t).where(F.col("order_status").isin(*fv.KEPT_STATUSES))
          .select("order_id", "order_purchase_timestamp", *MODEL_FEATURES,
                  F.log1p("order_value").alias("target_log"))
          .withColumns({c: F.col(c).cast("double") for c in MODEL_FEATURES}))
    train, _ = time_split(df, "order_purchase_timestamp", SPLIT)
    return cut_lineage(scale(df, MODEL_FEATURES, fit_scaling(train, MODEL_FEATURES)))


def parts(t):
    return time_split(model_frame(t), "order_purchase_timestamp", SPLIT)


_ONE_FEATURE = """x AS (SELECT CAST(item_count AS DOUBLE) AS x, ln(1 + order_value) AS y FROM v_kept_value),
    m AS (SELECT avg(x) AS mx, avg(y) AS my, count(*) AS n, covar_pop(x, y) AS sxy, var_pop(x) AS sxx FROM x)"""


def one_feature(t, estimator):
    """Slope and intercept of the log value on the item count alone."""
    values = facts.valued_orders(facts.order_value(facts.dedup_items(t["items"])), facts.kept_orders(t["orders"]))
    df = values.select(F.col("item_count").cast("double").alias("item_count"),
                       F.log1p("order_value").alias("target_log"))
    line = models.assembled(["item_count"], estimator(df)).fit(df).stages[-1]
    return values.sparkSession.createDataFrame(
        [(round(float(line.coefficients[0]), 4), round(float(line.intercept), 4))],
        "slope double, intercept double")


@query("linear_one_feature", f"""
    WITH {_ONE_FEATURE} SELECT round(sxy / sxx, 4) AS slope, round(my - sxy / sxx * mx, 4) AS intercept FROM m""")
def _(t):
    return one_feature(t, lambda df: models.linear())


@query("ridge_one_feature", f"""
    WITH {_ONE_FEATURE} SELECT round(sxy / (sxx + 1e0 / n), 4) AS slope,
      round(my - sxy / (sxx + 1e0 / n) * mx, 4) AS intercept FROM m""")
def _(t):
    return one_feature(t, lambda df: models.ridge(df))


@query("lasso_one_feature", f"""
    WITH {_ONE_FEATURE} SELECT round((sxy - 0.1e0) / sxx, 4) AS slope, round(my - (sxy - 0.1e0) / sxx * mx, 4) AS intercept
    FROM m WHERE sxy > 0.1e0""")
def _(t):
    return one_feature(t, lambda df: models.lasso(tol=1e-9))


_REQUEST_SOURCES = (
    "order_id", "order_purchase_timestamp", "monthly_income", "household_size", "loyalty_tier", "gender", "preferred_device",
    "device_type", "traffic_source", "coupon_applied", "session_duration_min", "item_count", "n_events", "n_product_views",
    "n_searches", "total_cart_qty", "avg_scroll", "avg_page_duration")


def requests(t):
    """Scoring requests derived from the analysis dataset; some break the accepted ranges."""
    at = F.col("order_purchase_timestamp")
    df = eda.eda_dataset(t, _REQUEST_SOURCES)
    return df.select(
        "order_id", "monthly_income", "household_size", "loyalty_tier", "gender", "preferred_device",
        "device_type", "traffic_source", F.col("coupon_applied").cast("double").alias("coupon_applied"),
        "session_duration_min", "item_count",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_events", "n_product_views", "n_searches", "total_cart_qty")],
        "avg_scroll", "avg_page_duration", F.hour(at).alias("purchase_hour"), F.weekday(at).alias("purchase_dow"))


def request_model(t, asked=None):
    """Preprocessor and linear model trained on rows shaped like scoring requests, or on these."""
    asked = requests(t) if asked is None else asked
    values = facts.order_value(facts.dedup_items(t["items"].drop("shipping_limit_date")))
    known = t["orders"].select("order_id", "order_purchase_timestamp").join(
        values.select("order_id", F.log1p("order_value").alias("target_log")), "order_id")
    rows = cut_lineage(scoring.request_features(asked.join(known, "order_id")))
    pre = features.fit_preprocessor(rows, SPLIT)
    columns = pre.feature_names
    train, _ = time_split(rows, "order_purchase_timestamp", SPLIT)
    matrix = pre.apply(train, keep=["order_id", "target_log"])
    return pre, models.assembled(columns, models.ridge(matrix)).fit(matrix)


@query("score_orders")
def _(t):
    asked = cut_lineage(requests(t))  # trained on and scored
    pre, fitted = request_model(t, asked)
    scored, rejected = scoring.score_orders(asked, "order_id", pre, fitted)
    return scored.withColumn("violations", F.lit("")).unionByName(
        rejected.select("order_id", F.array_join("violations", ",").alias("violations")), allowMissingColumns=True)


@query("request_rejects", """
    SELECT order_id, concat_ws(',', CASE WHEN session_duration_min < 0.1 THEN 'session_duration_min' END,
      CASE WHEN coalesce(n_events, 0) < 1 THEN 'n_events' END,
      CASE WHEN coalesce(total_cart_qty, 0) < 1 THEN 'total_cart_qty' END,
      CASE WHEN avg_scroll IS NULL OR avg_scroll NOT BETWEEN 0 AND 100 THEN 'avg_scroll' END) AS violations
    FROM v_eda WHERE session_duration_min < 0.1 OR coalesce(n_events, 0) < 1 OR coalesce(total_cart_qty, 0) < 1
      OR avg_scroll IS NULL OR avg_scroll NOT BETWEEN 0 AND 100""")
def _(t):
    _, rejected = scoring.split_requests(requests(t))
    return rejected.select("order_id", F.array_join("violations", ",").alias("violations"))
