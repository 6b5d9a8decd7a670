"""Exploratory tables, scalar features and encoders."""

from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.functions.labels import hash_uniform, shifted_segment
from basketry.functions.numeric import sigmoid
from basketry.functions.temporal import age_years, calendar, minutes_between, shift_seconds
from basketry.operators import encode, stats
from basketry.operators.quantile import attach_row, quantiles
from basketry.operators.sampling import split_label, time_split
from basketry.plans import eda, facts, features, legacy, modeling
from basketry.session import cut_lineage
from checks.registry import SPLIT, query, rounded
from checks.relational import KM, cleaned, modeling_sql


def analysis(t):
    return eda.delivered(eda.eda_dataset(t))


# --- target and drivers


@query("target_profile", """
    SELECT count(order_value) AS n, round(avg(order_value), 4) AS mean, round(median(order_value), 4) AS median,
      round(stddev_samp(order_value), 4) AS std, round(quantile_cont(order_value, 0.95), 4) AS p95,
      round(quantile_cont(order_value, 0.99), 4) AS p99, max(order_value) AS max,
      round(skewness(order_value), 4) AS skewness FROM v_delivered""")
def _(t):
    return rounded(stats.profile(analysis(t), "order_value"), 4)


@query("top_categories", """
    SELECT product_category_name_english, round(avg(order_value), 4) AS mean_value, count(*) AS n,
      round(median(order_value), 4) AS median_value FROM v_delivered
    WHERE product_category_name_english IS NOT NULL GROUP BY 1 HAVING count(*) >= 50
    ORDER BY median(order_value) DESC, 1 LIMIT 15""")
def _(t):
    return rounded(eda.top_categories(analysis(t), "product_category_name_english", "order_value"), 4)


@query("median_by_segment", "\n UNION ALL ".join(
    f"SELECT '{s}' AS segment, {s} AS level, round(median(order_value), 4) AS median_value FROM v_delivered GROUP BY 2"
    for s in ("device_type", "traffic_source", "loyalty_tier")))
def _(t):
    return rounded(eda.median_by_segment(
        analysis(t), ["device_type", "traffic_source", "loyalty_tier"], "order_value"), 4)


@query("iqr_outliers", """
    WITH q AS (SELECT quantile_cont(order_value, 0.75) + 3 * (quantile_cont(order_value, 0.75)
        - quantile_cont(order_value, 0.25)) AS fence FROM v_delivered)
    SELECT round(max(fence), 4) AS fence, count(*) FILTER (WHERE order_value > fence) AS n_outliers,
      round(count(*) FILTER (WHERE order_value > fence) * 100e0 / count(*), 4) AS pct_outliers FROM v_delivered, q""")
def _(t):
    return rounded(stats.outliers(analysis(t), "order_value"), 4)


_BOX_SEGMENTS = ("order_status", "device_type", "preferred_device", "loyalty_tier")


def _box_sql(source: str, group: str, value: str, tag: str) -> str:
    return f"""
    SELECT '{tag}' AS segment, CAST(g AS VARCHAR) AS level, round(any_value(q1), 4) AS q1,
      round(any_value(med), 4) AS median, round(any_value(q3), 4) AS q3, count(*) AS n,
      round(min(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_low,
      round(max(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
      count(*) FILTER (WHERE x NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outside
    FROM (SELECT {group} AS g, {value} AS x FROM {source}) JOIN (
      SELECT {group} AS g, quantile_cont({value}, 0.25) AS q1, median({value}) AS med,
        quantile_cont({value}, 0.75) AS q3 FROM {source} GROUP BY 1) USING (g) GROUP BY g"""


@query("box_stats", "\n UNION ALL ".join(
    _box_sql("v_eda" if s == "order_status" else "v_delivered", s, "order_value", s) for s in _BOX_SEGMENTS))
def _(t):
    return rounded(eda.segment_boxes(eda.eda_dataset(t), _BOX_SEGMENTS, "order_value"), 4)


def _histogram_sql(x: str, tag: str, source: str = "v_delivered") -> str:
    return f"""
    SELECT '{tag}' AS scale, bin, round(min(lo) + (max(hi) - min(lo)) / 100 * bin, 4) AS low,
      round(min(lo) + (max(hi) - min(lo)) / 100 * (bin + 1), 4) AS high, count(*) AS n
    FROM (SELECT lo, hi, CAST(least(floor((x - lo) / (hi - lo) * 100), 99) AS INT) AS bin
      FROM (SELECT {x} AS x, min({x}) OVER () AS lo, max({x}) OVER () AS hi FROM {source})) GROUP BY bin"""


@query("histogram_100", _histogram_sql("order_value", "raw"))
def _(t):
    raw = stats.histogram(analysis(t), "order_value")
    return rounded(raw.select(F.lit("raw").alias("scale"), *raw.columns), 4)


# Logs are rounded before they are binned, so that two engines agree on which side of an edge they lie.
@query("histogram_log", _histogram_sql("round(ln(1 + order_value), 9)", "log"))
def _(t):
    rows = analysis(t).select(F.round(F.log1p("order_value"), 9).alias("x"))
    found = stats.histogram(rows, "x")
    return rounded(found.select(F.lit("log").alias("scale"), *found.columns), 4)


_DENSITIES = (("item_count", "order_value"), ("monthly_income", "order_value"), ("session_duration_min", "order_value"),
              ("total_cart_qty", "order_value"), ("n_product_views", "order_value"), ("avg_scroll", "order_value"))


def _density_sql(x: str, y: str) -> str:
    return f"""
    SELECT '{x}' AS feature, CAST(least(floor((x - x0) / (x1 - x0) * 50), 49) AS INT) AS x_bin,
      CAST(least(floor((y - y0) / (y1 - y0) * 50), 49) AS INT) AS y_bin, count(*) AS n
    FROM (SELECT {x} AS x, {y} AS y, min({x}) OVER () AS x0, max({x}) OVER () AS x1, min({y}) OVER () AS y0, max({y}) OVER () AS y1
      FROM v_delivered WHERE {x} IS NOT NULL AND {y} IS NOT NULL) GROUP BY ALL"""


@query("densities", " UNION ALL ".join(_density_sql(x, y) for x, y in _DENSITIES))
def _(t):
    rows, found = cut_lineage(analysis(t).select(*dict.fromkeys(c for pair in _DENSITIES for c in pair))), None
    for x, y in _DENSITIES:
        cells = stats.density_2d(rows, x, y)
        cells = cells.select(F.lit(x).alias("feature"), *cells.columns)
        found = cells if found is None else found.unionByName(cells)
    return found


@query("density_2d", """
    WITH x AS (SELECT monthly_income AS x, order_value AS y, min(monthly_income) OVER () AS x0,
        max(monthly_income) OVER () AS x1, min(order_value) OVER () AS y0, max(order_value) OVER () AS y1
      FROM v_delivered)
    SELECT CAST(least(floor((x - x0) / (x1 - x0) * 50), 49) AS INT) AS x_bin,
      CAST(least(floor((y - y0) / (y1 - y0) * 50), 49) AS INT) AS y_bin, count(*) AS n FROM x GROUP BY 1, 2""")
def _(t):
    return stats.density_2d(analysis(t), "monthly_income", "order_value")


_PAIRS = [(i, j) for i in range(len(fv.CORRELATION_COLUMNS)) for j in range(i + 1, len(fv.CORRELATION_COLUMNS))]
_CORR_ROW = "c AS (SELECT " + ", ".join(
    f"corr({fv.CORRELATION_COLUMNS[i]}, {fv.CORRELATION_COLUMNS[j]}) AS r_{i}_{j}" for i, j in _PAIRS
) + " FROM v_delivered)"
_CORR_CELLS = "x AS (" + "\n UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {i} AS position_a, {j} AS position_b, "
    + ("1e0" if i == j else f"r_{min(i, j)}_{max(i, j)}") + " AS r FROM c"
    for i, a in enumerate(fv.CORRELATION_COLUMNS) for j, b in enumerate(fv.CORRELATION_COLUMNS)) + ")"
_CORR = f"WITH {_CORR_ROW}, {_CORR_CELLS}"


@query("correlation_matrix", f"{_CORR} SELECT column_a, column_b, position_a, position_b, round(r, 6) AS r FROM x")
def _(t):
    return rounded(stats.correlation_matrix(analysis(t), fv.CORRELATION_COLUMNS))


@query("target_correlations", f"""{_CORR} SELECT column_b AS feature, round(r, 6) AS r FROM x
    WHERE column_a = 'order_value' AND column_b <> 'order_value'""")
def _(t):
    return rounded(eda.target_correlations(analysis(t), fv.CORRELATION_COLUMNS, "order_value"))


@query("collinear_pairs", f"""{_CORR} SELECT column_a, column_b, round(r, 6) AS r FROM x
    WHERE position_a < position_b AND abs(r) > 0.7 AND column_a <> 'order_value' AND column_b <> 'order_value'""")
def _(t):
    return rounded(eda.collinear_pairs(analysis(t), fv.CORRELATION_COLUMNS, "order_value"))


@query("category_shares", """
    SELECT gender AS category, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
    FROM v_profile GROUP BY gender""")
def _(t):
    return rounded(stats.shares(t["profile"], "gender"))


@query("income_quartile", """
    WITH q AS (SELECT quantile_cont(monthly_income, 0.25) AS a, median(monthly_income) AS b,
      quantile_cont(monthly_income, 0.75) AS c FROM v_delivered)
    SELECT order_id, CASE WHEN monthly_income <= a THEN 'Q1' WHEN monthly_income <= b THEN 'Q2'
      WHEN monthly_income <= c THEN 'Q3' ELSE 'Q4' END AS income_quartile FROM v_delivered, q""")
def _(t):
    return eda.quartile_labels(analysis(t), "monthly_income", "income_quartile").select(
        "order_id", "income_quartile")


# --- scalar features


@query("seller_distance", f"""
    SELECT o.order_id, round({KM.format(a='g.geo_', b='s.geo_')}, 4) AS distance_km
    FROM v_kept o JOIN v_primary_seller ps USING (order_id) JOIN v_customers c USING (customer_id)
      LEFT JOIN v_centroid g ON g.zip = c.customer_zip_code_prefix
      LEFT JOIN v_sellers l USING (seller_id) LEFT JOIN v_centroid s ON s.zip = l.seller_zip_code_prefix""")
def _(t):
    from basketry.functions.numeric import haversine_km
    centroids = facts.geo_centroid(t["geolocation"])
    df = (facts.kept_orders(t["orders"]).select("order_id", "customer_id")
          .join(facts.primary_seller(facts.dedup_items(t["items"])), "order_id")
          .join(facts.customer_places(t["customers"], centroids), "customer_id")
          .join(facts.seller_places(t["sellers"], centroids), "seller_id", "left"))
    km = haversine_km("geo_lat", "geo_lng", "seller_lat", "seller_lng")
    return df.select("order_id", F.round(km, 4).alias("distance_km"))


@query("log_target", """
    SELECT order_id, order_value AS target, round(ln(1 + order_value), 6) AS target_log FROM v_kept_value""")
def _(t):
    values = facts.valued_orders(facts.order_value(facts.dedup_items(t["items"])), facts.kept_orders(t["orders"]))
    return rounded(features.with_target(values).select("order_id", "target", "target_log"))


@query("session_duration", """
    SELECT session_id, round(date_sub('microsecond', session_start, session_end) / 60e6, 6) AS session_duration_min
    FROM v_event_sessions""")
def _(t):
    return t["event_sessions"].select(
        "session_id", F.round(minutes_between("session_start", "session_end"), 6).alias("session_duration_min"))


@query("engagement_ratios", f"""
    SELECT order_id, round(item_count / greatest(total_cart_qty, 1), 6) AS cart_conversion,
      round(n_product_views / greatest(n_events, 1), 6) AS engagement_rate,
      round(n_searches / greatest(n_events, 1), 6) AS search_intensity,
      round(item_count / greatest(session_duration_min, 0.1e0), 6) AS items_per_minute,
      round({KM.format(a='geo_', b='seller_')} / greatest(item_count, 1), 4) AS distance_per_item FROM v_merged""")
def _(t):
    ratios = features.session_ratios()
    return modeling.merged_orders(t).select("order_id", *[
        F.round(c, 4 if name == "distance_per_item" else 6).alias(name) for name, c in ratios.items()])


_RATIO_SQL = ", ".join(
    f"round(CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0 END, 6) AS {name}" for name, a, b in (
        ("cart_efficiency", "cart_additions", "session_duration_seconds"),
        ("session_intensity", "pages_viewed", "session_duration_seconds"),
        ("add_to_cart_ratio", "cart_additions", "pages_viewed"),
        ("pages_per_cart", "pages_viewed", "cart_additions"),
        ("duration_per_cart", "session_duration_seconds", "cart_additions"),
        ("discount_per_page", "discount_amount_pct", "pages_viewed")))


@query("safe_divide_features", f"SELECT order_id, {_RATIO_SQL} FROM v_behavior")
def _(t):
    return t["behavioral_sessions"].select(
        "order_id", *[F.round(c, 6).alias(n) for n, c in legacy.ratio_features().items()])


@query("calendar_features", """
    SELECT order_id, month(t) AS purchase_month, quarter(t) AS purchase_quarter, day(t) AS purchase_day_of_month,
      hour(t) AS purchase_hour, isodow(t) - 1 AS purchase_dow, CAST(isodow(t) >= 6 AS INT) AS is_weekend
    FROM (SELECT order_id, order_purchase_timestamp AS t FROM v_orders)""")
def _(t):
    parts = calendar("order_purchase_timestamp")
    return t["orders"].select("order_id", *[c.alias(n) for n, c in parts.items()])


@query("age_years", """
    SELECT customer_id, round(least(greatest(floor(date_sub('microsecond', birth_date, TIMESTAMP '2018-01-01')
      / 86400e6) / 365.25e0, 15), 70), 6) AS age FROM v_profile""")
def _(t):
    return t["profile"].select("customer_id", F.round(age_years("birth_date"), 6).alias("age"))


_TIER = "CASE loyalty_tier WHEN 'silver' THEN 2 WHEN 'gold' THEN 3 WHEN 'platinum' THEN 4 ELSE 1 END"


@query("interaction_features", f"""
    SELECT order_id, {_TIER} AS loyalty_numeric, round(monthly_income * {_TIER}, 4) AS income_x_loyalty,
      round(ln(1 + monthly_income), 6) AS log_income, seller_order_count * {_TIER} AS seller_rep_x_loyalty,
      round(cat_avg_price * ln(1 + monthly_income), 4) AS cat_price_x_income,
      customer_urban * CAST(device_type = 'desktop' AS DOUBLE) AS urban_x_desktop FROM v_merged""")
def _(t):
    digits = {"income_x_loyalty": 4, "cat_price_x_income": 4, "log_income": 6}
    return modeling.merged_orders(t).select("order_id", *[
        (F.round(c, digits[n]) if n in digits else c).alias(n) for n, c in features.interactions().items()])


_BINS = """CASE WHEN delivery_days > 14 THEN 'very_slow' WHEN delivery_days > 7 THEN 'slow'
        WHEN delivery_days > 3 THEN 'normal' WHEN delivery_days > 0 THEN 'fast' ELSE 'nan' END AS delivery_speed,
      CASE WHEN discount_amount_pct > 100 OR discount_amount_pct <= -1 THEN 'nan' WHEN discount_amount_pct > 15 THEN 'high'
        WHEN discount_amount_pct > 5 THEN 'medium' WHEN discount_amount_pct > 0 THEN 'low' ELSE 'none' END AS discount_level"""


@query("label_bins", f"""
    SELECT order_id, {_BINS} FROM (SELECT b.order_id, b.discount_amount_pct, o.delivery_days
      FROM v_behavior b JOIN v_clean_orders o USING (order_id))""")
def _(t):
    df = t["behavioral_sessions"].join(cleaned(t).select("order_id", "delivery_days"), "order_id")
    return df.select("order_id", *[c.alias(n) for n, c in legacy.bin_features().items()])


_SCORES = """round(session_duration_seconds * 0.4e0 + pages_viewed * 0.6e0, 6) AS engagement_score,
      {saved} AS estimated_discount_value, CAST(discount_amount_pct >= 15 AS INT) AS has_high_discount,
      session_duration_seconds * cart_additions AS duration_x_cart, pages_viewed * discount_amount_pct AS pages_x_discount,
      cart_additions * discount_amount_pct AS cart_x_discount,
      round((session_duration_seconds * 0.4e0 + pages_viewed * 0.6e0) * discount_amount_pct, 6) AS engagement_x_discount,
      pages_viewed - cart_additions AS cart_abandon_score"""


@query("session_scores", f"SELECT order_id, {_SCORES.format(saved='0e0')} FROM v_behavior")
def _(t):
    df = t["behavioral_sessions"]
    return rounded(df.select("order_id", *[c.alias(n) for n, c in legacy.score_features(df.columns).items()]))


@query("engagement_flags", """
    WITH m AS (SELECT median(session_duration_seconds) AS d, median(pages_viewed) AS p FROM v_clean_sessions)
    SELECT order_id, CAST(session_duration_seconds > d AND pages_viewed > p AS INT) AS is_high_engagement
    FROM v_clean_sessions, m""")
def _(t):
    return legacy.engagement_flags(legacy.clean_sessions(t["behavioral_sessions"])).select(
        "order_id", "is_high_engagement")


def zscored(t):
    values = facts.order_value(facts.dedup_items(t["items"])).select(
        "order_id", F.log1p("order_value").alias("lv"))
    middle = quantiles(values, [], "lv", [0.5], ["m"])
    spread = values.agg(F.stddev_pop("lv").alias("s"))
    std = F.when(F.col("__s.s") > 0, F.col("__s.s")).otherwise(1.0)
    return attach_row(attach_row(values, middle, "__m"), spread, "__s").select(
        "order_id", ((F.col("lv") - F.col("__m.m")) / std).alias("z"))


_Z = """z AS (SELECT order_id, (ln(1 + order_value) - (SELECT median(ln(1 + order_value)) FROM v_value))
      / (SELECT stddev_pop(ln(1 + order_value)) FROM v_value) AS z FROM v_value)"""


@query("value_zscore", f"WITH {_Z} SELECT order_id, round(z, 6) AS z FROM z")
def _(t):
    return rounded(zscored(t))


@query("sigmoid_score", f"""
    WITH {_Z} SELECT order_id, round(1 / (1 + exp(-least(greatest(z, -20), 20))), 6) AS score FROM z""")
def _(t):
    return zscored(t).select("order_id", F.round(sigmoid("z"), 6).alias("score"))


@query("segment_assignment", f"""
    WITH {_Z}, u AS (SELECT order_id, 0.6e0 * round(z, 9) AS s,
        CAST('0x' || substr(md5(CAST(order_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0 AS u FROM z),
      w AS (SELECT *, greatest(0.001e0, 0.50e0 * (1 - s)) AS w1, greatest(0.001e0, 0.30e0 * (1 - s / 3)) AS w2,
        greatest(0.001e0, 0.15e0 * (1 + s / 3)) AS w3, greatest(0.001e0, 0.05e0 * (1 + s)) AS w4 FROM u)
    SELECT order_id, CASE WHEN u < w1 / (w1 + w2 + w3 + w4) THEN 'bronze'
      WHEN u < (w1 + w2) / (w1 + w2 + w3 + w4) THEN 'silver'
      WHEN u < (w1 + w2 + w3) / (w1 + w2 + w3 + w4) THEN 'gold' ELSE 'platinum' END AS segment FROM w""")
def _(t):
    shifted = zscored(t).withColumn("s", 0.6 * F.round("z", 9))
    return shifted.select("order_id", shifted_segment(
        "order_id", "s", fv.LOYALTY_TIERS, fv.LOYALTY_SHARES).alias("segment"))


@query("session_bounds", """
    SELECT order_id, order_purchase_timestamp - to_seconds(order_id * 13 % 10500 + 300) AS opens_at,
      order_purchase_timestamp + to_seconds(order_id * 17 % 180 * 86400) AS updated_at FROM v_orders""")
def _(t):
    key = F.col("order_id")
    return t["orders"].select(
        "order_id", shift_seconds("order_purchase_timestamp", -(key * 13 % 10500 + 300)).alias("opens_at"),
        shift_seconds("order_purchase_timestamp", key * 17 % 180 * 86400).alias("updated_at"))


@query("conditional_assign", """
    SELECT session_id, CASE WHEN traffic_medium NOT IN ('organic', 'direct') THEN traffic_source END AS paid_source,
      CASE WHEN coupon_applied THEN discount_amount_pct END AS coupon_pct FROM v_sessions""")
def _(t):
    paid = ~F.col("traffic_medium").isin("organic", "direct")
    return t["sessions"].select("session_id", F.when(paid, F.col("traffic_source")).alias("paid_source"),
                                F.when(F.col("coupon_applied"), F.col("discount_amount_pct")).alias("coupon_pct"))


# --- encoders

_LEVELS = {
    "device_type": ("desktop", "mobile", "tablet"), "preferred_device": ("desktop", "mobile", "tablet"),
    "browser": ("chrome", "edge", "firefox", "other", "safari"),
    "operating_system": ("android", "ios", "linux", "macos", "windows"),
    "traffic_source": ("direct", "email", "facebook", "google", "instagram"),
    "traffic_medium": ("cpc", "direct", "email", "organic", "social"),
    "landing_page": ("/", "/category", "/product", "/search"), "ip_country": ("BR", "US"),
    "gender": ("female", "male", "other"), "marital_status": ("divorced", "married", "single", "widowed"),
    "education_level": ("bachelor", "high_school", "master", "none", "phd"),
    "loyalty_tier": ("bronze", "gold", "platinum", "silver"),
    "registration_channel": ("email", "organic", "paid_ads", "referral", "social"),
    "payment_type": ("boleto", "credit_card", "voucher"),
    "primary_category": ("economy", "large", "medium", "promo", "small"),
}


def _one_hot_sql(columns, alias: str = "") -> str:
    return ", ".join(f"CAST(coalesce({alias}{c} = '{level}', false) AS DOUBLE) AS \"{c}_{level}\""
                     for c in columns for level in _LEVELS[c])


@query("one_hot", "SELECT session_id, " + _one_hot_sql(("device_type", "browser", "traffic_medium"))
       + ", CAST(coalesce(campaign_name = 'black_friday', false) AS DOUBLE) AS campaign_name_black_friday, "
       + ", ".join(f"CAST(coalesce(campaign_name = '{c}', false) AS DOUBLE) AS campaign_name_{c}"
                   for c in ("christmas", "flash_deal", "free_shipping", "summer_sale")) + " FROM v_sessions")
def _(t):
    columns = ["device_type", "browser", "traffic_medium", "campaign_name"]
    levels = encode.category_levels(t["sessions"], columns)
    return t["sessions"].select("session_id", *[c.alias(n) for n, c in encode.one_hot(levels).items()])


def targets(t):
    """Orders with log target, time and two high-cardinality columns."""
    values = facts.valued_orders(facts.order_value(facts.dedup_items(t["items"])), facts.kept_orders(t["orders"]))
    return (values.join(t["orders"].select("order_id", "order_purchase_timestamp"), "order_id")
            .join(t["sessions"].select("order_id", "ip_region", "campaign_name"), "order_id")
            .withColumn("target_log", F.log1p("order_value")))


_TARGETS = """x AS (SELECT v.order_id, order_value, item_count, ln(1 + order_value) AS y, ip_region, campaign_name,
      order_purchase_timestamp < TIMESTAMP '1999-06-01' AS is_train
    FROM v_kept_value v JOIN v_orders USING (order_id) JOIN v_sessions s ON s.order_id = v.order_id)"""


def _te_cte(c: str, source: str = "x", y: str = "y") -> str:
    return (f"te_{c} AS (SELECT {c} AS k, (sum({y}) + 20 * (SELECT avg({y}) FROM {source} WHERE is_train)) / (count(*) + 20) AS te "
            f"FROM {source} WHERE is_train AND {c} IS NOT NULL GROUP BY 1)")


@query("target_encode", f"""
    WITH {_TARGETS}, {_te_cte('ip_region')}, {_te_cte('campaign_name')}
    SELECT order_id, round(coalesce(a.te, (SELECT avg(y) FROM x WHERE is_train)), 6) AS ip_region_te,
      round(coalesce(b.te, (SELECT avg(y) FROM x WHERE is_train)), 6) AS campaign_name_te
    FROM x LEFT JOIN te_ip_region a ON a.k = ip_region LEFT JOIN te_campaign_name b ON b.k = campaign_name""")
def _(t):
    df, columns = targets(t), ["ip_region", "campaign_name"]
    train, _ = time_split(df, "order_purchase_timestamp", SPLIT)
    table = encode.fit_target_encoding(train, columns, "target_log")
    return rounded(encode.apply_target_encoding(df, columns, table).select(
        "order_id", "ip_region_te", "campaign_name_te"))


@query("standard_scale", f"""
    WITH {_TARGETS}, s AS (SELECT avg(order_value) AS m1, stddev_pop(order_value) AS s1, avg(item_count) AS m2,
      stddev_pop(item_count) AS s2 FROM x WHERE is_train)
    SELECT order_id, round((order_value - m1) / s1, 6) AS order_value, round((item_count - m2) / s2, 6) AS item_count
    FROM x, s""")
def _(t):
    df = targets(t)
    train, _ = time_split(df, "order_purchase_timestamp", SPLIT)
    columns = ["order_value", "item_count"]
    return rounded(encode.scale(df, columns, encode.fit_scaling(train, columns)).select("order_id", *columns))


@query("time_split", """
    SELECT CASE WHEN order_purchase_timestamp < TIMESTAMP '1999-06-01' THEN 'train' ELSE 'test' END AS part,
      count(*) AS n, min(order_purchase_timestamp) AS first_at, max(order_purchase_timestamp) AS last_at
    FROM v_kept GROUP BY 1""")
def _(t):
    train, test = time_split(facts.kept_orders(t["orders"]), "order_purchase_timestamp", SPLIT)
    at = F.col("order_purchase_timestamp")

    def summary(part, df):
        return df.agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at")).select(
            F.lit(part).alias("part"), "n", "first_at", "last_at")
    return summary("train", train).unionByName(summary("test", test))


@query("hash_split", """
    SELECT order_id, CASE WHEN CAST('0x' || substr(md5('42:' || order_id), 1, 8) AS BIGINT) / 4294967296e0 < 0.2
      THEN 'test' ELSE 'train' END AS part FROM v_orders""")
def _(t):
    return t["orders"].select("order_id", split_label("order_id").alias("part"))


@query("hash_uniform", """
    SELECT order_id, round(CAST('0x' || substr(md5(CAST(order_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0, 9) AS u
    FROM v_orders""")
def _(t):
    return t["orders"].select("order_id", F.round(hash_uniform("order_id"), 9).alias("u"))


@query("legacy_features", f"""
    WITH m AS (SELECT quantile_cont(session_duration_seconds, 0.75) AS d, quantile_cont(pages_viewed, 0.75) AS p FROM v_final)
    SELECT order_id, {_RATIO_SQL}, {_SCORES.format(saved='round(order_value * discount_amount_pct / 100, 6)')}, {_BINS},
      CAST(session_duration_seconds > d AND pages_viewed > p AS INT) AS is_high_value_session FROM v_final, m""")
def _(t):
    df = cut_lineage(legacy.final_dataset(legacy.clean_sessions(t["behavioral_sessions"]), cleaned(t)))
    out = legacy.transform(df, legacy.fit_thresholds(df))
    names = [*legacy.ratio_features(), *legacy.score_features(df.columns), *legacy.bin_features()]
    return rounded(out.select("order_id", *names, "is_high_value_session"))


def engineered(t):
    """Engineered rows of what the matrix reads. Fitting and encoding read them several times, each time from the
    dataset's own copy: with the orders of a customer counted on keys, the features move nothing."""
    data = modeling.modeling_dataset(t, order_count=True, columns=features.matrix_sources(["order_id"]))
    return features.engineer_features(data.withColumn("target_log", F.log1p("order_value")))


def matrix(t):
    df = engineered(t)
    pre = features.fit_preprocessor(df, SPLIT)
    return pre.apply(df, keep=["order_id"])


def _matrix_sql() -> str:
    numeric = [*fv.NUMERIC_COLUMNS, *fv.DERIVED_COLUMNS]
    derived = {
        "customer_order_count": "count(*) OVER (PARTITION BY customer_unique_id)",
        "cart_conversion": "item_count / greatest(total_cart_qty, 1)",
        "engagement_rate": "n_product_views / greatest(n_events, 1)",
        "search_intensity": "n_searches / greatest(n_events, 1)",
        "items_per_minute": "item_count / greatest(session_duration_min, 0.1e0)",
        "loyalty_numeric": _TIER, "income_x_loyalty": f"monthly_income * {_TIER}",
        "log_income": "ln(1 + monthly_income)", "purchase_hour": "hour(order_purchase_timestamp)",
        "purchase_dow": "isodow(order_purchase_timestamp) - 1",
        "age": "least(greatest(floor(date_sub('microsecond', birth_date, TIMESTAMP '2018-01-01') / 86400e6) / 365.25e0, 15), 70)",
    }
    flags = "order_purchase_timestamp < TIMESTAMP '1999-06-01' AS is_train, ln(1 + order_value) AS y, " \
        "CAST(isodow(order_purchase_timestamp) >= 6 AS DOUBLE) AS is_weekend"
    e = f"e AS (SELECT *, {flags}, " + ", ".join(f"{x} AS {n}" for n, x in derived.items()) + " FROM d)"
    s = "s AS (SELECT " + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in numeric) \
        + ", avg(y) AS y_m FROM e WHERE is_train)"
    scaled = ", ".join(f"round((e.{c} - s.{c}_m) / CASE WHEN s.{c}_s > 0 THEN s.{c}_s ELSE 1 END, 4) AS {c}"
                       for c in numeric)
    booleans = ", ".join(f"CAST(e.{c} AS DOUBLE) AS {c}" for c in fv.BOOLEAN_COLUMNS)
    te = ", ".join(f"round(coalesce(t_{c}.te, s.y_m), 4) AS {c}_te" for c in fv.TARGET_ENCODED_COLUMNS)
    joins = " ".join(f"LEFT JOIN te_{c} t_{c} ON t_{c}.k = e.{c}" for c in fv.TARGET_ENCODED_COLUMNS)
    ctes = ", ".join(_te_cte(c, "e") for c in fv.TARGET_ENCODED_COLUMNS)
    return (f"WITH d AS ({modeling_sql(12)}), {e}, {s}, {ctes} SELECT e.order_id, {scaled}, {booleans}, "
            f"{_one_hot_sql(_LEVELS, 'e.')}, {te}, e.is_weekend FROM e JOIN s ON true {joins}")


@query("feature_matrix", _matrix_sql())
def _(t):
    return rounded(matrix(t), 4)


