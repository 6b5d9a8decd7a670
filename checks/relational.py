"""Cleaning, joins and fact tables."""

from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.functions.labels import page_group, tier_rank, urban_flag
from basketry.functions.numeric import finite_or_zero
from basketry.functions.temporal import parse_time
from basketry.operators.nulls import fill_by_type, fill_median, null_profile
from basketry.operators.sampling import stable_sample
from basketry.plans import eda, facts, legacy, modeling, validation
from basketry.session import cut_lineage
from checks import views
from checks.registry import query, rounded

# --- filters, fills, lookups


@query("filter_status", "SELECT order_id, customer_id, order_status FROM v_kept")
def _(t):
    return facts.kept_orders(t["orders"]).select("order_id", "customer_id", "order_status")


@query("semi_join_valid_orders", "SELECT order_id, order_value, freight_value, item_count FROM v_kept_value")
def _(t):
    return facts.valued_orders(facts.order_value(facts.dedup_items(t["items"])), facts.kept_orders(t["orders"]))


@query("fill_from_column", """
    SELECT order_id, coalesce(order_approved_at, order_purchase_timestamp) AS order_approved_at FROM v_orders""")
def _(t):
    return facts.with_approval(t["orders"]).select("order_id", "order_approved_at")


@query("fill_constant", """
    SELECT product_id, coalesce(product_category_name, 'unknown') AS product_category_name FROM v_products""")
def _(t):
    return t["products"].na.fill(fv.UNKNOWN, ["product_category_name"])


@query("fill_median", """
    WITH x AS (SELECT customer_id, CAST(customer_zip_code_prefix AS DOUBLE) AS z, geo_lat, geo_lng
      FROM v_customers LEFT JOIN v_centroid ON zip = customer_zip_code_prefix)
    SELECT customer_id, round(coalesce(geo_lat, (SELECT median(geo_lat) FROM x)), 6) AS geo_lat,
      round(coalesce(geo_lng, (SELECT median(geo_lng) FROM x)), 6) AS geo_lng FROM x""")
def _(t):
    places = facts.customer_places(t["customers"], facts.geo_centroid(t["geolocation"]))
    return rounded(fill_median(places, ["geo_lat", "geo_lng"]).drop("customer_urban"))


_BY_TYPE = """
    WITH x AS (SELECT order_id, order_approved_at, customer_state, review_score, n_payments
      FROM v_orders LEFT JOIN v_review USING (order_id) LEFT JOIN v_pay USING (order_id)
        LEFT JOIN (SELECT customer_id, customer_state FROM v_customers JOIN v_region_index USING (customer_state)
          WHERE regional_price_index > 1) USING (customer_id))
    SELECT order_id,
      coalesce(order_approved_at, (SELECT order_approved_at FROM x WHERE order_approved_at IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS order_approved_at,
      coalesce(customer_state, 'unknown') AS customer_state,
      round(coalesce(CAST(review_score AS DOUBLE), (SELECT median(review_score) FROM x)), 6) AS review_score,
      coalesce(CAST(n_payments AS DOUBLE), (SELECT median(n_payments) FROM x)) AS n_payments FROM x"""


@query("fill_by_type", _BY_TYPE)
def _(t):
    kept = facts.kept_orders(t["orders"])
    values = facts.valued_orders(facts.order_value(facts.dedup_items(t["items"])), kept)
    index = facts.regional_price_index(values, kept, t["customers"]).where("regional_price_index > 1")
    dear = t["customers"].join(index, "customer_state").select("customer_id", "customer_state")
    df = (t["orders"].select("order_id", "customer_id", "order_approved_at")
          .join(facts.review_summary(t["reviews"]), "order_id", "left")
          .join(facts.payment_summary(t["payments"]).select("order_id", "n_payments"), "order_id", "left")
          .join(dear, "customer_id", "left").drop("customer_id"))
    return rounded(fill_by_type(df, [c for c in df.columns if c != "order_id"]))


_PROFILED = ("order_id", "order_status", "order_approved_at", "review_score", "payment_type",
             "payment_installments", "odd_score")


@query("null_profile", """
    WITH x AS (SELECT order_id, order_status, order_approved_at, review_score, payment_type, payment_installments,
        CASE order_id % 5 WHEN 0 THEN CAST('Infinity' AS DOUBLE) WHEN 1 THEN CAST('-Infinity' AS DOUBLE) ELSE review_score END AS odd_score
      FROM v_orders LEFT JOIN v_review USING (order_id) LEFT JOIN v_pay USING (order_id))
    """ + "\n    UNION ALL ".join(
        f'SELECT \'{c}\' AS "column", count(*) - count({c}) AS nulls, '
        + (f"count(*) FILTER (WHERE isinf({c}))" if c in ("review_score", "odd_score") else "CAST(0 AS BIGINT)") + " AS infinities FROM x"
        for c in _PROFILED))
def _(t):
    far = F.lit(float("inf"))
    odd = F.when(F.col("order_id") % 5 == 0, far).when(F.col("order_id") % 5 == 1, -far).otherwise(F.col("review_score"))
    return null_profile(
        t["orders"].join(facts.review_summary(t["reviews"]), "order_id", "left")
        .join(facts.payment_summary(t["payments"]), "order_id", "left").withColumn("odd_score", odd).select(*_PROFILED))


@query("translate_category", "SELECT * FROM v_products_en")
def _(t):
    return facts.translated_products(t["products"], t["category_translation"])


@query("tier_rank", """
    SELECT customer_id, loyalty_tier, CASE loyalty_tier WHEN 'silver' THEN 2 WHEN 'gold' THEN 3
      WHEN 'platinum' THEN 4 ELSE 1 END AS loyalty_numeric FROM v_profile""")
def _(t):
    return t["profile"].select("customer_id", "loyalty_tier", tier_rank("loyalty_tier").alias("loyalty_numeric"))


@query("urban_flag", """
    SELECT zip, city, lower(city) IN ('sao paulo', 'campinas', 'recife') AS is_major,
      CAST(lower(city) IN ('sao paulo', 'campinas', 'recife') AS INT) AS urban, count(*) AS n
    FROM v_geolocation GROUP BY 1, 2, 3, 4""")
def _(t):
    geo = t["geolocation"].select(F.col("geolocation_zip_code_prefix").alias("zip"),
                                  F.col("geolocation_city").alias("city"))
    marked = geo.withColumn("urban", urban_flag("city"))
    return marked.groupBy("zip", "city", (F.col("urban") == 1).alias("is_major"), "urban").agg(
        F.count("*").alias("n"))


@query("inf_to_zero", """
    SELECT order_id, coalesce(round(CASE WHEN pages_viewed > 0
      THEN session_duration_seconds / pages_viewed END, 6), 0) AS seconds_per_page FROM v_behavior""")
def _(t):
    pages, seconds = F.col("pages_viewed").cast("double"), F.col("session_duration_seconds").cast("double")
    raw = F.when(pages > 0, seconds / pages).when(seconds > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return t["behavioral_sessions"].select("order_id", F.round(finite_or_zero(raw), 6).alias("seconds_per_page"))


@query("cast_flags", """
    SELECT CAST(session_id AS VARCHAR) AS session_id, CAST(is_logged_in AS INT) AS is_logged_in,
      CAST(coupon_applied AS DOUBLE) AS coupon_applied FROM v_sessions""")
def _(t):
    return t["sessions"].select(F.col("session_id").cast("string"), F.col("is_logged_in").cast("int"),
                                F.col("coupon_applied").cast("double"))


@query("parse_ts_lenient", """
    SELECT order_id, try_cast(CASE order_status WHEN 'canceled' THEN 'n/a'
      ELSE strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS bought_at FROM v_orders""")
def _(t):
    text = F.when(F.col("order_status") == "canceled", "n/a").otherwise(
        F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss"))
    return t["orders"].select("order_id", parse_time(text).alias("bought_at"))


_REPEATED = """WITH o AS (SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM v_orders),
    r AS (SELECT * FROM o UNION ALL SELECT * FROM o WHERE order_id % 3 = 0
      UNION ALL SELECT order_id, customer_id + 1, 'repeated', order_purchase_timestamp FROM o WHERE order_id % 5 = 0
      UNION ALL SELECT order_id, customer_id, 'a first status', order_purchase_timestamp FROM o WHERE order_id % 7 = 0
      UNION ALL SELECT order_id, customer_id, 'earlier', order_purchase_timestamp - INTERVAL 1 DAY FROM o WHERE order_id % 11 = 0)"""


@query("dedup_orders", f"""
    {_REPEATED} SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM (SELECT *, row_number() OVER (
      PARTITION BY order_id ORDER BY order_purchase_timestamp, customer_id, order_status) AS rn FROM r) WHERE rn = 1""")
def _(t):
    o = t["orders"].select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    at = F.col("order_purchase_timestamp")
    repeated = (o.unionByName(o.where("order_id % 3 = 0"))
                .unionByName(o.where("order_id % 5 = 0").withColumns({"customer_id": F.col("customer_id") + 1, "order_status": F.lit("repeated")}))
                .unionByName(o.where("order_id % 7 = 0").withColumn("order_status", F.lit("a first status")))
                .unionByName(o.where("order_id % 11 = 0").withColumns(
                    {"order_status": F.lit("earlier"), "order_purchase_timestamp": at - F.expr("INTERVAL 1 DAY")})))
    return facts.dedup_orders(repeated)


@query("dedup_items", """
    SELECT order_id, order_item_id, product_id, seller_id, price, freight_value, shipping_limit_date FROM v_items1""")
def _(t):
    return facts.dedup_items(t["items"])


@query("event_page_group", """
    SELECT activity_id, CASE activity_type WHEN 'search' THEN '/search' WHEN 'product_view' THEN '/product'
      WHEN 'add_to_cart' THEN '/cart' WHEN 'checkout' THEN '/checkout' ELSE '/' END AS page FROM v_events""")
def _(t):
    return t["events"].select("activity_id", page_group("activity_type").alias("page"))


@query("stable_sample", """
    SELECT order_id, order_value FROM v_value ORDER BY md5('123:' || order_id), order_id LIMIT 5000""")
def _(t):
    values = facts.order_value(facts.dedup_items(t["items"])).select("order_id", "order_value")
    return stable_sample(values, "order_id", 5000)


@query("expand_rows", """
    SELECT order_id, n, count(*) OVER (PARTITION BY order_id) AS item_count
    FROM (SELECT order_id, unnest(range(1, item_count + 1)) AS n FROM v_value)""")
def _(t):
    values = facts.order_value(facts.dedup_items(t["items"]))
    return values.select("order_id", F.explode(F.sequence(F.lit(1), F.col("item_count"))).alias("n"), "item_count")


# --- joins


@query("join_order_customer", """
    SELECT o.order_id, c.customer_unique_id, c.customer_state FROM v_orders o JOIN v_customers c USING (customer_id)""")
def _(t):
    return t["orders"].join(t["customers"], "customer_id").select(
        "order_id", "customer_unique_id", "customer_state")


@query("join_left_items", """
    SELECT order_id, order_status, order_value, coalesce(item_count, 0) AS item_count
    FROM v_orders LEFT JOIN v_value USING (order_id)""")
def _(t):
    values = facts.order_value(facts.dedup_items(t["items"]))
    return t["orders"].join(values, "order_id", "left").select(
        "order_id", "order_status", "order_value", F.coalesce("item_count", F.lit(0)).alias("item_count"))


@query("join_profile", """
    SELECT c.customer_id, p.loyalty_tier, p.monthly_income
    FROM v_customers c JOIN v_profile p ON c.customer_unique_id = p.customer_id""")
def _(t):
    profile = t["profile"].withColumnRenamed("customer_id", "person")
    return t["customers"].join(profile, F.col("customer_unique_id") == F.col("person")).select(
        "customer_id", "loyalty_tier", "monthly_income")


@query("align_cart_to_sessions", """
    SELECT s.session_id, coalesce(a.total_cart_qty, 0) AS cart_qty, coalesce(v.item_count, 1) AS item_count
    FROM v_sessions s LEFT JOIN v_act a USING (session_id) LEFT JOIN v_raw_value v ON v.order_id = s.order_id""")
def _(t):
    return validation.align_cart(t["sessions"], t["session_items"], facts.order_value(t["items"]))


@query("events_outside_session", """
    SELECT activity_id, session_id, CAST(activity_timestamp < session_start AS INT) AS is_before,
      CAST(activity_timestamp > session_end AS INT) AS is_after
    FROM v_timed_items JOIN (SELECT session_id, session_start, session_end FROM v_sessions) USING (session_id)
    WHERE activity_timestamp < session_start OR activity_timestamp > session_end""")
def _(t):
    return validation.events_outside(t["timed_session_items"], t["sessions"])


MODEL_COLUMNS = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_value", "freight_value",
    "item_count", "customer_unique_id", "customer_state", "geo_lat", "geo_lng", "customer_urban",
    "primary_category", "n_categories", "product_category_name_english", "cat_avg_price", "cat_std_price",
    "cat_order_count", "seller_id", "seller_order_count", "seller_avg_price", "seller_item_count",
    "seller_n_categories", "seller_state", "seller_lat", "seller_lng", "customer_id_profile", "gender",
    "birth_date", "marital_status", "occupation", "education_level", "monthly_income", "household_size",
    "loyalty_tier", "registration_channel", "is_marketing_opt_in", "preferred_device", "session_id",
    "session_start", "session_end", "device_type", "browser", "operating_system", "traffic_source",
    "traffic_medium", "campaign_name", "landing_page", "ip_country", "ip_region", "is_logged_in",
    "coupon_applied", "discount_amount_pct", "n_events", "n_product_views", "n_searches", "n_add_to_cart",
    "total_cart_qty", "avg_scroll", "avg_page_duration", "customer_age_days", "recency_days", "frequency",
    "purchase_month", "purchase_quarter", "purchase_day_of_month", "n_payments", "payment_type",
    "payment_installments", "review_score", "session_duration_min", "regional_price_index",
    "cust_seller_distance_km")
_FILLED_NUMBERS = (
    "geo_lat", "geo_lng", "n_categories", "cat_avg_price", "cat_std_price", "cat_order_count",
    "seller_order_count", "seller_avg_price", "seller_item_count", "seller_n_categories", "seller_lat",
    "seller_lng", "monthly_income", "household_size", "discount_amount_pct", "n_events", "n_product_views",
    "n_searches", "n_add_to_cart", "total_cart_qty", "avg_scroll", "avg_page_duration", "n_payments",
    "payment_installments", "review_score")
_FILLED_TEXTS = (
    "primary_category", "product_category_name_english", "seller_state", "campaign_name", "payment_type")
KM = ("2 * 6371 * asin(sqrt(pow(sin(radians(coalesce({b}lat, -15.78e0) - coalesce({a}lat, -15.78e0)) / 2), 2)"
      " + cos(radians(coalesce({a}lat, -15.78e0))) * cos(radians(coalesce({b}lat, -15.78e0)))"
      " * pow(sin(radians(coalesce({b}lng, -47.93e0) - coalesce({a}lng, -47.93e0)) / 2), 2)))")


def modeling_sql(digits: int = 4) -> str:
    """The modeling dataset with its fills, from the merged view."""
    cells = []
    for c in MODEL_COLUMNS:
        if c in _FILLED_NUMBERS:
            cells.append(f"round(coalesce(CAST(m.{c} AS DOUBLE), f.{c}), {digits}) AS {c}")
        elif c in _FILLED_TEXTS:
            cells.append(f"coalesce(m.{c}, 'unknown') AS {c}")
        elif c == "cust_seller_distance_km":
            cells.append(f"round({KM.format(a='m.geo_', b='m.seller_')}, {digits}) AS {c}")
        elif c in ("session_duration_min", "regional_price_index", "order_value", "freight_value"):
            cells.append(f"round(m.{c}, {digits}) AS {c}")
        else:
            cells.append(f"m.{c}")
    medians = ", ".join(f"median({c}) AS {c}" for c in _FILLED_NUMBERS)
    return f"SELECT {', '.join(cells)} FROM v_merged m, (SELECT {medians} FROM v_merged) f"


@query("modeling_dataset", modeling_sql())
def _(t):
    return rounded(modeling.modeling_dataset(t), 4)


_AUDIT = """
    WITH s AS (
      SELECT 'duplicate orders' AS step, (SELECT count(*) FROM v_orders) AS before,
        (SELECT count(DISTINCT order_id) FROM v_orders) AS after
      UNION ALL SELECT 'duplicate items', (SELECT count(*) FROM v_items), (SELECT count(*) FROM v_items1)
      UNION ALL SELECT 'status filter', (SELECT count(DISTINCT order_id) FROM v_orders), (SELECT count(*) FROM v_kept)
      UNION ALL SELECT 'order value', (SELECT count(*) FROM v_orders), (SELECT count(*) FROM v_kept_value)
      UNION ALL SELECT 'modeling dataset', (SELECT count(*) FROM v_orders), (SELECT count(*) FROM v_merged))
    SELECT step, before, after, round(after * 100e0 / before, 6) AS kept_pct FROM s"""


@query("cleaning_audit", _AUDIT)
def _(t):
    return rounded(modeling.cleaning_audit(t))


@query("cleaning_audit_counted", _AUDIT)
def _(t):
    """The same figures from the writes of the dataset."""
    counts = modeling.CleaningCounts()
    written = cut_lineage(modeling.modeling_dataset(t, counts=counts))
    return rounded(modeling.counted_audit(written.sparkSession, counts))


EDA_COLUMNS = (
    "order_id", "order_status", "order_purchase_timestamp", "order_value", "freight_value", "item_count",
    "avg_item_price", "product_category_name", "product_category_name_english", "customer_unique_id",
    "customer_state", "gender", "monthly_income", "household_size", "loyalty_tier", "preferred_device",
    "session_id", "device_type", "traffic_source", "coupon_applied", "discount_amount_pct", "n_events",
    "n_product_views", "n_searches", "total_cart_qty", "avg_scroll", "avg_page_duration",
    "session_duration_min")


@query("eda_dataset", "SELECT * REPLACE (round(avg_item_price, 6) AS avg_item_price, "
       "round(avg_scroll, 6) AS avg_scroll, round(avg_page_duration, 6) AS avg_page_duration, "
       "round(session_duration_min, 6) AS session_duration_min) FROM v_eda")
def _(t):
    return rounded(eda.eda_dataset(t).select(*EDA_COLUMNS))


# --- the delivered-orders pipeline


def cleaned(t):
    return legacy.clean_orders(t["delivered_orders"], t["customers"], t["payments"],
                               facts.dedup_items(t["items"]))


@query("clean_orders_delivery", "SELECT * FROM v_clean_orders")
def _(t):
    return cleaned(t).select("order_id", "order_status", "customer_city", "customer_state",
                             "payment_value", "order_value", "delivery_days")


@query("clean_sessions", "SELECT * FROM v_clean_sessions")
def _(t):
    return legacy.clean_sessions(t["behavioral_sessions"])


@query("final_dataset", """
    WITH m AS (SELECT median(session_duration_seconds) AS d, median(pages_viewed) AS p FROM v_final)
    SELECT v_final.*, round(ln(1 + order_value), 6) AS log_order_value,
      round(session_duration_seconds / pages_viewed, 6) AS avg_time_per_page,
      round(cart_additions / pages_viewed, 6) AS cart_per_page,
      CAST(session_duration_seconds > m.d AND pages_viewed > m.p AS INT) AS is_high_engagement,
      coupon_applied AS has_coupon FROM v_final, m""")
def _(t):
    return rounded(legacy.final_dataset(legacy.clean_sessions(t["behavioral_sessions"]), cleaned(t)))


# --- facts


@query("order_value", "SELECT * FROM v_value")
def _(t):
    return facts.order_value(facts.dedup_items(t["items"]))


@query("order_value_legacy", """
    WITH v AS (SELECT order_id, CAST(sum(CAST(round(price * 100) AS BIGINT)) AS BIGINT) / 1e2 AS order_value
        FROM v_items1 GROUP BY 1),
      y AS (SELECT order_id, CAST(sum(CAST(round(payment_value * 100) AS BIGINT)) AS BIGINT) / 1e2 AS payment_value
        FROM v_payments GROUP BY 1)
    SELECT order_id, order_value, payment_value FROM v LEFT JOIN y USING (order_id)""")
def _(t):
    return facts.order_value_legacy(facts.dedup_items(t["items"]), t["payments"])


@query("customer_value", """
    SELECT customer_unique_id, round(CAST(sum(CAST(round(order_value * 100) AS BIGINT)) AS BIGINT) / count(*) / 1e2, 6) AS avg_value,
      count(*) AS order_count, round(CAST(sum(item_count) AS BIGINT) / count(*), 6) AS avg_items
    FROM v_value JOIN v_orders USING (order_id) JOIN v_customers USING (customer_id)
    WHERE order_status = 'delivered' GROUP BY 1""")
def _(t):
    return rounded(facts.customer_value(facts.order_value(facts.dedup_items(t["items"])), t["orders"],
                                        t["customers"]))


@query("geo_centroid", """
    SELECT zip AS geolocation_zip_code_prefix, round(geo_lat, 6) AS geo_lat, round(geo_lng, 6) AS geo_lng,
      geo_city, geo_state FROM v_centroid""")
def _(t):
    return rounded(facts.geo_centroid(t["geolocation"]))


def lines_of(t):
    products = facts.translated_products(t["products"], t["category_translation"])
    return facts.categorised_items(facts.dedup_items(t["items"]), products)


@query("seller_stats", "SELECT * REPLACE (round(seller_avg_price, 6) AS seller_avg_price) FROM v_seller_stats")
def _(t):
    return rounded(facts.seller_stats(lines_of(t)))


@query("category_price_stats", """
    SELECT product_category_name_english, round(cat_avg_price, 4) AS cat_avg_price,
      round(cat_std_price, 4) AS cat_std_price, cat_order_count FROM v_cat_stats""")
def _(t):
    return rounded(facts.category_price_stats(lines_of(t)), 4)


def as_of_inputs(t):
    return lines_of(t), facts.dedup_orders(t["orders"])


_TIMED = """l AS (SELECT c.*, o.order_purchase_timestamp AS sold FROM v_cat_lines c JOIN v_orders o USING (order_id))"""


@query("seller_stats_as_of", f"""
    WITH {_TIMED}, q AS (SELECT order_id, seller_id, order_purchase_timestamp AS asked
      FROM v_primary_seller JOIN v_orders USING (order_id))
    SELECT q.order_id, q.seller_id, count(DISTINCT l.order_id) AS seller_order_count,
      round(CAST(sum({views.cents('price')}) AS BIGINT) / count(price) / 1e2, 6) AS seller_avg_price,
      count(l.order_id) AS seller_item_count, count(DISTINCT product_category_name_english) AS seller_n_categories
    FROM q LEFT JOIN l ON l.seller_id = q.seller_id AND l.sold < q.asked GROUP BY ALL""")
def _(t):
    return rounded(facts.seller_stats_as_of(*as_of_inputs(t)))


@query("category_price_as_of", f"""
    WITH {_TIMED}, d AS (SELECT product_category_name_english AS category, sold, count(*) AS n, sum({views.cents('price')}) AS s,
        sum(price * price) AS ss, count(DISTINCT order_id) AS orders FROM l WHERE category IS NOT NULL GROUP BY ALL),
    w AS (SELECT category, sold, sum(n) OVER k AS n, CAST(sum(s) OVER k AS BIGINT) AS s, sum(ss) OVER k AS ss, sum(orders) OVER k AS orders
      FROM d WINDOW k AS (PARTITION BY category ORDER BY sold ROWS UNBOUNDED PRECEDING)),
    q AS (SELECT order_id, primary_category, order_purchase_timestamp AS asked FROM v_order_category JOIN v_orders USING (order_id))
    SELECT q.order_id, primary_category, round(s / n / 1e2, 4) AS cat_avg_price,
      CASE WHEN n > 1 THEN round(sqrt(greatest(ss - s / 1e2 * (s / 1e2) / n, 0) / (n - 1)), 2) ELSE 0 END AS cat_std_price,
      CAST(coalesce(orders, 0) AS BIGINT) AS cat_order_count
    FROM q ASOF LEFT JOIN w ON w.category = q.primary_category AND w.sold < q.asked""")
def _(t):
    found = facts.category_price_as_of(*as_of_inputs(t))
    return found.withColumns({"cat_avg_price": F.round("cat_avg_price", 4), "cat_std_price": F.round("cat_std_price", 2)})


@query("order_primary_category", "SELECT * FROM v_order_category")
def _(t):
    return facts.order_category(lines_of(t))


@query("primary_seller", "SELECT * FROM v_primary_seller")
def _(t):
    return facts.primary_seller(facts.dedup_items(t["items"]))


_ACTIVITY_SQL = """
    SELECT session_id, count(*) AS n_events,
      count(*) FILTER (WHERE activity_type = 'product_view') AS n_product_views,
      count(*) FILTER (WHERE activity_type = 'search') AS n_searches,
      count(*) FILTER (WHERE activity_type = 'add_to_cart') AS n_add_to_cart,
      CAST(sum(add_to_cart_quantity) AS BIGINT) AS total_cart_qty,
      round(CAST(sum(scroll_percent) AS BIGINT) / count(*), 6) AS avg_scroll,
      round(CAST(sum(duration_seconds) AS BIGINT) / count(*), 6) AS avg_page_duration
    FROM v_activity GROUP BY session_id"""


@query("session_activity_agg", _ACTIVITY_SQL)
def _(t):
    return rounded(facts.session_activity(t["events"]))


@query("session_event_presence", "SELECT session_id, " + ", ".join(
    f"max(CAST(activity_type = '{k}' AS INT)) AS has_{k}" for k in fv.ACTIVITY_TYPES)
    + " FROM v_activity GROUP BY session_id")
def _(t):
    return facts.event_presence(t["events"])


@query("last_event_type", """
    SELECT session_id, count(*) AS n_events, last(activity_type ORDER BY activity_timestamp, activity_id) AS last_type
    FROM v_activity GROUP BY session_id""")
def _(t):
    return facts.last_event(t["events"])


@query("cart_reconcile", """
    WITH x AS (SELECT i.*, row_number() OVER (PARTITION BY session_id
          ORDER BY activity_type <> 'add_to_cart', event_no, activity_id) AS rn,
        coalesce(v.item_count, 1) - sum(add_to_cart_quantity) OVER (PARTITION BY session_id) AS gap
      FROM v_session_items i LEFT JOIN v_raw_value v USING (order_id))
    SELECT activity_id, session_id,
      CASE WHEN rn = 1 AND gap > 0 THEN 'add_to_cart' ELSE activity_type END AS activity_type,
      CAST(add_to_cart_quantity + CASE WHEN rn = 1 AND gap > 0 THEN gap ELSE 0 END AS BIGINT) AS add_to_cart_quantity
    FROM x""")
def _(t):
    expected = facts.order_value(t["items"]).select(F.col("order_id").alias("session_id"), "item_count")
    return facts.reconciled_cart(t["session_items"], expected, ["event_no", "activity_id"]).select(
        "activity_id", "session_id", "activity_type", "add_to_cart_quantity")


@query("rfm_features", "SELECT * FROM v_rfm")
def _(t):
    return facts.rfm_features(facts.kept_orders(facts.dedup_orders(t["orders"])))


@query("customer_order_count", """
    SELECT order_id, count(order_id) OVER (PARTITION BY customer_id) AS customer_order_count FROM v_kept""")
def _(t):
    kept = facts.kept_orders(t["orders"]).select("order_id", "customer_id")
    return facts.customer_order_count(kept, "customer_id").drop("customer_id")


@query("regional_price_index", """
    SELECT customer_state, round(regional_price_index, 6) AS regional_price_index FROM v_region_index""")
def _(t):
    kept = facts.kept_orders(t["orders"])
    values = facts.valued_orders(facts.order_value(facts.dedup_items(t["items"])), kept)
    return rounded(facts.regional_price_index(values, kept, t["customers"]))


@query("payment_agg", "SELECT * FROM v_pay")
def _(t):
    return facts.payment_summary(t["payments"])


@query("review_agg", "SELECT order_id, round(review_score, 6) AS review_score FROM v_review")
def _(t):
    return rounded(facts.review_summary(t["reviews"]))
