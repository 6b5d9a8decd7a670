"""SQL forms of the adapter views and shared intermediate tables.

``sql(text)`` puts a WITH clause in front of a query that holds exactly the
views it mentions, directly or through other views.
"""

from __future__ import annotations

import re

SPLIT = "1999-06-01"


def pick(index: str, *labels) -> str:
    items = ", ".join(str(x) if isinstance(x, int) else f"'{x}'" for x in labels)
    return f"list_extract([{items}], CAST(({index}) % {len(labels)} AS INT) + 1)"


def cents(name: str) -> str:
    return f"CAST(round({name} * 100) AS BIGINT)"


_BOUGHT = "o_orderdate + to_seconds(o_orderkey * 7919 % 86400)"
_START = f"{_BOUGHT} - to_seconds(o_orderkey * 13 % 10500 + 300)"
_MEDIUM = pick("o_orderkey // 5", "organic", "cpc", "direct", "social", "email")
_BY_ALL = ("l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, "
           "l_linestatus, l_shipdate")

VIEWS = {
    "v_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
          CASE o_orderstatus WHEN 'O' THEN 'delivered' WHEN 'F' THEN 'shipped' ELSE 'canceled' END AS order_status,
          {_BOUGHT} AS order_purchase_timestamp,
          CASE WHEN o_orderkey % 10 <> 0 THEN {_BOUGHT} END AS order_approved_at,
          o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date
        FROM orders""",
    "v_kept": "SELECT * FROM v_orders WHERE order_status IN ('delivered', 'shipped')",
    "v_items": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
          l_suppkey AS seller_id, l_extendedprice AS price,
          (({cents('l_extendedprice')} * {cents('l_tax')} + 50) // 100) / 1e2 AS freight_value,
          l_shipdate AS shipping_limit_date
        FROM lineitem""",
    "v_items1": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
            ORDER BY product_id, seller_id, price, freight_value, shipping_limit_date) AS rn FROM v_items)
        WHERE rn = 1""",
    "v_lines": f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_BY_ALL}) AS rn
          FROM lineitem) WHERE rn = 1""",
    "v_customers": """
        SELECT c_custkey AS customer_id, c_custkey + 1000000 AS customer_unique_id,
          CAST(c_custkey % 220 AS INT) AS customer_zip_code_prefix,
          'city_' || (c_custkey % 220) AS customer_city, n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_products": """
        SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS product_category_name
        FROM part""",
    "v_translation": """
        SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
        FROM part WHERE p_type <> 'STANDARD'""",
    "v_products_en": """
        SELECT p.product_id, coalesce(p.product_category_name, 'unknown') AS product_category_name,
          coalesce(t.product_category_name_english, 'unknown') AS product_category_name_english
        FROM v_products p LEFT JOIN v_translation t
          ON coalesce(p.product_category_name, 'unknown') = t.product_category_name""",
    "v_sellers": """
        SELECT s_suppkey AS seller_id, CAST(s_suppkey * 7 % 230 AS INT) AS seller_zip_code_prefix,
          n_name AS seller_state FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "v_geolocation": """
        SELECT CAST(o_custkey % 200 AS INT) AS zip, o_orderkey * 7 % 300 / 1e1 - 30 AS lat,
          o_orderkey * 11 % 250 / 1e1 - 60 AS lng,
          CASE o_orderkey % 5 WHEN 0 THEN 'Sao Paulo' WHEN 1 THEN 'Campinas' WHEN 2 THEN 'RECIFE'
            WHEN 3 THEN 'ouro preto' ELSE 'city_' || (o_custkey % 200) END AS city,
          'ST_' || (o_custkey % 200 % 27) AS state
        FROM orders""",
    "v_payments": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
          CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
          CAST(l_quantity AS INT) AS payment_installments,
          (({cents('l_extendedprice')} * (100 - {cents('l_discount')}) + 50) // 100) / 1e2 AS payment_value
        FROM v_lines""",
    "v_reviews": """
        SELECT l_orderkey AS order_id,
          CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS INT) % 5 + 1 END AS review_score
        FROM v_lines""",
    "v_profile": f"""
        SELECT c_custkey + 1000000 AS customer_id,
          {pick('c_custkey', 'male', 'female', 'other')} AS gender,
          TIMESTAMP '1950-01-01' + to_days(CAST(c_custkey * 37 % 19000 AS INT)) AS birth_date,
          {pick('c_custkey // 3', 'single', 'married', 'divorced', 'widowed')} AS marital_status,
          {pick('c_custkey // 2', 'professional', 'student', 'self_employed', 'retired', 'unemployed', 'homemaker', 'other')} AS occupation,
          {pick('c_custkey // 5', 'high_school', 'bachelor', 'master', 'phd', 'none')} AS education_level,
          greatest(500e0, c_acctbal) AS monthly_income, c_custkey % 10 + 1 AS household_size,
          {pick('c_custkey', 'bronze', 'silver', 'gold', 'platinum')} AS loyalty_tier,
          {pick('c_custkey', 'organic', 'paid_ads', 'referral', 'social', 'email')} AS registration_channel,
          c_custkey % 2 = 0 AS is_marketing_opt_in,
          {pick('c_custkey', 'mobile', 'desktop', 'tablet')} AS preferred_device
        FROM customer""",
    "v_sessions": f"""
        SELECT o_orderkey AS session_id, o_custkey + 1000000 AS customer_id, o_orderkey AS order_id,
          {_START} AS session_start, {_START} + to_seconds(o_orderkey * 17 % 3590 + 10) AS session_end,
          {pick('o_orderkey', 'mobile', 'desktop', 'tablet')} AS device_type,
          {pick('o_orderkey // 2', 'chrome', 'safari', 'firefox', 'edge', 'other')} AS browser,
          {pick('o_orderkey // 4', 'android', 'windows', 'ios', 'macos', 'linux')} AS operating_system,
          {pick('o_orderkey // 3', 'google', 'direct', 'facebook', 'instagram', 'email')} AS traffic_source,
          {_MEDIUM} AS traffic_medium,
          CASE WHEN {_MEDIUM} NOT IN ('organic', 'direct') THEN
            {pick('o_orderkey // 7', 'summer_sale', 'black_friday', 'christmas', 'free_shipping', 'flash_deal')} END AS campaign_name,
          {pick('o_orderkey', '/', '/category', '/product', '/search')} AS landing_page,
          CASE WHEN o_orderkey % 50 = 0 THEN 'US' ELSE 'BR' END AS ip_country,
          'R' || (o_custkey % 27) AS ip_region, o_orderkey % 10 < 7 AS is_logged_in,
          o_orderkey % 4 = 0 AS coupon_applied,
          CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 21 + 5 AS DOUBLE) ELSE 0e0 END AS discount_amount_pct
        FROM orders""",
    "v_session_items": """
        SELECT l_orderkey * 10 + l_linenumber AS activity_id, l_orderkey AS session_id, l_orderkey AS order_id,
          l_linenumber AS event_no,
          CASE WHEN l_returnflag = 'A' THEN 'add_to_cart'
            WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'F' THEN 'product_view' ELSE 'search' END
            WHEN l_linestatus = 'F' THEN 'page_view' ELSE 'checkout' END AS activity_type,
          CAST(l_quantity AS INT) * 7 % 600 AS duration_seconds, CAST(l_quantity AS INT) * 2 % 101 AS scroll_percent,
          CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS INT) % 5 + 1 ELSE 0 END AS add_to_cart_quantity
        FROM v_lines""",
    "v_timed_items": """
        SELECT i.*, s.session_start + to_seconds(i.event_no * 97) AS activity_timestamp
        FROM v_session_items i JOIN v_sessions s USING (session_id)""",
    "v_events": """
        SELECT event_id AS activity_id, user_id AS customer_id, ts AS activity_timestamp,
          CASE event_type WHEN 'click' THEN 'page_view' WHEN 'signup' THEN 'search' WHEN 'view' THEN 'product_view'
            WHEN 'error' THEN 'add_to_cart' ELSE 'checkout' END AS activity_type,
          CAST(floor(value) AS INT) AS duration_seconds,
          CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS scroll_percent,
          CASE WHEN event_type = 'error' THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 5 + 1
            ELSE 0 END AS add_to_cart_quantity
        FROM events""",
    "v_gaps": """
        SELECT *, lag(activity_timestamp) OVER (PARTITION BY customer_id
          ORDER BY activity_timestamp, activity_id) AS previous_at FROM v_events""",
    "v_activity": """
        SELECT * EXCLUDE (previous_at), customer_id * 100000 + CAST(sum(CASE WHEN previous_at IS NULL
            OR date_sub('second', previous_at, activity_timestamp) > 43200 THEN 1 ELSE 0 END)
          OVER (PARTITION BY customer_id ORDER BY activity_timestamp, activity_id
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id
        FROM v_gaps""",
    "v_event_sessions": """
        SELECT session_id, min(customer_id) AS customer_id, min(activity_timestamp) AS session_start,
          max(activity_timestamp) AS session_end FROM v_activity GROUP BY session_id""",
    "v_behavior": f"""
        SELECT o_orderkey AS order_id, o_orderkey AS session_id,
          {pick('o_orderkey', 'mobile', 'desktop', 'tablet')} AS device_type,
          {pick('o_orderkey // 3', 'search_organic', 'direct', 'search_paid', 'social', 'email')} AS referral_channel,
          o_orderkey * 31 % 4000 AS session_duration_seconds, o_orderkey * 7 % 90 AS pages_viewed,
          o_orderkey % 5 AS cart_additions, CAST(o_orderkey % 4 = 0 AS INT) AS coupon_applied,
          {pick('o_orderkey // 5', 0, 5, 10, 15, 20)} AS discount_amount_pct
        FROM orders""",
    "v_shipped_first": """
        SELECT o.*, s.d AS order_delivered_customer_date FROM v_orders o LEFT JOIN
          (SELECT l_orderkey, min(l_shipdate) AS d FROM lineitem GROUP BY 1) s ON o.order_id = s.l_orderkey""",
    # --- facts
    "v_raw_value": f"""
        SELECT order_id, CAST(sum({cents('price')} + {cents('freight_value')}) AS BIGINT) / 1e2 AS order_value,
          CAST(sum({cents('freight_value')}) AS BIGINT) / 1e2 AS freight_value, count(*) AS item_count,
          CAST(sum({cents('price')}) AS BIGINT) / count(*) / 1e2 AS avg_item_price
        FROM v_items GROUP BY order_id""",
    "v_value": f"""
        SELECT order_id, CAST(sum({cents('price')} + {cents('freight_value')}) AS BIGINT) / 1e2 AS order_value,
          CAST(sum({cents('freight_value')}) AS BIGINT) / 1e2 AS freight_value, count(*) AS item_count
        FROM v_items1 GROUP BY order_id""",
    "v_kept_value": """
        SELECT * FROM v_value WHERE order_value > 0 AND order_id IN (SELECT order_id FROM v_kept)""",
    "v_cat_lines": """
        SELECT i.*, p.product_category_name_english FROM v_items1 i LEFT JOIN v_products_en p USING (product_id)""",
    "v_centroid": """
        SELECT zip, median(lat) AS geo_lat, median(lng) AS geo_lng,
          first(city ORDER BY lat, lng, city, state) AS geo_city,
          first(state ORDER BY lat, lng, city, state) AS geo_state
        FROM v_geolocation GROUP BY zip""",
    "v_seller_stats": f"""
        SELECT seller_id, count(DISTINCT order_id) AS seller_order_count,
          CAST(sum({cents('price')}) AS BIGINT) / count(*) / 1e2 AS seller_avg_price,
          count(*) AS seller_item_count, count(DISTINCT product_category_name_english) AS seller_n_categories
        FROM v_cat_lines GROUP BY seller_id""",
    "v_primary_seller": """
        SELECT order_id, seller_id FROM (SELECT order_id, seller_id, row_number() OVER (PARTITION BY order_id
          ORDER BY order_item_id, product_id, seller_id) AS rn FROM v_items1) WHERE rn = 1""",
    "v_cat_stats": f"""
        SELECT product_category_name_english, CAST(sum({cents('price')}) AS BIGINT) / count(*) / 1e2 AS cat_avg_price,
          coalesce(stddev_samp(price), 0) AS cat_std_price, count(DISTINCT order_id) AS cat_order_count
        FROM v_cat_lines WHERE product_category_name_english IS NOT NULL GROUP BY 1""",
    "v_cat_cells": """
        SELECT order_id, product_category_name_english AS category, count(*) AS n FROM v_cat_lines GROUP BY 1, 2""",
    "v_order_category": """
        SELECT order_id, max(CASE WHEN rn = 1 THEN category END) AS primary_category, count(*) AS n_categories
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY n DESC, category) AS rn FROM v_cat_cells)
        GROUP BY order_id""",
    "v_act": """
        SELECT session_id, count(*) AS n_events,
          count(*) FILTER (WHERE activity_type = 'product_view') AS n_product_views,
          count(*) FILTER (WHERE activity_type = 'search') AS n_searches,
          count(*) FILTER (WHERE activity_type = 'add_to_cart') AS n_add_to_cart,
          CAST(sum(add_to_cart_quantity) AS BIGINT) AS total_cart_qty,
          CAST(sum(scroll_percent) AS BIGINT) / count(scroll_percent) AS avg_scroll,
          CAST(sum(duration_seconds) AS BIGINT) / count(duration_seconds) AS avg_page_duration
        FROM v_session_items GROUP BY session_id""",
    "v_rfm": """
        SELECT order_id,
          CAST(floor(date_sub('microsecond', first_at, t) / 86400e6) AS BIGINT) AS customer_age_days,
          coalesce(CAST(floor(date_sub('microsecond', previous_at, t) / 86400e6) AS BIGINT), 0) AS recency_days,
          frequency, month(t) AS purchase_month, quarter(t) AS purchase_quarter, day(t) AS purchase_day_of_month
        FROM (SELECT order_id, order_purchase_timestamp AS t,
            min(order_purchase_timestamp) OVER (PARTITION BY customer_id) AS first_at,
            lag(order_purchase_timestamp) OVER w AS previous_at, row_number() OVER w AS frequency
          FROM v_kept WINDOW w AS (PARTITION BY customer_id ORDER BY order_purchase_timestamp, order_id))""",
    "v_pay": """
        SELECT order_id, count(*) AS n_payments,
          first(payment_type ORDER BY payment_sequential, payment_type) AS payment_type,
          max(payment_installments) AS payment_installments FROM v_payments GROUP BY order_id""",
    "v_review": """
        SELECT order_id, CAST(sum(review_score) AS BIGINT) / nullif(count(review_score), 0) AS review_score
        FROM v_reviews GROUP BY order_id""",
    "v_region_index": """
        SELECT customer_state, median(order_value) / (SELECT median(order_value) FROM v_kept_value)
          AS regional_price_index
        FROM v_kept_value JOIN v_kept USING (order_id) JOIN v_customers USING (customer_id)
        GROUP BY customer_state""",
    # --- modeling dataset before fills
    "v_merged": """
        SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
          v.order_value, v.freight_value, v.item_count, k.primary_category, k.n_categories, ps.seller_id,
          r.customer_age_days, r.recency_days, r.frequency, r.purchase_month, r.purchase_quarter,
          r.purchase_day_of_month, y.n_payments, y.payment_type, y.payment_installments, w.review_score,
          s.* EXCLUDE (customer_id, order_id), a.* EXCLUDE (session_id),
          c.customer_unique_id, c.customer_state, g.geo_lat, g.geo_lng,
          CASE WHEN lower(g.geo_city) IN ('sao paulo', 'campinas', 'recife') THEN 1 ELSE 0 END AS customer_urban,
          coalesce(x.regional_price_index, 1e0) AS regional_price_index,
          p.customer_id AS customer_id_profile, p.* EXCLUDE (customer_id),
          t.product_category_name_english, t.cat_avg_price, t.cat_std_price, t.cat_order_count,
          ss.seller_order_count, ss.seller_avg_price, ss.seller_item_count, ss.seller_n_categories,
          sl.seller_state, sg.geo_lat AS seller_lat, sg.geo_lng AS seller_lng,
          date_sub('microsecond', s.session_start, s.session_end) / 60e6 AS session_duration_min
        FROM v_kept o JOIN v_value v USING (order_id) JOIN v_order_category k USING (order_id)
          JOIN v_primary_seller ps USING (order_id) JOIN v_rfm r USING (order_id)
          LEFT JOIN v_pay y USING (order_id) LEFT JOIN v_review w USING (order_id)
          JOIN v_sessions s USING (order_id) LEFT JOIN v_act a ON a.session_id = s.session_id
          JOIN v_customers c ON c.customer_id = o.customer_id
          LEFT JOIN v_centroid g ON g.zip = c.customer_zip_code_prefix
          LEFT JOIN v_region_index x ON x.customer_state = c.customer_state
          JOIN v_profile p ON p.customer_id = c.customer_unique_id
          LEFT JOIN v_cat_stats t ON t.product_category_name_english = k.primary_category
          LEFT JOIN v_seller_stats ss ON ss.seller_id = ps.seller_id
          LEFT JOIN v_sellers sl ON sl.seller_id = ps.seller_id
          LEFT JOIN v_centroid sg ON sg.zip = sl.seller_zip_code_prefix
        WHERE v.order_value > 0""",
    # --- analysis dataset
    "v_eda_category": """
        SELECT order_id, product_category_name FROM (
          SELECT order_id, product_category_name, row_number() OVER (PARTITION BY order_id
            ORDER BY count(*) DESC, product_category_name) AS rn
          FROM v_items JOIN v_products USING (product_id) WHERE product_category_name IS NOT NULL
          GROUP BY order_id, product_category_name) WHERE rn = 1""",
    "v_eda": """
        SELECT o.order_id, o.order_status, o.order_purchase_timestamp, v.order_value, v.freight_value, v.item_count,
          v.avg_item_price, k.product_category_name, t.product_category_name_english, c.customer_unique_id,
          c.customer_state, p.gender, p.monthly_income, p.household_size, p.loyalty_tier, p.preferred_device,
          s.session_id, s.device_type, s.traffic_source, s.coupon_applied, s.discount_amount_pct,
          a.n_events, a.n_product_views, a.n_searches, a.total_cart_qty, a.avg_scroll, a.avg_page_duration,
          date_sub('microsecond', s.session_start, s.session_end) / 60e6 AS session_duration_min
        FROM v_orders o JOIN v_raw_value v USING (order_id) LEFT JOIN v_eda_category k USING (order_id)
          LEFT JOIN v_translation t USING (product_category_name)
          JOIN v_customers c ON c.customer_id = o.customer_id
          JOIN v_profile p ON p.customer_id = c.customer_unique_id JOIN v_sessions s ON s.order_id = o.order_id
          LEFT JOIN v_act a ON a.session_id = s.session_id""",
    "v_delivered": "SELECT * FROM v_eda WHERE order_status = 'delivered'",
    # --- delivered-orders pipeline
    "v_clean_orders": f"""
        SELECT o.order_id, o.order_status, c.customer_city, c.customer_state,
          coalesce(y.payment_value, 0) AS payment_value, coalesce(v.order_value, 0) AS order_value,
          CAST(floor(date_sub('microsecond', order_purchase_timestamp, order_delivered_customer_date) / 86400e6)
            AS BIGINT) AS delivery_days
        FROM v_shipped_first o LEFT JOIN v_customers c USING (customer_id)
          LEFT JOIN (SELECT order_id, CAST(sum({cents('payment_value')}) AS BIGINT) / 1e2 AS payment_value
            FROM v_payments GROUP BY 1) y USING (order_id)
          LEFT JOIN (SELECT order_id, CAST(sum({cents('price')}) AS BIGINT) / 1e2 AS order_value
            FROM v_items1 GROUP BY 1) v USING (order_id)
        WHERE o.order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
          AND floor(date_sub('microsecond', order_purchase_timestamp, order_delivered_customer_date) / 86400e6)
            BETWEEN 0 AND 60""",
    "v_clean_sessions": """
        SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(session_id AS VARCHAR) AS session_id)
        FROM v_behavior WHERE cart_additions >= 1 AND session_duration_seconds BETWEEN 10 AND 3600
          AND pages_viewed BETWEEN 1 AND 80""",
    "v_final_raw": """
        SELECT s.*, coalesce(o.order_value, 0) AS order_value, coalesce(o.payment_value, 0) AS payment_value,
          o.customer_city, o.customer_state, o.order_status, CAST(o.delivery_days AS DOUBLE) AS raw_days
        FROM v_clean_sessions s LEFT JOIN v_clean_orders o ON CAST(o.order_id AS VARCHAR) = s.order_id""",
    "v_final": """
        SELECT * EXCLUDE (raw_days), coalesce(raw_days, (SELECT median(raw_days) FROM v_final_raw)) AS delivery_days
        FROM v_final_raw""",
    # --- formula predictions: the customer's mean value (p) and mean log value (pl)
    "v_pred": f"""
        SELECT v.order_id, o.order_purchase_timestamp, o.customer_id, v.order_value AS y,
          CAST(sum({cents('v.order_value')}) OVER (PARTITION BY o.customer_id) AS BIGINT)
            / count(*) OVER (PARTITION BY o.customer_id) / 1e2 AS p
        FROM v_kept_value v JOIN v_kept o USING (order_id)""",
    "v_pred_log": "SELECT *, ln(1 + y) AS yl, avg(ln(1 + y)) OVER (PARTITION BY customer_id) AS pl FROM v_pred",
    "v_ape": """
        SELECT *, exp(yl) - 1 AS ye, exp(pl) - 1 AS pe,
          abs(exp(yl) - exp(pl)) / greatest(abs(exp(yl) - 1), 1) * 100 AS ape,
          CASE WHEN order_purchase_timestamp < TIMESTAMP '1999-06-01' THEN 'reference' ELSE 'current' END AS period
        FROM v_pred_log""",
}

_NAME = re.compile(r"\bv_\w+\b")


def _needed(text: str, found: dict[str, None]) -> None:
    for name in _NAME.findall(text):
        if name in VIEWS and name not in found:
            _needed(VIEWS[name], found)
            found[name] = None


def sql(text: str) -> str:
    found: dict[str, None] = {}
    _needed(text, found)
    if not found:
        return text.strip()
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in found)
    body = text.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
