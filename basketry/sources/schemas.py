"""Explicit schemas: no reader here infers types from data."""

from pyspark.sql import types as T

_S, _L, _D, _I, _B = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.BooleanType()
_TS = T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Commerce tables in their raw (CSV) form.
RAW_TABLES = {
    "orders": _struct(
        order_id=_S, customer_id=_S, order_status=_S, order_purchase_timestamp=_TS,
        order_approved_at=_TS, order_delivered_carrier_date=_TS,
        order_delivered_customer_date=_TS, order_estimated_delivery_date=_TS),
    "items": _struct(
        order_id=_S, order_item_id=_I, product_id=_S, seller_id=_S, shipping_limit_date=_TS,
        price=_D, freight_value=_D),
    "customers": _struct(
        customer_id=_S, customer_unique_id=_S, customer_zip_code_prefix=_I, customer_city=_S,
        customer_state=_S),
    "products": _struct(product_id=_S, product_category_name=_S),
    "sellers": _struct(seller_id=_S, seller_zip_code_prefix=_I, seller_state=_S),
    "geolocation": _struct(
        geolocation_zip_code_prefix=_I, geolocation_lat=_D, geolocation_lng=_D,
        geolocation_city=_S, geolocation_state=_S),
    "payments": _struct(
        order_id=_S, payment_sequential=_I, payment_type=_S, payment_installments=_I,
        payment_value=_D),
    "reviews": _struct(order_id=_S, review_score=_I),
    "category_translation": _struct(product_category_name=_S, product_category_name_english=_S),
    "behavioral_sessions": _struct(
        order_id=_S, session_id=_S, device_type=_S, referral_channel=_S,
        session_duration_seconds=_I, pages_viewed=_I, cart_additions=_I, coupon_applied=_I,
        discount_amount_pct=_I),
}

# Behavioural tables in their stored (parquet) form.
BEHAVIOUR_TABLES = {
    "customer_profile": _struct(
        customer_id=_S, gender=_S, birth_date=_TS, marital_status=_S, occupation=_S,
        education_level=_S, monthly_income=_D, household_size=_L, loyalty_tier=_S,
        registration_channel=_S, is_marketing_opt_in=_B, preferred_device=_S, created_at=_TS,
        updated_at=_TS),
    "sessions": _struct(
        session_id=_S, customer_id=_S, order_id=_S, session_start=_TS, session_end=_TS,
        device_type=_S, browser=_S, operating_system=_S, traffic_source=_S, traffic_medium=_S,
        campaign_name=_S, landing_page=_S, ip_country=_S, ip_region=_S, is_logged_in=_B,
        coupon_applied=_B, discount_amount_pct=_D, created_at=_TS),
    "session_activity": _struct(
        activity_id=_S, session_id=_S, customer_id=_S, order_id=_S, activity_timestamp=_TS,
        activity_type=_S, page_url=_S, product_id=_S, search_keyword=_S, duration_seconds=_L,
        scroll_percent=_L, add_to_cart_quantity=_L, created_at=_TS),
}

# The star-schema test tables.
STAR_TABLES = {
    "region": _struct(r_regionkey=_I, r_name=_S),
    "nation": _struct(n_nationkey=_I, n_name=_S, n_regionkey=_I),
    "customer": _struct(c_custkey=_L, c_name=_S, c_nationkey=_I, c_acctbal=_D, c_mktsegment=_S),
    "supplier": _struct(s_suppkey=_L, s_name=_S, s_nationkey=_I, s_acctbal=_D),
    "part": _struct(p_partkey=_L, p_name=_S, p_brand=_S, p_type=_S, p_size=_I, p_retailprice=_D),
    "orders": _struct(
        o_orderkey=_L, o_custkey=_L, o_orderstatus=_S, o_totalprice=_D, o_orderdate=_TS,
        o_orderpriority=_S),
    "lineitem": _struct(
        l_orderkey=_L, l_partkey=_L, l_suppkey=_L, l_linenumber=_I, l_quantity=_D,
        l_extendedprice=_D, l_discount=_D, l_tax=_D, l_returnflag=_S, l_linestatus=_S,
        l_shipdate=_TS),
    "events": _struct(event_id=_L, ts=_TS, user_id=_L, event_type=_S, value=_D, props=_S),
}
