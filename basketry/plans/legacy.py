"""The delivered-orders pipeline: price-only value joined to browsing sessions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.functions.numeric import finite_or_zero, money_total, right_closed_bins, safe_divide
from basketry.functions.temporal import whole_days
from basketry.operators.quantile import attach_row, column_quantiles

MAX_DELIVERY_DAYS = 60


def clean_orders(orders: DataFrame, customers: DataFrame, payments: DataFrame,
                 items: DataFrame) -> DataFrame:
    """Delivered orders with value, payment total and whole delivery days in 0..60."""
    delivered = (orders.where(F.col("order_status") == fv.DELIVERED)
                 .na.drop(subset=["order_purchase_timestamp", "order_delivered_customer_date"])
                 .withColumn("delivery_days", whole_days("order_purchase_timestamp",
                                                         "order_delivered_customer_date"))
                 .where(F.col("delivery_days").between(0, MAX_DELIVERY_DAYS)))
    places = customers.select("customer_id", "customer_city", "customer_state")
    paid = payments.groupBy("order_id").agg(money_total("payment_value").alias("payment_value"))
    value = items.groupBy("order_id").agg(money_total("price").alias("order_value"))
    return (delivered.join(paid, "order_id", "left").join(value, "order_id", "left")
            .join(places, "customer_id", "left").na.fill(0.0, ["order_value", "payment_value"]))


def clean_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions with a cart, 10 s to 1 h long, over 1 to 80 pages."""
    return sessions.where(
        (F.col("cart_additions") >= 1) & F.col("session_duration_seconds").between(10, 3600)
        & F.col("pages_viewed").between(1, 80)).withColumns(
        {c: F.col(c).cast("string") for c in ("order_id", "session_id")})


def engagement_flags(df: DataFrame) -> DataFrame:
    """1 where both duration and pages lie strictly above their medians."""
    cuts = column_quantiles(df, ["session_duration_seconds", "pages_viewed"], [0.5], [""])
    return attach_row(df, cuts, "__cut").withColumn(
        "is_high_engagement", _both_above("__cut")).drop("__cut")


def _both_above(cut: str) -> Column:
    longer = F.col("session_duration_seconds") > F.col(f"{cut}.session_duration_seconds")
    wider = F.col("pages_viewed") > F.col(f"{cut}.pages_viewed")
    return (longer & wider).cast("int")


def final_dataset(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """Cleaned sessions with the facts of their cleaned order; missing facts are filled."""
    wanted = orders.select(F.col("order_id").cast("string").alias("order_id"), "order_value",
                           "payment_value", "customer_city", "customer_state", "order_status",
                           "delivery_days")
    df = sessions.join(wanted, "order_id", "left").na.fill(0.0, ["order_value", "payment_value"])
    cuts = column_quantiles(
        df, ["delivery_days", "session_duration_seconds", "pages_viewed"], [0.5], [""])
    return attach_row(df, cuts, "__cut").withColumns({
        "delivery_days": F.coalesce(F.col("delivery_days").cast("double"), F.col("__cut.delivery_days")),
        "log_order_value": F.log1p("order_value"),
        "avg_time_per_page": safe_divide("session_duration_seconds", "pages_viewed"),
        "cart_per_page": safe_divide("cart_additions", "pages_viewed"),
        "is_high_engagement": _both_above("__cut"),
        "has_coupon": F.col("coupon_applied").cast("int"),
    }).drop("__cut")


# --- features ---------------------------------------------------------------

def fit_thresholds(df: DataFrame) -> DataFrame:
    """Upper-quartile cuts of duration and pages, as one row that can be saved."""
    return column_quantiles(df, ["session_duration_seconds", "pages_viewed"], [0.75], [""])


def ratio_features() -> dict[str, Column]:
    pairs = {
        "cart_efficiency": ("cart_additions", "session_duration_seconds"),
        "session_intensity": ("pages_viewed", "session_duration_seconds"),
        "add_to_cart_ratio": ("cart_additions", "pages_viewed"),
        "pages_per_cart": ("pages_viewed", "cart_additions"),
        "duration_per_cart": ("session_duration_seconds", "cart_additions"),
        "discount_per_page": ("discount_amount_pct", "pages_viewed"),
    }
    return {name: safe_divide(top, bottom) for name, (top, bottom) in pairs.items()}


def score_features(columns: list[str]) -> dict[str, Column]:
    """Weighted engagement, interactions, discount flag and estimated discount value."""
    seconds, pages = F.col("session_duration_seconds"), F.col("pages_viewed")
    carts, percent = F.col("cart_additions"), F.col("discount_amount_pct")
    engagement = seconds * 0.4 + pages * 0.6
    saved = F.col("order_value") * percent / 100 if "order_value" in columns else F.lit(0.0)
    return {
        "engagement_score": engagement,
        "estimated_discount_value": saved,
        "has_high_discount": (percent >= 15).cast("int"),
        "duration_x_cart": seconds * carts,
        "pages_x_discount": pages * percent,
        "cart_x_discount": carts * percent,
        "engagement_x_discount": engagement * percent,
        "cart_abandon_score": pages - carts,
    }


def bin_features() -> dict[str, Column]:
    """Right-closed labels; a value on or below the lowest edge reads 'nan'."""
    return {
        "delivery_speed": right_closed_bins(
            "delivery_days", [0, 3, 7, 14, math.inf], ["fast", "normal", "slow", "very_slow"]),
        "discount_level": right_closed_bins(
            "discount_amount_pct", [-1, 0, 5, 15, 100], ["none", "low", "medium", "high"]),
    }


def transform(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """All session features; nulls and infinities in numbers end as 0."""
    added = {**ratio_features(), **score_features(df.columns), **bin_features(),
             "is_high_value_session": _both_above("__cut")}
    out = attach_row(df, thresholds, "__cut").withColumns(added).drop("__cut")
    floats = [f.name for f in out.schema if f.dataType.typeName() == "double"]
    whole = [f.name for f in out.schema if f.dataType.typeName() in ("integer", "long")]
    texts = [f.name for f in out.schema if f.dataType.typeName() == "string"]
    return (out.withColumns({c: finite_or_zero(c) for c in floats})
            .na.fill(0, whole).na.fill("0", texts))
