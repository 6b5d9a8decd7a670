"""Data contract checks as rows (check, passed, observed)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.operators.quantile import attach_row, median
from basketry.plans import facts

INCOME_RANGE = (500, 50000)
HOUSEHOLD_RANGE = (1, 10)
CORRELATION_RANGE = (0.2, 0.6)
MIN_EVENTS = 3
MIN_SHARE = 0.3


def _nulls(*columns: str) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNull().cast("int")
    return F.coalesce(F.sum(total), F.lit(0))


def _outside(column: str, bounds: tuple[float, float]) -> Column:
    """Rows outside the inclusive range; a null counts as outside."""
    return F.count_if(~F.coalesce(F.col(column).between(*bounds), F.lit(False)))


def align_cart(sessions: DataFrame, activity: DataFrame, item_counts: DataFrame) -> DataFrame:
    """Cart quantity and ordered items per session; no events is 0, no items is 1."""
    carts = activity.groupBy("session_id").agg(F.sum("add_to_cart_quantity").alias("cart_qty"))
    return (sessions.select("session_id", "order_id")
            .join(item_counts.select("order_id", "item_count"), "order_id", "left")
            .join(carts, "session_id", "left")
            .select("session_id", F.coalesce("cart_qty", F.lit(0)).alias("cart_qty"),
                    F.coalesce("item_count", F.lit(1)).alias("item_count")))


def events_outside(activity: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events before the start or after the end (both inclusive) of their session."""
    bounds = sessions.select("session_id", "session_start", "session_end")
    at = F.col("activity_timestamp")
    return (activity.select("activity_id", "session_id", "activity_timestamp")
            .join(bounds, "session_id")
            .where((at < F.col("session_start")) | (at > F.col("session_end")))
            .select("activity_id", "session_id",
                    (at < F.col("session_start")).cast("int").alias("is_before"),
                    (at > F.col("session_end")).cast("int").alias("is_after")))


def person_value(values: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Mean order value per person."""
    return (values.join(orders.select("order_id", "customer_id"), "order_id")
            .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
            .groupBy("customer_unique_id").agg(F.avg("order_value").alias("avg_value")))


def _levels(table: DataFrame, key: str, names: Sequence[str], value: str) -> DataFrame:
    """One row: the median of ``value`` at each named level, 0 where a level is absent."""
    found = median(table, [key], value, "m")
    return found.agg(*[F.coalesce(F.max(F.when(F.col(key) == name, F.col("m"))), F.lit(0.0)).alias(name)
                       for name in names])


def validate(t: Mapping[str, DataFrame]) -> DataFrame:
    """All contract checks over profile, sessions, activity, orders, customers and items."""
    values = facts.order_value(t["items"])
    people = person_value(values, t["orders"], t["customers"])
    profiles = t["profile"].join(people, F.col("customer_id") == F.col("customer_unique_id"))
    per_session = t["session_activity"].groupBy("session_id").agg(
        F.count("*").alias("n"), F.max((F.col("activity_type") == "checkout").cast("int")).alias("out"),
        F.max((F.col("activity_type") == "add_to_cart").cast("int")).alias("cart"))
    carts = align_cart(t["sessions"], t["session_activity"], values)
    device = (t["sessions"].select("order_id", "device_type")
              .join(values.select("order_id", "order_value"), "order_id"))
    parts = {
        "sessions": t["sessions"].agg(
            F.count("*").alias("n"),
            _nulls("session_id", "customer_id", "order_id", "session_start").alias("nulls")),
        "activity": t["session_activity"].agg(
            F.count("*").alias("n"),
            _nulls("activity_id", "session_id", "activity_timestamp").alias("nulls")),
        "customers": t["customers"].agg(F.countDistinct("customer_unique_id").alias("n")),
        "orders": t["orders"].agg(F.count("*").alias("n")),
        "events": per_session.agg(F.min("n").alias("least"), F.count_if(F.col("out") == 0).alias("no_out"),
                                  F.count_if(F.col("cart") == 0).alias("no_cart")),
        "carts": carts.agg(F.count_if(F.col("cart_qty") < F.col("item_count")).alias("short")),
        "times": events_outside(t["session_activity"], t["sessions"]).agg(F.count("*").alias("n")),
        "income": profiles.agg(F.corr("monthly_income", "avg_value").alias("r")),
        "tiers": _levels(profiles, "loyalty_tier", fv.LOYALTY_TIERS, "avg_value"),
        "devices": _levels(device, "device_type", fv.DEVICES, "order_value"),
    }
    row = t["profile"].agg(
        F.count("*").alias("n"), _nulls("customer_id").alias("nulls"),
        _outside("monthly_income", INCOME_RANGE).alias("income"),
        _outside("household_size", HOUSEHOLD_RANGE).alias("household"))
    row = row.select(F.struct(*row.columns).alias("profile"))
    for name, part in parts.items():
        row = attach_row(row, part, name)

    def at(path: str) -> Column:
        return F.col(path)
    tiers = [at(f"tiers.{name}") for name in fv.LOYALTY_TIERS]
    falls = sum(((low > high).cast("int") for low, high in zip(tiers, tiers[1:])), F.lit(0))
    nulls = at("profile.nulls") + at("sessions.nulls") + at("activity.nulls")
    checks = [
        ("profile rows", at("profile.n") > 0, at("profile.n")),
        ("session rows", at("sessions.n") > 0, at("sessions.n")),
        ("activity rows", at("activity.n") > 0, at("activity.n")),
        ("one profile per person", at("profile.n") == at("customers.n"), at("profile.n") - at("customers.n")),
        ("one session per order", at("sessions.n") == at("orders.n"), at("sessions.n") - at("orders.n")),
        ("events per session", at("events.least") >= MIN_EVENTS, at("events.least")),
        ("no nulls in required columns", nulls == 0, nulls),
        ("cart covers items", at("carts.short") == 0, at("carts.short")),
        ("checkout in every session", at("events.no_out") == 0, at("events.no_out")),
        ("add_to_cart in every session", at("events.no_cart") == 0, at("events.no_cart")),
        ("events inside session", at("times.n") == 0, at("times.n")),
        ("income follows value", at("income.r").between(*CORRELATION_RANGE), at("income.r")),
        ("value rises with tier", falls == 0, falls),
        ("desktop above mobile", at("devices.desktop") > at("devices.mobile"),
         at("devices.desktop") - at("devices.mobile")),
        ("income in range", at("profile.income") == 0, at("profile.income")),
        ("household in range", at("profile.household") == 0, at("profile.household")),
    ]
    return row.select(F.inline(_check_rows(checks)))


def _check_rows(checks: Sequence[tuple[str, Column, Column]]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"),
                              observed.cast("double").alias("observed")) for name, passed, observed in checks])


def _failing(good: Column) -> Column:
    """Rows that fail a condition; a null fails it."""
    return F.count_if(~F.coalesce(good, F.lit(False)))


def domain_checks(t: Mapping[str, DataFrame]) -> DataFrame:
    """Value sets, session order, quantities, keys, events, spread and gender shares. Null fails a check."""
    profile = t["profile"].agg(
        _failing(F.col("loyalty_tier").isin(*fv.LOYALTY_TIERS)).alias("bad_tier"),
        F.stddev_samp("monthly_income").alias("spread"),
        *[(F.count_if(F.col("gender") == g) / F.count("gender")).alias(g) for g in ("male", "female")])
    row = profile.select(F.struct(*profile.columns).alias("profile"))
    row = attach_row(row, t["sessions"].agg(
        _failing(F.col("device_type").isin(*fv.DEVICES)).alias("bad_device"),
        _failing(F.col("session_end") >= F.col("session_start")).alias("reversed"),
        _nulls("session_id", "order_id").alias("no_key")), "sessions")
    row = attach_row(row, t["session_activity"].agg(
        _failing(F.col("add_to_cart_quantity") >= 0).alias("negative")), "activity")
    per_session = t["session_activity"].groupBy("session_id").agg(F.count("*").alias("n"))
    row = attach_row(row, per_session.agg(F.min("n").alias("least")), "events")
    row = attach_row(row, _levels(t["profile"], "loyalty_tier", fv.LOYALTY_TIERS, "monthly_income"), "tiers")
    gap = F.col("tiers.platinum") - F.col("tiers.bronze")
    checks = [
        ("tiers valid", F.col("profile.bad_tier") == 0, F.col("profile.bad_tier")),
        ("devices valid", F.col("sessions.bad_device") == 0, F.col("sessions.bad_device")),
        ("sessions end after start", F.col("sessions.reversed") == 0, F.col("sessions.reversed")),
        ("cart quantity not negative", F.col("activity.negative") == 0, F.col("activity.negative")),
        ("session keys not null", F.col("sessions.no_key") == 0, F.col("sessions.no_key")),
        ("enough events per session", F.col("events.least") >= MIN_EVENTS, F.col("events.least")),
        ("income varies", F.col("profile.spread") > 0, F.col("profile.spread")),
        ("male share", F.col("profile.male") > MIN_SHARE, F.col("profile.male")),
        ("female share", F.col("profile.female") > MIN_SHARE, F.col("profile.female")),
        ("top tier earns more than bottom", gap > 0, gap),
    ]
    return row.select(F.inline(_check_rows(checks)))


def all_passed(report: DataFrame) -> bool:
    """For job exit codes."""
    return report.where(~F.col("passed")).isEmpty()
