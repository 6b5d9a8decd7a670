"""Adapter views: the star-schema test tables under the commerce column names.

Each view is one projection (plus a join where a name lives in another table),
so Catalyst prunes columns and pushes filters through it into the scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.ordered import first_per_key, lag_in_key, running_total
from basketry.sources.schemas import STAR_TABLES

# Person ids differ from account ids by this offset.
PERSON_OFFSET = 1_000_000
SESSION_GAP_SECONDS = 12 * 3600


def _cents(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("long")


def _share(amount: Column, percent: Column) -> Column:
    """``percent`` of an amount in cents, rounded half up, back in currency."""
    return F.floor((amount * percent + 50) / 100) / 100.0


def _pick(index: Column, *labels: str) -> Column:
    return F.element_at(F.array(*map(F.lit, labels)), (index % len(labels) + 1).cast("int"))


def _after(start: Column, seconds: Column) -> Column:
    return start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


class StarTables:
    """Lazy commerce tables over one folder of star-schema parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        key, day = F.col("o_orderkey"), F.col("o_orderdate")
        bought = _after(day, key * 7919 % 86400)
        return self.raw("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "O", "delivered")
             .when(F.col("o_orderstatus") == "F", "shipped")
             .otherwise("canceled").alias("order_status"),
            bought.alias("order_purchase_timestamp"),
            F.when(key % 10 != 0, bought).alias("order_approved_at"),
            _after(day, F.lit(20 * 86400)).alias("order_estimated_delivery_date"))

    @cached_property
    def items(self) -> DataFrame:
        """Order lines as they arrive: the compound key repeats."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").alias("price"),
            _share(_cents("l_extendedprice"), _cents("l_tax")).alias("freight_value"),
            F.col("l_shipdate").alias("shipping_limit_date"))

    @cached_property
    def lines(self) -> DataFrame:
        """One line per (order, line number): the smallest by all other columns.

        The ship date sorts last and no view shows it, so it need not move. An order's lines lie side by side.
        """
        return first_per_key(
            self.raw("lineitem").drop("l_shipdate"), ["l_orderkey", "l_linenumber"],
            ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"], numbered="l_linenumber")

    @cached_property
    def customers(self) -> DataFrame:
        zip_prefix = (F.col("c_custkey") % 220).cast("int")
        return (self.raw("customer")
                .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").alias("customer_id"),
                        (F.col("c_custkey") + PERSON_OFFSET).alias("customer_unique_id"),
                        zip_prefix.alias("customer_zip_code_prefix"),
                        F.concat(F.lit("city_"), zip_prefix).alias("customer_city"),
                        F.col("n_name").alias("customer_state")))

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_partkey") % 50 != 0, F.col("p_type")).alias("product_category_name"))

    @cached_property
    def category_translation(self) -> DataFrame:
        """Every part type but STANDARD has a translation."""
        kind = F.col("p_type")
        return (self.raw("part").where(kind != "STANDARD").select(kind).distinct()
                .select(kind.alias("product_category_name"),
                        F.lower(kind).alias("product_category_name_english")))

    @cached_property
    def sellers(self) -> DataFrame:
        return (self.raw("supplier")
                .join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                .select(F.col("s_suppkey").alias("seller_id"),
                        (F.col("s_suppkey") * 7 % 230).cast("int").alias("seller_zip_code_prefix"),
                        F.col("n_name").alias("seller_state")))

    @cached_property
    def geolocation(self) -> DataFrame:
        """One position per order; zip prefixes 200 and up have none."""
        key = F.col("o_orderkey")
        zip_prefix = (F.col("o_custkey") % 200).cast("int")
        city = (F.when(key % 5 == 0, "Sao Paulo").when(key % 5 == 1, "Campinas")
                .when(key % 5 == 2, "RECIFE").when(key % 5 == 3, "ouro preto")
                .otherwise(F.concat(F.lit("city_"), zip_prefix)))
        return self.raw("orders").select(
            zip_prefix.alias("geolocation_zip_code_prefix"),
            (key * 7 % 300 / 10.0 - 30).alias("geolocation_lat"),
            (key * 11 % 250 / 10.0 - 60).alias("geolocation_lng"),
            city.alias("geolocation_city"),
            F.concat(F.lit("ST_"), zip_prefix % 27).alias("geolocation_state"))

    @cached_property
    def payments(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.lines.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("payment_sequential"),
            F.when(flag == "A", "credit_card").when(flag == "N", "boleto")
             .otherwise("voucher").alias("payment_type"),
            F.col("l_quantity").cast("int").alias("payment_installments"),
            _share(_cents("l_extendedprice"), 100 - _cents("l_discount")).alias("payment_value"))

    @cached_property
    def reviews(self) -> DataFrame:
        """One score per line; lines flagged N carry none."""
        return self.lines.select(
            F.col("l_orderkey").alias("order_id"),
            F.when(F.col("l_returnflag") != "N",
                   F.col("l_quantity").cast("int") % 5 + 1).alias("review_score"))

    @cached_property
    def profile(self) -> DataFrame:
        key = F.col("c_custkey")
        epoch = F.lit("2016-01-01").cast("timestamp_ntz")
        created = _after(epoch, key % 800 * 86400)
        return self.raw("customer").select(
            (key + PERSON_OFFSET).alias("customer_id"),
            _pick(key, "male", "female", "other").alias("gender"),
            _after(F.lit("1950-01-01").cast("timestamp_ntz"),
                   key * 37 % 19000 * 86400).alias("birth_date"),
            _pick(F.floor(key / 3), "single", "married", "divorced", "widowed").alias("marital_status"),
            _pick(F.floor(key / 2), "professional", "student", "self_employed", "retired",
                  "unemployed", "homemaker", "other").alias("occupation"),
            _pick(F.floor(key / 5), "high_school", "bachelor", "master", "phd",
                  "none").alias("education_level"),
            F.greatest(F.lit(500.0), F.col("c_acctbal")).alias("monthly_income"),
            (key % 10 + 1).alias("household_size"),
            _pick(key, "bronze", "silver", "gold", "platinum").alias("loyalty_tier"),
            _pick(key, "organic", "paid_ads", "referral", "social",
                  "email").alias("registration_channel"),
            (key % 2 == 0).alias("is_marketing_opt_in"),
            _pick(key, "mobile", "desktop", "tablet").alias("preferred_device"),
            created.alias("created_at"),
            _after(created, key % 180 * 86400).alias("updated_at"))

    @cached_property
    def sessions(self) -> DataFrame:
        """One checkout session per order, ending some time after it starts."""
        key = F.col("o_orderkey")
        bought = _after(F.col("o_orderdate"), key * 7919 % 86400)
        start = _after(bought, -(key * 13 % 10500 + 300))
        medium = _pick(F.floor(key / 5), "organic", "cpc", "direct", "social", "email")
        campaign = _pick(F.floor(key / 7), "summer_sale", "black_friday", "christmas",
                         "free_shipping", "flash_deal")
        coupon = key % 4 == 0
        return self.raw("orders").select(
            key.alias("session_id"), (F.col("o_custkey") + PERSON_OFFSET).alias("customer_id"),
            key.alias("order_id"), start.alias("session_start"),
            _after(start, key * 17 % 3590 + 10).alias("session_end"),
            _pick(key, "mobile", "desktop", "tablet").alias("device_type"),
            _pick(F.floor(key / 2), "chrome", "safari", "firefox", "edge", "other").alias("browser"),
            _pick(F.floor(key / 4), "android", "windows", "ios", "macos",
                  "linux").alias("operating_system"),
            _pick(F.floor(key / 3), "google", "direct", "facebook", "instagram",
                  "email").alias("traffic_source"),
            medium.alias("traffic_medium"),
            F.when(~medium.isin("organic", "direct"), campaign).alias("campaign_name"),
            _pick(key, "/", "/category", "/product", "/search").alias("landing_page"),
            F.when(key % 50 == 0, "US").otherwise("BR").alias("ip_country"),
            F.concat(F.lit("R"), F.col("o_custkey") % 27).alias("ip_region"),
            (key % 10 < 7).alias("is_logged_in"), coupon.alias("coupon_applied"),
            F.when(coupon, (key % 21 + 5).cast("double")).otherwise(0.0).alias("discount_amount_pct"),
            start.alias("created_at"))

    @cached_property
    def session_items(self) -> DataFrame:
        """One session event per order line; joins ``sessions`` on session_id."""
        flag, done, qty = F.col("l_returnflag"), F.col("l_linestatus") == "F", F.col("l_quantity").cast("int")
        kind = (F.when(flag == "A", "add_to_cart")
                .when((flag == "R") & done, "product_view").when(flag == "R", "search")
                .when(done, "page_view").otherwise("checkout"))
        return self.lines.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("activity_id"),
            F.col("l_orderkey").alias("session_id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("event_no"), kind.alias("activity_type"),
            F.col("l_partkey").alias("product_id"),
            (qty * 7 % 600).alias("duration_seconds"), (qty * 2 % 101).alias("scroll_percent"),
            F.when(flag == "A", qty % 5 + 1).otherwise(0).alias("add_to_cart_quantity"))

    @cached_property
    def timed_session_items(self) -> DataFrame:
        """Session events with a time: 97 s per line number after the session start."""
        starts = self.sessions.select("session_id", "session_start")
        return (self.session_items.join(starts, "session_id")
                .withColumn("activity_timestamp", _after(F.col("session_start"), F.col("event_no") * 97))
                .drop("session_start"))

    @cached_property
    def session_activity(self) -> DataFrame:
        """Clickstream events, cut into sessions where a user pauses for 12 hours."""
        k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
        kind = F.col("event_type")
        events = self.raw("events").select(
            F.col("event_id").alias("activity_id"), F.col("user_id").alias("customer_id"),
            F.col("ts").alias("activity_timestamp"),
            F.when(kind == "click", "page_view").when(kind == "signup", "search")
             .when(kind == "view", "product_view").when(kind == "error", "add_to_cart")
             .otherwise("checkout").alias("activity_type"),
            F.floor("value").cast("int").alias("duration_seconds"), k.alias("scroll_percent"),
            F.when(kind == "error", k % 5 + 1).otherwise(0).alias("add_to_cart_quantity"))
        order = ["activity_timestamp", "activity_id"]
        seen = lag_in_key(events, "customer_id", order, "activity_timestamp", "previous_at")
        gap = F.timestamp_diff("SECOND", F.col("previous_at"), F.col("activity_timestamp"))
        opens = (F.col("previous_at").isNull() | (gap > SESSION_GAP_SECONDS)).cast("long")
        numbered = running_total(seen.withColumn("opens", opens), "customer_id", order, "opens",
                                 "session_no")
        return numbered.withColumn(
            "session_id", F.col("customer_id") * 100_000 + F.col("session_no")
        ).drop("previous_at", "opens", "session_no")

    @cached_property
    def event_sessions(self) -> DataFrame:
        return self.session_activity.groupBy("session_id").agg(
            F.first("customer_id").alias("customer_id"),
            F.min("activity_timestamp").alias("session_start"),
            F.max("activity_timestamp").alias("session_end"))

    @cached_property
    def behavioral_sessions(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            key.alias("order_id"), key.alias("session_id"),
            _pick(key, "mobile", "desktop", "tablet").alias("device_type"),
            _pick(F.floor(key / 3), "search_organic", "direct", "search_paid", "social",
                  "email").alias("referral_channel"),
            (key * 31 % 4000).alias("session_duration_seconds"), (key * 7 % 90).alias("pages_viewed"),
            (key % 5).alias("cart_additions"), (key % 4 == 0).cast("int").alias("coupon_applied"),
            F.element_at(F.array(*map(F.lit, (0, 5, 10, 15, 20))),
                         (F.floor(key / 5) % 5 + 1).cast("int")).alias("discount_amount_pct"))

    @cached_property
    def delivered_orders(self) -> DataFrame:
        """Orders with a delivery date: the first ship date among their lines."""
        first_ship = self.raw("lineitem").groupBy("l_orderkey").agg(
            F.min("l_shipdate").alias("order_delivered_customer_date"))
        return (self.orders.join(first_ship, F.col("order_id") == F.col("l_orderkey"), "left")
                .drop("l_orderkey"))
