"""Fact tables: one function per aggregate or per-entity table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.functions.labels import urban_flag
from basketry.functions.numeric import money_mean, money_total
from basketry.functions.temporal import calendar, whole_days
from basketry.operators.asof import first_seen, totals_before
from basketry.operators.ordered import first_per_key, order_history
from basketry.operators.quantile import median, quantiles, scalars, unpivot
from basketry.session import cut_lineage


# --- cleaning -------------------------------------------------------------

def dedup_orders(orders: DataFrame, copies: str | None = None) -> DataFrame:
    return first_per_key(orders, ["order_id"],
                         ["order_purchase_timestamp", "customer_id", "order_status"], copies)


def dedup_items(items: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per line; the lines of an order come out side by side. The shipping limit may be left out."""
    order = ["product_id", "seller_id", "price", "freight_value", "shipping_limit_date"]
    return first_per_key(items, ["order_id", "order_item_id"], [c for c in order if c in items.columns], copies,
                         numbered="order_item_id")


def kept_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status").isin(*fv.KEPT_STATUSES))


def with_approval(orders: DataFrame) -> DataFrame:
    """Missing approval times take the purchase time."""
    return orders.withColumn(
        "order_approved_at", F.coalesce("order_approved_at", "order_purchase_timestamp"))


def translated_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with an English category; unknown where either step has none."""
    category = F.coalesce("product_category_name", F.lit(fv.UNKNOWN))
    named = products.withColumn("product_category_name", category)
    english = translation.select(
        "product_category_name", F.col("product_category_name_english").alias("__english"))
    return (named.join(english, "product_category_name", "left")
            .withColumn("product_category_name_english", F.coalesce("__english", F.lit(fv.UNKNOWN)))
            .drop("__english"))


# --- order and customer value ----------------------------------------------

def order_value(items: DataFrame, with_mean: bool = False) -> DataFrame:
    """Price plus freight, freight, and line count per order."""
    price, freight = money_total("price"), money_total("freight_value")
    total = F.round((price + freight) * 100) / 100.0
    measures = [total.alias("order_value"), freight.alias("freight_value"),
                F.count("*").alias("item_count")]
    if with_mean:
        measures.append(money_mean("price").alias("avg_item_price"))
    return items.groupBy("order_id").agg(*measures)


def valued_orders(values: DataFrame, orders: DataFrame) -> DataFrame:
    """Positive order values of the given orders only."""
    return values.where(F.col("order_value") > 0).join(
        orders.select("order_id"), "order_id", "left_semi")


def order_value_legacy(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Price-only value and payment total per order, for orders with either."""
    price = items.groupBy("order_id").agg(money_total("price").alias("order_value"))
    paid = payments.groupBy("order_id").agg(money_total("payment_value").alias("payment_value"))
    return price.join(paid, "order_id", "left")


def customer_value(values: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Mean value, order count and mean items of each person's delivered orders."""
    delivered = orders.where(F.col("order_status") == fv.DELIVERED).select("order_id", "customer_id")
    people = customers.select("customer_id", "customer_unique_id")
    return (values.join(delivered, "order_id").join(people, "customer_id")
            .groupBy("customer_unique_id")
            .agg(money_mean("order_value").alias("avg_value"),
                 F.count("*").alias("order_count"),
                 (F.sum("item_count") / F.count("*")).alias("avg_items")))


# --- places -----------------------------------------------------------------

def geo_centroid(geolocation: DataFrame) -> DataFrame:
    """Median position and first city and state per zip prefix."""
    zip_prefix = "geolocation_zip_code_prefix"
    first = F.min(F.struct("geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"))
    names = [F.col("row.geolocation_city").alias("geo_city"),
             F.col("row.geolocation_state").alias("geo_state")]
    rows = geolocation.where(F.col(zip_prefix).isNotNull())
    long = unpivot(rows, ["geolocation_lat", "geolocation_lng"], [zip_prefix])
    middle = median(long, [zip_prefix, "feature"], "value", "m").groupBy(zip_prefix).agg(*[
        F.max(F.when(F.col("feature") == f"geolocation_{axis}", F.col("m"))).alias(f"geo_{axis}") for axis in ("lat", "lng")])
    places = rows.groupBy(zip_prefix).agg(first.alias("row")).select(zip_prefix, *names)
    return places.join(middle, zip_prefix, "left")


def customer_places(customers: DataFrame, centroids: DataFrame) -> DataFrame:
    """Coordinates and the urban flag of each customer."""
    places = centroids.withColumnRenamed("geolocation_zip_code_prefix", "customer_zip_code_prefix")
    return (customers.join(places, "customer_zip_code_prefix", "left")
            .select("customer_id", "geo_lat", "geo_lng", urban_flag("geo_city").alias("customer_urban")))


# --- sellers and categories ---------------------------------------------------

def seller_stats(lines: DataFrame) -> DataFrame:
    """Distinct orders, mean price, lines and category breadth per seller.

    Sums fold in place. Distinct orders and distinct categories are two
    separate two-step aggregates joined on the seller, so no row is expanded
    and a hot seller spreads over its orders and categories.
    """
    cents = F.sum(F.round(F.col("price") * 100).cast("long"))
    sums = lines.groupBy("seller_id").agg(
        (cents / F.count("price") / 100.0).alias("seller_avg_price"), F.count("*").alias("seller_item_count"))
    orders = (lines.select("seller_id", "order_id").distinct().groupBy("seller_id")
              .agg(F.count("order_id").alias("seller_order_count")))
    volume = orders.join(sums, "seller_id")
    breadth = (lines.groupBy("seller_id", "product_category_name_english").agg(F.lit(1).alias("seen"))
               .groupBy("seller_id")
               .agg(F.count("product_category_name_english").alias("seller_n_categories")))
    return volume.join(breadth, "seller_id")


def seller_places(sellers: DataFrame, centroids: DataFrame) -> DataFrame:
    places = centroids.select(
        F.col("geolocation_zip_code_prefix").alias("seller_zip_code_prefix"),
        F.col("geo_lat").alias("seller_lat"), F.col("geo_lng").alias("seller_lng"))
    return (sellers.join(places, "seller_zip_code_prefix", "left")
            .select("seller_id", "seller_state", "seller_lat", "seller_lng"))


def primary_seller(items: DataFrame) -> DataFrame:
    """Seller of the first line of each order."""
    return items.groupBy("order_id").agg(
        F.min_by("seller_id", F.struct("order_item_id", "product_id", "seller_id")).alias("seller_id"))


def categorised_items(items: DataFrame, products: DataFrame) -> DataFrame:
    english = products.select("product_id", "product_category_name_english")
    return items.join(english, "product_id", "left")


def category_price_stats(lines: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Mean and sample deviation of price, and distinct orders, per category.

    Prices fold in place and only (category, order) pairs move: no row is expanded. With the lines' stored
    ``category_cells`` not even these move.
    """
    category = "product_category_name_english"
    known = lines.where(F.col(category).isNotNull())
    prices = known.groupBy(category).agg(
        money_mean("price").alias("cat_avg_price"),
        F.coalesce(F.stddev_samp("price"), F.lit(0.0)).alias("cat_std_price"))
    pairs = known.select(category, "order_id").distinct() if cells is None else cells.where(F.col(category).isNotNull())
    orders = pairs.groupBy(category).agg(F.count("order_id").alias("cat_order_count"))
    return prices.join(orders, category)


def seller_stats_as_of(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The seller statistics of each order, from lines of orders bought strictly before it.

    (order_id, seller_id, then as ``seller_stats``); the seller is that of the first line. A seller
    without earlier sales has counts of 0 and no mean price.
    """
    when = orders.select("order_id", "order_purchase_timestamp")
    timed = lines.join(when, "order_id")
    time = "order_purchase_timestamp"
    volume = timed.groupBy("seller_id", "order_id", time).agg(
        F.sum(F.round(F.col("price") * 100).cast("long")).alias("cents"), F.count("price").alias("priced"),
        F.count("*").alias("seller_item_count")).drop("order_id").withColumn("seller_order_count", F.lit(1).cast("long"))
    breadth = first_seen(timed, "seller_id", "product_category_name_english", time, "seller_n_categories")
    asked = primary_seller(lines).join(when, "order_id")
    known = totals_before(volume.unionByName(breadth, allowMissingColumns=True), asked, "seller_id", time,
                          ["seller_order_count", "cents", "priced", "seller_item_count", "seller_n_categories"])
    return known.select("order_id", "seller_id", "seller_order_count",
                        F.when(F.col("priced") > 0, F.col("cents") / F.col("priced") / 100.0).alias("seller_avg_price"),
                        "seller_item_count", "seller_n_categories")


def category_price_as_of(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The price statistics of each order's main category, from lines of orders bought strictly before it.

    (order_id, primary_category, then as ``category_price_stats``). A category without earlier sales has
    no mean price, deviation 0 and count 0. Sums are exact: cents, and their squares as decimals.
    """
    time = "order_purchase_timestamp"
    when = orders.select("order_id", time)
    cents = F.round(F.col("price") * 100).cast("long")
    sold = lines.where(F.col("product_category_name_english").isNotNull()).join(when, "order_id").groupBy(
        F.col("product_category_name_english").alias("primary_category"), "order_id", time).agg(
        F.sum(cents).alias("cents"), F.sum(cents.cast("decimal(19,0)") * cents).alias("squares"),
        F.count("price").alias("priced")).withColumn("cat_order_count", F.lit(1).cast("long"))
    asked = order_category(lines).select("order_id", "primary_category").join(when, "order_id")
    known = totals_before(sold, asked, "primary_category", time, ["cents", "squares", "priced", "cat_order_count"])
    n, total = F.col("priced").cast("decimal(19,0)"), F.col("cents").cast("decimal(19,0)")
    spread = (n * F.col("squares").cast("decimal(37,0)") - total * total).cast("double")
    return known.select(
        "order_id", "primary_category", F.when(F.col("priced") > 0, F.col("cents") / F.col("priced") / 100.0).alias("cat_avg_price"),
        F.when(F.col("priced") > 1, F.sqrt(spread / (F.col("priced") * (F.col("priced") - 1.0))) / 100.0)
        .otherwise(0.0).alias("cat_std_price"), "cat_order_count")


def order_facts(lines: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Value, line count, main category and primary seller per order.

    Sums fold where the lines lie, and for the categories only (order, category, count) moves: an order with
    very many lines never meets in one task. The main category is the most frequent one, the smallest on
    ties; the primary seller is that of the first line. Lines without an order are left out. With
    ``category_cells`` the lines need no category, so they may lie as the dedup left them.
    """
    price = F.coalesce(F.sum(F.round(F.col("price") * 100).cast("long")), F.lit(0))
    freight = F.coalesce(F.sum(F.round(F.col("freight_value") * 100).cast("long")), F.lit(0))
    first_line = F.min(F.struct("order_item_id", "seller_id"))  # one line of each number
    totals = lines.groupBy("order_id").agg(
        ((price + freight) / 100.0).alias("order_value"), (freight / 100.0).alias("freight_value"),
        F.count("*").alias("item_count"), first_line.getField("seller_id").alias("seller_id"))
    main = (category_cells(lines) if cells is None else cells).groupBy("order_id").agg(*_main_category())
    return totals.join(main, "order_id").select(
        "order_id", "order_value", "freight_value", "item_count", "primary_category", "n_categories", "seller_id")


def order_category(lines: DataFrame) -> DataFrame:
    """Most frequent category per order (smallest on ties) and category count."""
    return category_cells(lines).groupBy("order_id").agg(*_main_category())


def category_cells(lines: DataFrame) -> DataFrame:
    """(order_id, category, n): the lines of each category in each order."""
    return lines.groupBy("order_id", "product_category_name_english").agg(F.count("*").alias("n"))


def _main_category() -> list[Column]:
    category = F.col("product_category_name_english")
    best = F.min(F.when(category.isNotNull(), F.struct((-F.col("n")).alias("n"), category.alias("v"))))
    return [F.coalesce(best.getField("v"), F.lit(fv.UNKNOWN)).alias("primary_category"),
            F.count(category).alias("n_categories")]


# --- sessions -----------------------------------------------------------------

def session_activity(activity: DataFrame) -> DataFrame:
    """Event counts by type, cart quantity, mean scroll and mean duration per session."""
    def of(kind: str) -> Column:
        return F.count_if(F.col("activity_type") == kind)
    return activity.groupBy("session_id").agg(
        F.count("*").alias("n_events"),
        of("product_view").alias("n_product_views"),
        of("search").alias("n_searches"),
        of("add_to_cart").alias("n_add_to_cart"),
        F.coalesce(F.sum("add_to_cart_quantity"), F.lit(0)).alias("total_cart_qty"),
        (F.sum("scroll_percent") / F.count("scroll_percent")).alias("avg_scroll"),
        (F.sum("duration_seconds") / F.count("duration_seconds")).alias("avg_page_duration"))


def event_presence(activity: DataFrame) -> DataFrame:
    """Which event types occur in each session, as 0/1 flags."""
    kinds = [F.max((F.col("activity_type") == kind).cast("int")).alias(f"has_{kind}")
             for kind in fv.ACTIVITY_TYPES]
    return activity.groupBy("session_id").agg(*kinds)


def last_event(activity: DataFrame) -> DataFrame:
    """Event count and type of the last event of each session."""
    at = F.struct("activity_timestamp", "activity_id")
    return activity.groupBy("session_id").agg(
        F.count("*").alias("n_events"), F.max_by("activity_type", at).alias("last_type"))


def reconciled_cart(activity: DataFrame, expected: DataFrame, order: list[str]) -> DataFrame:
    """Raise cart quantities to the expected items of each session.

    A session short of its ``item_count`` adds the whole gap to its first
    add_to_cart event, or turns its first event into one. Sessions without an
    expectation need one item.
    """
    at = F.struct(*order)
    in_cart = F.col("activity_type") == "add_to_cart"
    per_session = activity.groupBy("session_id").agg(
        F.sum("add_to_cart_quantity").alias("have"),
        F.coalesce(F.min(F.when(in_cart, at)), F.min(at)).alias("fix_at"))
    wanted = expected.select("session_id", "item_count")
    gaps = (per_session.join(wanted, "session_id", "left")
            .select("session_id", "fix_at",
                    (F.coalesce("item_count", F.lit(1)) - F.col("have")).alias("gap"))
            .where(F.col("gap") > 0))
    hit = F.coalesce(at == F.col("fix_at"), F.lit(False))
    return activity.join(gaps, "session_id", "left").withColumns({
        "activity_type": F.when(hit, "add_to_cart").otherwise(F.col("activity_type")),
        "add_to_cart_quantity": F.col("add_to_cart_quantity")
        + F.when(hit, F.col("gap")).otherwise(F.lit(0)),
    }).drop("fix_at", "gap")


# --- customers over time --------------------------------------------------------

def rfm_features(orders: DataFrame, key: str = "customer_id") -> DataFrame:
    """Age, recency and frequency of the customer at each order, and date parts."""
    slim = orders.select("order_id", key, "order_purchase_timestamp")
    past = order_history(slim, key, "order_purchase_timestamp", "order_id")
    bought = F.col("order_purchase_timestamp")
    parts = calendar(bought)
    return past.select(
        "order_id",
        whole_days("first_at", bought).alias("customer_age_days"),
        F.coalesce(whole_days("previous_at", bought), F.lit(0)).alias("recency_days"),
        F.col("sequence_no").alias("frequency"),
        *[parts[name].alias(name)
          for name in ("purchase_month", "purchase_quarter", "purchase_day_of_month")])


def customer_order_count(rows: DataFrame, key: str = "customer_unique_id") -> DataFrame:
    """Add the number of rows of each row's customer (aggregate, then join back)."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        F.count("order_id").alias("customer_order_count"))
    return rows.join(counts, rows[key] == counts["__key"], "left").drop("__key")


def regional_price_index(values: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Median order value of each state relative to the overall median."""
    values = cut_lineage(values.select("order_id", "order_value"))
    placed = (values.join(orders.select("order_id", "customer_id"), "order_id")
              .join(customers.select("customer_id", "customer_state"), "customer_id"))
    states = median(placed.where(F.col("customer_state").isNotNull()), ["customer_state"],
                    "order_value", "state_median")
    overall = scalars(quantiles(values, [], "order_value", [0.5], ["m"]))["m"]
    return states.select("customer_state", (F.col("state_median") / overall).alias("regional_price_index"))


# --- payments and reviews ---------------------------------------------------------

def payment_summary(payments: DataFrame) -> DataFrame:
    """Payment count, first type by sequence, and most installments per order."""
    return payments.groupBy("order_id").agg(
        F.count("*").alias("n_payments"),
        F.min(F.struct("payment_sequential", "payment_type")).getField("payment_type").alias("payment_type"),
        F.max("payment_installments").alias("payment_installments"))


def review_summary(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        (F.sum("review_score") / F.count("review_score")).alias("review_score"))
