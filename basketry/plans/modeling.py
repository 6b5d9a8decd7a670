"""The modeling dataset: a star join of all facts around one row per kept order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import fixed_values as fv
from basketry.functions.labels import urban_flag
from basketry.functions.numeric import haversine_km
from basketry.functions.temporal import minutes_between
from basketry.operators.nulls import fill_by_type
from basketry.operators.quantile import scalars
from basketry.plans import facts
from basketry.session import cut_lineage, hinted, lookup

Tables = Mapping[str, DataFrame]

# Computed for every row, so they are never null and need no fill.
_ALWAYS_SET = (
    "order_id", "customer_id", "order_purchase_timestamp", "order_value", "freight_value",
    "item_count", "customer_unique_id", "customer_id_profile", "session_id", "session_start",
    "session_end", "customer_urban", "customer_age_days", "recency_days", "frequency",
    "purchase_month", "purchase_quarter", "purchase_day_of_month", "regional_price_index",
    "cust_seller_distance_km", "session_duration_min", "seller_id", "customer_order_count",
)


def shared(df: DataFrame) -> DataFrame:
    """Written once, since several branches of a plan read it."""
    return cut_lineage(df)


def suffixed(df: DataFrame, taken: list[str], suffix: str) -> DataFrame:
    """Rename columns that already exist on the other side of a join."""
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c in taken})


def drop_listed(df: DataFrame) -> DataFrame:
    """Remove listed columns, then every timestamp that is not on the keep list."""
    kept = []
    for field in df.drop(*fv.DROPPED_COLUMNS).schema:
        is_time = isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType, T.DateType))
        if not is_time or field.name in fv.KEPT_TIMESTAMPS:
            kept.append(field.name)
    return df.select(*kept)


class CleaningCounts:
    """Row counts that the writes of the modeling dataset take along.

    Each is observed in the stage that writes, after the last shuffle before it: such a stage counts each of
    its tasks once, also when executors are lost. Repeated rows come there as a column of copies.
    """

    def __init__(self) -> None:
        self._observed: list[Observation] = []

    def watch(self, df: DataFrame, **metrics: Column) -> DataFrame:
        """``df``, whose next write counts these aggregates."""
        seen = Observation()
        self._observed.append(seen)
        return df.observe(seen, *[value.alias(name) for name, value in metrics.items()])

    def values(self) -> dict[str, int]:
        """All counts; waits for the writes."""
        return {name: value or 0 for seen in self._observed for name, value in seen.get.items()}


def _kept_and_counted(orders: DataFrame, lines: DataFrame, counts: CleaningCounts) -> tuple[DataFrame, DataFrame]:
    copies, rows = F.sum("__copies"), F.count("*")
    kept = F.count_if(F.col("order_status").isin(*fv.KEPT_STATUSES))
    return (counts.watch(orders, orders=copies, unique_orders=rows, order_ids=F.count("order_id"), kept_orders=kept),
            counts.watch(lines, lines=copies, unique_lines=rows))


def merged_orders(t: Tables, as_of: bool = False, counts: CleaningCounts | None = None,
                  order_count: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """The star join before null filling. Runs Spark jobs.

    Seller and category statistics take all lines, or with ``as_of`` for each order those of orders bought
    before it. Orders, lines and facts by order are stored once, and these writes fill ``counts``. With
    ``order_count`` each row has the number of rows of its customer, counted on keys alone. ``columns``
    leaves only these.

    Every column moves by order once. What has another key is looked up before that, on narrow rows:
    customer, place, region index and profile (folded into one customer table) for the bare orders, seller
    and category for the order facts, and the activity for the pairs of session and order. Category, place
    and region tables are stored and counted, and broadcast if they are small, so a common category or
    region is no hot key. Lines are stored as the dedup leaves them, an order's side by side, for the sums by
    order, and what the statistics read of them again with its category.
    """
    products = facts.translated_products(t["products"], t["category_translation"])
    unread = [c for c in fv.DROPPED_COLUMNS if c != "order_approved_at"]
    bought = facts.dedup_orders(t["orders"].drop(*unread), "__copies")
    single = facts.dedup_items(t["items"].drop("shipping_limit_date"), "__copies")
    if counts:
        bought, single = _kept_and_counted(bought, single, counts)
    bought, single = shared(bought).drop("__copies"), shared(single).drop("__copies")
    read = ["order_id", "product_id", "seller_id", "price", *(["order_item_id"] if as_of else [])]
    lines = facts.categorised_items(single.select(*read), products)
    lines = shared(lines if as_of else lines.drop("product_id"))
    cells = shared(facts.category_cells(lines))
    orders = facts.kept_orders(facts.with_approval(bought))
    by_order = facts.valued_orders(facts.order_facts(single, cells), orders)
    by_order = shared(counts.watch(by_order, valued_orders=F.count("*")) if counts else by_order)
    centroids = hinted(*lookup(facts.geo_centroid(t["geolocation"])))
    places = facts.seller_places(t["sellers"], centroids)

    rfm, paid = facts.rfm_features(orders), facts.payment_summary(t["payments"])
    reviewed = facts.review_summary(t["reviews"])
    index = hinted(*lookup(facts.regional_price_index(by_order, orders, t["customers"])))
    if as_of:
        by_category = facts.category_price_as_of(lines, bought).withColumnRenamed(
            "primary_category", "product_category_name_english")
        sold = (by_order.join(by_category, "order_id", "left")
                .join(facts.seller_stats_as_of(lines, bought).join(places, "seller_id", "left").drop("seller_id"),
                      "order_id", "left"))
    else:
        by_category = hinted(*lookup(facts.category_price_stats(lines, cells).withColumn(
            "primary_category", F.col("product_category_name_english"))))
        by_seller = facts.seller_stats(lines).join(places, "seller_id", "left")
        sold = by_order.join(by_category, "primary_category", "left").join(by_seller, "seller_id", "left")

    minutes = {"session_duration_min": minutes_between("session_start", "session_end")}
    own = [c for df in (orders, by_order, rfm, paid, reviewed) for c in df.columns if c != "order_id"]
    sessions = active_sessions(suffixed(t["sessions"].drop("customer_id"), own, "_session"), t["session_activity"])
    if columns is not None and not {"session_start", "session_end"} & set(columns):
        sessions, minutes = sessions.withColumns(minutes).drop("session_start", "session_end"), {}  # one column moves, not two
    taken = [c for c in (*own, "order_id", *sessions.columns) if c != "customer_id"]
    people = suffixed(customer_table(t, centroids, index), taken, "_profile")
    if order_count:
        people = people.join(rows_by_customer(t, orders, by_order, t["sessions"]), "customer_unique_id", "left")
    df = (orders.join(people, "customer_id").join(sold, "order_id").join(rfm, "order_id")
          .join(paid, "order_id", "left").join(reviewed, "order_id", "left").join(sessions, "order_id"))
    first = ["seller_id", "primary_category", "customer_id", "session_id", "order_id"]
    last = [c for c in (*taken, *people.columns, *sold.columns) if c not in first]
    df = df.select(*dict.fromkeys([*first, *last])).withColumns({
        **minutes,
        "cust_seller_distance_km": haversine_km("geo_lat", "geo_lng", "seller_lat", "seller_lng"),
    })
    return drop_listed(df) if columns is None else drop_listed(df).select(*columns)


def rows_by_customer(t: Tables, orders: DataFrame, by_order: DataFrame, sessions: DataFrame) -> DataFrame:
    """(customer_unique_id, customer_order_count) of the star join's rows, from the keys that decide them."""
    people = t["customers"].select("customer_id", "customer_unique_id").join(
        t["profile"].select(F.col("customer_id").alias("customer_unique_id")), "customer_unique_id")
    keys = (orders.select("order_id", "customer_id").join(by_order.select("order_id"), "order_id")
            .join(sessions.select("order_id"), "order_id").join(people, "customer_id"))
    return keys.groupBy("customer_unique_id").agg(F.count("order_id").alias("customer_order_count"))


def active_sessions(sessions: DataFrame, activity: DataFrame) -> DataFrame:
    """Sessions with their activity, joined by order; nulls for a session without activity.

    The activity is looked up for the few columns of the (order, session) pairs, so that the wide sessions
    move by order only. There the session is a condition beside the key, as an order has few sessions.
    """
    pairs = sessions.select("order_id", "session_id").where(F.col("session_id").isNotNull()).repartition("session_id").distinct()
    found = pairs.join(facts.session_activity(activity), "session_id").withColumnsRenamed(
        {"order_id": "__order", "session_id": "__session"})
    same = (sessions["session_id"] <= found["__session"]) & (sessions["session_id"] >= found["__session"])
    return sessions.join(found, (sessions["order_id"] == found["__order"]) & same, "left").drop("__order", "__session")


def customer_table(t: Tables, centroids: DataFrame, index: DataFrame) -> DataFrame:
    """Customers with place, region price index (1 where unknown) and profile."""
    customers = t["customers"].select("customer_id", "customer_unique_id", "customer_state",
                                      "customer_zip_code_prefix")
    places = centroids.select(F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"),
                              "geo_lat", "geo_lng", urban_flag("geo_city").alias("customer_urban"))
    profile = t["profile"].withColumnRenamed("customer_id", "customer_id_profile")
    return (customers.join(places, "customer_zip_code_prefix", "left")
            .join(index, "customer_state", "left")
            .join(profile, F.col("customer_unique_id") == F.col("customer_id_profile"))
            .withColumns({"customer_urban": F.coalesce("customer_urban", F.lit(0)),
                          "regional_price_index": F.coalesce("regional_price_index", F.lit(1.0))}))


def modeling_dataset(t: Tables, as_of: bool = False, counts: CleaningCounts | None = None,
                     order_count: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per delivered or shipped order with a positive value, no nulls left. Runs Spark jobs.

    With ``as_of`` an order's seller and category statistics know only what was sold before it. With
    ``counts``, write the result; ``counted_audit`` then has the cleaning audit without another scan. With
    ``order_count`` it has ``customer_order_count`` too, so that the features need not move the rows by customer.
    With ``columns`` the rows are the same, but only these columns are moved through the joins, stored and filled.
    """
    df = merged_orders(t, as_of, counts, order_count, columns)
    filled = fill_by_type(df, [c for c in df.columns if c not in _ALWAYS_SET])
    return counts.watch(filled, dataset_rows=F.count("*")) if counts else filled


# Step of the audit -> the counts before and after it.
_STEPS = {"duplicate orders": ("orders", "unique_orders"), "duplicate items": ("lines", "unique_lines"),
          "status filter": ("order_ids", "kept_orders"), "order value": ("orders", "valued_orders"),
          "modeling dataset": ("orders", "dataset_rows")}


def counted_audit(spark: SparkSession, counts: CleaningCounts) -> DataFrame:
    """As ``cleaning_audit``, from the counts of a written modeling dataset; no percentage of nothing."""
    found = counts.values()
    rows = [(step, found[before], found[after]) for step, (before, after) in _STEPS.items()]
    return spark.createDataFrame(rows, "step string, before long, after long").withColumn(
        "kept_pct", F.try_divide(F.col("after") * 100.0, "before"))


def cleaning_audit(t: Tables) -> DataFrame:
    """(step, before, after) of each cleaning step, and the retention in percent."""
    orders, items = t["orders"], t["items"]
    unique_orders, kept = facts.dedup_orders(orders), facts.kept_orders(facts.dedup_orders(orders))
    values = facts.valued_orders(facts.order_value(facts.dedup_items(items)), kept)
    people = t["customers"].select("customer_id", "customer_unique_id")
    final = (values.join(kept.select("order_id", "customer_id"), "order_id")
             .join(people, "customer_id")
             .join(t["profile"].select(F.col("customer_id").alias("customer_unique_id")),
                   "customer_unique_id", "left_semi")
             .join(t["sessions"].select("order_id"), "order_id"))
    before = scalars(orders.agg(F.count("*").alias("n"), F.countDistinct("order_id").alias("distinct")))
    lines = scalars(items.agg(F.count("*").alias("n")))["n"]

    def step(name: str, frame: DataFrame, start) -> DataFrame:
        return frame.agg(F.count("*").alias("after")).select(
            F.lit(name).alias("step"), start.alias("before"), "after",
            (F.col("after") * 100.0 / start).alias("kept_pct"))
    return (step("duplicate orders", unique_orders, before["n"])
            .unionByName(step("duplicate items", facts.dedup_items(items), lines))
            .unionByName(step("status filter", kept, before["distinct"]))
            .unionByName(step("order value", values, before["n"]))
            .unionByName(step("modeling dataset", final, before["n"])))
