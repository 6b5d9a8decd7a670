"""Exploratory tables: the data behind every figure and summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.functions.numeric import quantile_label
from basketry.functions.temporal import minutes_between
from basketry.operators.ordered import group_mode
from basketry.operators.quantile import attach_row, median, quantiles
from basketry.operators.stats import box_stats, correlations
from basketry.plans import facts
from basketry.plans.modeling import active_sessions, suffixed


def eda_dataset(t: Mapping[str, DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """All orders with items, their value, main category, profile and session.

    The profile is joined to the customers, and the activity to the pairs of order and session, so that the wide
    rows move by order only. ``columns`` leaves only these; without one of the category, the lines need not move
    for it.
    """
    values = facts.order_value(t["items"], with_mean=True)
    people = t["customers"].select("customer_id", "customer_unique_id", "customer_state")
    profile = t["profile"].withColumnRenamed("customer_id", "customer_id_profile")
    known = people.join(profile, F.col("customer_unique_id") == F.col("customer_id_profile"))
    translation = t["category_translation"]
    named = columns is None or bool({"product_category_name", *translation.columns} & set(columns))
    df = t["orders"].join(known, "customer_id").join(values, "order_id")
    if named:
        lines = t["items"].join(t["products"], "product_id")
        category = group_mode(lines, ["order_id"], "product_category_name", "product_category_name")
        df = df.join(category, "order_id", "left")
    taken = [c for c in (*df.columns, *(translation.columns if named else ())) if c != "order_id"]
    sessions = active_sessions(suffixed(t["sessions"], taken, "_session"), t["session_activity"])
    sessions = sessions.withColumn("session_duration_min", minutes_between("session_start", "session_end"))
    df = df.join(sessions.drop("n_add_to_cart"), "order_id")
    if named:  # last, as it has another key than the rest
        df = df.join(translation, "product_category_name", "left")
    order = ["session_id", "order_id", "product_category_name", *t["orders"].columns, *values.columns, *people.columns,
             *translation.columns, *profile.columns, *sessions.columns]
    if columns is None:
        columns = [c for c in dict.fromkeys(order) if c not in ("session_duration_min", "n_add_to_cart")] + ["session_duration_min"]
    return df.select(*columns)


def delivered(df: DataFrame) -> DataFrame:
    return df.where(F.col("order_status") == fv.DELIVERED)


def top_categories(df: DataFrame, category: str, value: str, least: int = 50, top: int = 15) -> DataFrame:
    """Categories with at least ``least`` orders, by median value, best first."""
    rows = df.where(F.col(category).isNotNull())
    cuts = median(rows, [category], value, "median_value")
    means = rows.groupBy(category).agg(F.avg(value).alias("mean_value"), F.count(value).alias("n"))
    return (means.join(cuts, category).na.drop().where(F.col("n") >= least)
            .orderBy(F.desc("median_value"), category).limit(top))


def median_by_segment(df: DataFrame, segments: Sequence[str], value: str) -> DataFrame:
    """(segment, level, median_value) for several one-column groupings in one pass."""
    long = df.select(value, *segments).unpivot([value], list(segments), "segment", "level")
    return median(long.where(F.col("level").isNotNull()), ["segment", "level"], value, "median_value")


def segment_boxes(df: DataFrame, segments: Sequence[str], value: str) -> DataFrame:
    """Box statistics of the value at every level of several columns, in one pass.

    The order status is shown over all orders, the other segments over delivered ones.
    """
    long = df.select("order_status", value, *[F.col(s).alias(f"__{s}") for s in segments]).unpivot(
        ["order_status", value], [f"__{s}" for s in segments], "segment", "level")
    named = long.withColumn("segment", F.expr("substring(segment, 3)"))
    shown = named.where((F.col("segment") == "order_status") | (F.col("order_status") == fv.DELIVERED))
    return box_stats(shown, ["segment", "level"], value)


def quartile_labels(df: DataFrame, x: str, name: str) -> DataFrame:
    """Q1..Q4 by right-closed cuts at the column's quartiles."""
    cuts = quantiles(df, [], x, [0.25, 0.5, 0.75], ["q1", "q2", "q3"])
    edges = [F.col(f"__cut.{q}") for q in ("q1", "q2", "q3")]
    return attach_row(df, cuts, "__cut").withColumn(name, quantile_label(x, edges)).drop("__cut")


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of every other column with the target, strongest first."""
    found = correlations(df, [(target, c) for c in columns if c != target])
    return found.select(F.col("column_b").alias("feature"), "r").orderBy(F.desc("r"))


def collinear_pairs(df: DataFrame, columns: Sequence[str], target: str, limit: float = 0.7) -> DataFrame:
    """Column pairs (target excluded) whose absolute correlation exceeds the limit."""
    rest = [c for c in columns if c != target]
    found = correlations(df, [(a, b) for i, a in enumerate(rest) for b in rest[i + 1:]])
    return found.where(F.abs("r") > limit)
