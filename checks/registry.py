"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import configure
from checks.star import StarTables
from checks import views

SPLIT = views.SPLIT
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Table name of the plans -> adapter view.
_ADAPTERS = {name: name for name in (
    "orders", "items", "customers", "products", "category_translation", "sellers", "geolocation",
    "payments", "reviews", "profile", "sessions", "session_items", "timed_session_items",
    "session_activity", "event_sessions", "behavioral_sessions", "delivered_orders")}


class Tables(Mapping[str, DataFrame]):
    """The adapter views as the table mapping that plans take.

    Order sessions play the sessions, so their events are the order lines.
    """

    def __init__(self, spark: SparkSession, folder: str, activity: str = "session_items"):
        self.star = StarTables(spark, folder)
        self._names = {**_ADAPTERS, "events": "session_activity", "session_activity": activity}

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self.star, self._names[name])

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name``, with the SQL it must agree with."""
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(configure(spark), folder))
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = views.sql(sql)
        return build
    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that two engines agree on the last digits."""
    doubles = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])




def r(x: str | Column, digits: int = 6) -> Column:
    return F.round(x, digits)
