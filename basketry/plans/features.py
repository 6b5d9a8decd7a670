"""Feature engineering on the modeling dataset, and the encoded feature matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.functions.labels import tier_rank
from basketry.functions.numeric import ratio
from basketry.functions.temporal import age_years, calendar
from basketry.operators import encode, gram
from basketry.operators.sampling import time_split
from basketry.plans.facts import customer_order_count
from basketry.sources.tables import write_parquet


def session_ratios() -> dict[str, Column]:
    return {
        "cart_conversion": ratio("item_count", "total_cart_qty"),
        "engagement_rate": ratio("n_product_views", "n_events"),
        "search_intensity": ratio("n_searches", "n_events"),
        "items_per_minute": ratio("item_count", "session_duration_min", floor=0.1),
        "distance_per_item": ratio("cust_seller_distance_km", "item_count"),
    }


def interactions() -> dict[str, Column]:
    tier = tier_rank("loyalty_tier")
    desktop = F.coalesce(F.col("device_type") == "desktop", F.lit(False)).cast("double")
    return {
        "loyalty_numeric": tier,
        "income_x_loyalty": F.col("monthly_income") * tier,
        "log_income": F.log1p("monthly_income"),
        "seller_rep_x_loyalty": F.col("seller_order_count") * tier,
        "cat_price_x_income": F.col("cat_avg_price") * F.log1p("monthly_income"),
        "urban_x_desktop": F.col("customer_urban") * desktop,
    }


def engineer_features(df: DataFrame) -> DataFrame:
    """Derived columns added, target-derived columns removed. Rows that lack their customer's count are moved to get it."""
    parts = calendar("order_purchase_timestamp")
    clock = {name: parts[name] for name in ("purchase_hour", "purchase_dow", "is_weekend")}
    counted = df.drop(*fv.LEAKAGE_COLUMNS)
    if "customer_order_count" not in df.columns:
        counted = customer_order_count(counted)
    return counted.withColumns({**session_ratios(), **interactions(), **clock, "age": age_years("birth_date")})


def assert_no_leakage(df: DataFrame) -> DataFrame:
    found = [c for c in fv.LEAKAGE_COLUMNS if c in df.columns]
    if found:
        raise ValueError(f"target-derived columns among the features: {found}")
    return df


def with_target(df: DataFrame) -> DataFrame:
    return df.withColumns({"target": F.col("order_value"), "target_log": F.log1p("order_value")})


def matrix_input(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The engineered columns that a preprocessor reads, and ``keep``: what a join or a copy before it need not move is left out."""
    read = (*keep, *fv.ONE_HOT_COLUMNS, *fv.TARGET_ENCODED_COLUMNS, *fv.NUMERIC_COLUMNS, *fv.DERIVED_COLUMNS,
            *fv.BOOLEAN_COLUMNS, "is_weekend")
    return df.select(*dict.fromkeys(c for c in read if c in df.columns))


def matrix_sources(keep: Sequence[str] = ()) -> list[str]:
    """The columns of the modeling dataset that the features and the encoders read, and ``keep``."""
    return list(dict.fromkeys((*keep, "order_purchase_timestamp", "order_value", "birth_date", "customer_order_count",
                               *fv.ONE_HOT_COLUMNS, *fv.TARGET_ENCODED_COLUMNS, *fv.NUMERIC_COLUMNS, *fv.BOOLEAN_COLUMNS)))


@dataclass
class Preprocessor:
    """Fitted encoders: level lists, a target-mean table and a one-row scaler."""

    levels: dict[str, list[str]]
    encoding: DataFrame
    scaling: DataFrame
    numeric: list[str]
    encoded: list[str]
    booleans: list[str]

    @property
    def feature_names(self) -> list[str]:
        return [*self.numeric, *self.booleans, *(n for _, _, n in encode.one_hot_names(self.levels)),
                *(f"{c}_te" for c in self.encoded), "is_weekend"]

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Feature matrix rows; ``keep`` columns pass through unchanged."""
        passed = {f"__keep_{c}": F.col(c) for c in keep}
        df = df.withColumns({**passed, **encode.one_hot(self.levels),
                             **{c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.booleans},
                             "is_weekend": F.col("is_weekend").cast("double")})
        df = encode.apply_target_encoding(df, self.encoded, self.encoding)
        df = encode.scale(df, self.numeric, self.scaling)
        return df.select(*[F.col(f"__keep_{c}").alias(c) for c in keep],
                         *[F.col(c) for c in self.feature_names])

    def save(self, path: str) -> None:
        spark = self.scaling.sparkSession
        write_parquet(self.encoding, f"{path}/encoding")
        write_parquet(self.scaling, f"{path}/scaling")
        rows = [("level", c, i, level) for c, ls in self.levels.items() for i, level in enumerate(ls)]
        rows += [(kind, c, i, None) for kind in ("numeric", "encoded", "booleans")
                 for i, c in enumerate(getattr(self, kind))]
        write_parquet(spark.createDataFrame(rows, "kind string, column string, position int, level string"),
                      f"{path}/columns")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        rows = spark.read.parquet(f"{path}/columns").orderBy("position").collect()
        lists = {kind: [r["column"] for r in rows if r.kind == kind]
                 for kind in ("numeric", "encoded", "booleans")}
        levels: dict[str, list[str]] = {}
        for r in rows:
            if r.kind == "level":
                levels.setdefault(r["column"], []).append(r.level)
        ordered = {c: levels[c] for c in fv.ONE_HOT_COLUMNS if c in levels}
        ordered.update({c: found for c, found in levels.items() if c not in ordered})
        return cls(ordered, spark.read.parquet(f"{path}/encoding"),
                   spark.read.parquet(f"{path}/scaling"), **lists)


def fit_preprocessor(df: DataFrame, split_date: str, target: str = "target_log",
                     one_hot: Sequence[str] = fv.ONE_HOT_COLUMNS,
                     encoded: Sequence[str] = fv.TARGET_ENCODED_COLUMNS,
                     numeric: Sequence[str] = fv.NUMERIC_COLUMNS + fv.DERIVED_COLUMNS,
                     booleans: Sequence[str] = fv.BOOLEAN_COLUMNS) -> Preprocessor:
    """Levels come from all rows; target means and scaling from rows before the split date."""
    def present(names: Sequence[str]) -> list[str]:
        return [c for c in names if c in df.columns]
    train, _ = time_split(df, "order_purchase_timestamp", split_date)
    return Preprocessor(
        encode.category_levels(df, present(one_hot)),
        encode.fit_target_encoding(train, present(encoded), target),
        encode.fit_scaling(train, present(numeric)),
        present(numeric), present(encoded), present(booleans))


def vif(matrix: DataFrame, columns: Sequence[str], limit: float = 10.0) -> DataFrame:
    """(feature, vif, dropped): variance inflation, the largest dropped until all pass. Runs a Spark job.

    Spark reduces the rows to the moments of the columns; the inverse and the drop loop work on these.
    """
    return vif_of(matrix.sparkSession, gram.moments(matrix, columns), columns, limit)


def vif_of(spark: SparkSession, parts: Mapping[int, gram.Moments], columns: Sequence[str], limit: float = 10.0) -> DataFrame:
    """As ``vif``, from moments that hold the columns among others."""
    import numpy as np

    columns = list(columns)
    corr = gram.total(parts).of(columns).correlations() if parts else np.eye(len(columns))
    left, rows = list(range(len(columns))), []
    while left:
        inflation = np.diag(np.linalg.pinv(corr[np.ix_(left, left)], hermitian=True)).clip(min=1.0)
        rank = np.linalg.matrix_rank(corr[np.ix_(left, left)])
        worst = int(inflation.argmax())
        if rank == len(left) and inflation[worst] <= limit:
            rows += [(columns[i], float(v), False) for i, v in zip(left, inflation)]
            break
        value = float(inflation[worst]) if rank == len(left) else float("inf")
        if rank < len(left):
            worst = _dependent(corr, left)
        rows.append((columns[left.pop(worst)], value, True))
    return spark.createDataFrame(rows, "feature string, vif double, dropped boolean")


def _dependent(corr, left: list[int]) -> int:
    """Last position that the columns before it already determine."""
    import numpy as np

    for at in range(len(left) - 1, 0, -1):
        rest = left[:at] + left[at + 1:]
        if np.linalg.matrix_rank(corr[np.ix_(rest, rest)]) == np.linalg.matrix_rank(
                corr[np.ix_(left, left)]):
            return at
    return 0


def feature_catalog(spark: SparkSession, pre: Preprocessor) -> DataFrame:
    """(feature, feature_group) of the matrix, derived columns listed again as such."""
    groups: Mapping[str, Sequence[str]] = {
        "numeric": pre.numeric, "boolean": pre.booleans,
        "one-hot": [n for _, _, n in encode.one_hot_names(pre.levels)],
        "target encoded": [f"{c}_te" for c in pre.encoded],
        "derived": [c for c in (*fv.DERIVED_COLUMNS, "is_weekend") if c in pre.feature_names],
    }
    rows = [(feature, group) for group, found in groups.items() for feature in found]
    return spark.createDataFrame(rows, "feature string, feature_group string")
