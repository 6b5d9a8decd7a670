"""Error metrics, residual tables and rolling error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.functions.numeric import clip, right_closed_bucket
from basketry.operators.quantile import attach_row, median, same_keys


def _errors(df: DataFrame, truth_log: str, predicted_log: str, keys: Sequence[str]) -> DataFrame:
    y, p = F.expm1(truth_log), F.expm1(predicted_log)
    return df.select(*keys, F.col(truth_log).alias("yl"), F.col(predicted_log).alias("pl"),
                     y.alias("y"), p.alias("p"),
                     (F.abs(y - p) / clip(F.abs(y), low=1.0) * 100).alias("ape"))


def _metric_columns() -> list[Column]:
    log_error, error = F.col("yl") - F.col("pl"), F.col("y") - F.col("p")
    return [
        F.count("*").alias("n"),
        F.sqrt(F.avg(log_error * log_error)).alias("rmse_log"),
        F.avg(F.abs(log_error)).alias("mae_log"),
        (1 - F.sum(log_error * log_error) / (F.var_pop("yl") * F.count("yl"))).alias("r2_log"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.sum(F.abs(error)) / F.sum(F.abs("y")) * 100).alias("wape_pct"),
        F.avg(clip("ape", 0.0, 1000.0)).alias("mape_pct"),
        F.avg(error).alias("mean_error"), F.stddev_samp(error).alias("std_error"),
    ]


def regression_metrics(df: DataFrame, truth_log: str, predicted_log: str,
                       keys: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R2 in log space; RMSE, MAE, WAPE, MedAPE, MAPE in original space.

    One row per key (one in all without keys).
    """
    rows = _errors(df, truth_log, predicted_log, keys)
    moments = rows.groupBy(*keys).agg(*_metric_columns())
    middle = median(rows, keys, "ape", "medape_pct")
    if keys:
        marked = middle.withColumnsRenamed({k: f"__{k}" for k in keys})
        return moments.join(marked, same_keys(moments, marked, keys), "left").drop(*[f"__{k}" for k in keys])
    return attach_row(moments, middle, "__m").withColumn("medape_pct", F.col("__m.medape_pct")).drop("__m")


def regression_metrics_legacy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """MAE, WAPE and MedAPE as fractions, over plain values."""
    error = F.abs(F.col(truth) - F.col(predicted))
    rows = df.select(F.col(truth).alias("y"), error.alias("e"),
                     F.abs((F.col(truth) - F.col(predicted)) / F.greatest(F.col(truth), F.lit(1e-8))).alias("ape"))
    sums = rows.agg(F.avg("e").alias("mae"), (F.sum("e") / F.sum("y")).alias("wape"))
    middle = median(rows, [], "ape", "medape")
    return attach_row(sums, middle, "__m").withColumn("medape", F.col("__m.medape")).drop("__m")


def kpi_status(metrics: DataFrame) -> DataFrame:
    """(kpi, target, achieved, met) for the error targets."""
    columns = {"MAE": "mae", "WAPE": "wape_pct", "MedAPE": "medape_pct", "MAPE": "mape_pct"}
    cells = [F.struct(F.lit(kpi).alias("kpi"), F.lit(target).alias("target"),
                      F.col(columns[kpi]).alias("achieved"), (F.col(columns[kpi]) < target).alias("met"))
             for kpi, target in fv.KPI_TARGETS]
    return metrics.select(F.inline(F.array(*cells)))


def residuals(df: DataFrame, truth_log: str, predicted_log: str, keep: Sequence[str] = ()) -> DataFrame:
    """Truth, prediction and residual in both spaces."""
    return df.select(
        *keep, F.col(truth_log).alias("y_log"), F.col(predicted_log).alias("predicted_log"),
        (F.col(truth_log) - F.col(predicted_log)).alias("residual_log"),
        F.expm1(truth_log).alias("y"), F.expm1(predicted_log).alias("predicted"),
        (F.expm1(truth_log) - F.expm1(predicted_log)).alias("residual"))


def residual_buckets(table: DataFrame, buckets: int = 5) -> DataFrame:
    """Add the equal-width value bucket (1..buckets, right-closed) of each row."""
    edge = table.agg(F.min("y").alias("low"), F.max("y").alias("high"))
    bucket = right_closed_bucket("y", F.col("__e.low"), F.col("__e.high"), buckets)
    return attach_row(table, edge, "__e").withColumn("bucket", bucket).drop("__e")


def rolling_wape(df: DataFrame, time: str, truth: str, predicted: str, days: int = 7,
                 limit: float = fv.WAPE_THRESHOLD) -> DataFrame:
    """(day, wape_pct, breach): ratio of summed errors over the last ``days`` calendar days.

    Each daily sum is sent to the days whose window holds it, so the roll-up
    is a grouped sum over day rows instead of one ordered task.
    """
    daily = df.groupBy(F.to_date(time).alias("day")).agg(
        F.sum(F.abs(F.col(truth) - F.col(predicted))).alias("error"),
        F.sum(F.abs(truth)).alias("value"))
    spread = daily.select(F.col("day").alias("origin"), "error", "value",
                          F.explode(F.sequence(F.col("day"), F.date_add("day", days - 1))).alias("day"))
    rolled = spread.groupBy("day").agg(
        F.sum("error").alias("error"), F.sum("value").alias("value"),
        F.max((F.col("origin") == F.col("day")).cast("int")).alias("present"))
    wape = F.col("error") / F.col("value") * 100
    return rolled.where(F.col("present") == 1).select("day", wape.alias("wape_pct"), (wape > limit).alias("breach"))


def run_summary(runs: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of each metric per model over repeated runs."""
    stats = [f(F.col(c)).alias(f"{c}_{name}") for c in columns
             for name, f in (("mean", F.avg), ("std", F.stddev_samp))]
    return runs.groupBy(model).agg(F.count("*").alias("runs"), *stats)


def best_model(comparison: DataFrame, score: str = "r2_log") -> DataFrame:
    return comparison.orderBy(F.desc(score)).limit(1)
