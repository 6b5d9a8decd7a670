"""Model and report queries small enough that SQL has the same answer in closed form."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.sampling import split_label
from basketry.plans import facts, features, metrics, models, scoring
from basketry.session import checkpoint_dir
from basketry.sources.tables import read_csv, read_parquet, write_csv, write_parquet
from checks.modelling import predicted
from checks.registry import query, rounded

_DRAW = "CAST('0x' || substr(md5('42:' || order_id), 1, 8) AS BIGINT) / 4294967296e0"
_ROWS = f"""x AS (SELECT order_id, CAST(item_count AS DOUBLE) AS x, ln(1 + order_value) AS y,
      CASE WHEN {_DRAW} < 0.2 THEN 'test' ELSE 'train' END AS part, CAST(floor({_DRAW} * 5) AS INT) AS fold
    FROM v_kept_value)"""
_LINE = "covar_pop(x, y) / var_pop(x) AS slope, avg(y) - covar_pop(x, y) / var_pop(x) * avg(x) AS base"


def one_feature_rows(t):
    values = facts.valued_orders(facts.order_value(facts.dedup_items(t["items"])), facts.kept_orders(t["orders"]))
    return values.select("order_id", F.col("item_count").cast("double").alias("item_count"), "order_value",
                         F.log1p("order_value").alias("target_log"))


@query("run_summary", """
    WITH r AS (SELECT date_trunc('month', order_purchase_timestamp) AS m, avg(abs(y - p)) AS mae, avg(y) AS level
      FROM v_pred GROUP BY 1)
    SELECT CASE WHEN month(m) % 2 = 0 THEN 'even' ELSE 'odd' END AS model, count(*) AS runs, round(avg(mae), 4) AS mae_mean,
      round(stddev_samp(mae), 4) AS mae_std, round(avg(level), 4) AS level_mean, round(stddev_samp(level), 4) AS level_std
    FROM r GROUP BY 1""")
def _(t):
    month = F.date_trunc("month", "order_purchase_timestamp")
    runs = predicted(t).groupBy(month.alias("m")).agg(F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"), F.avg("y").alias("level"))
    runs = runs.withColumn("model", F.when(F.month("m") % 2 == 0, "even").otherwise("odd"))
    return rounded(metrics.run_summary(runs, "model", ["mae", "level"]), 4)


@query("best_model", """
    WITH m AS (SELECT CASE WHEN hour(order_purchase_timestamp) < 12 THEN 'morning' ELSE 'evening' END AS model,
        count(*) AS n, 1 - sum((yl - pl) * (yl - pl)) / (var_pop(yl) * count(*)) AS r2 FROM v_pred_log GROUP BY 1)
    SELECT model, n, round(r2, 6) AS r2_log FROM m ORDER BY r2 DESC LIMIT 1""")
def _(t):
    model = F.when(F.hour("order_purchase_timestamp") < 12, "morning").otherwise("evening")
    found = metrics.regression_metrics(predicted(t).withColumn("model", model), "yl", "pl", ["model"])
    return rounded(metrics.best_model(found).select("model", "n", "r2_log"))


@query("linear_contributions_one_feature", f"""
    WITH {_ROWS}, l AS (SELECT {_LINE}, avg(x) AS mx FROM x),
    c AS (SELECT order_id, base + slope * mx AS b, base + slope * x AS p, slope * (x - mx) AS c FROM x, l)
    SELECT order_id, round(b, 4) AS base_log, round(p, 4) AS predicted_log,
      CASE WHEN abs(c) >= 1e-4 THEN 'item_count' END AS feature, CASE WHEN abs(c) >= 1e-4 THEN round(c, 4) END AS contribution
    FROM c""")
def _(t):
    rows = one_feature_rows(t)
    line = models.assembled(["item_count"], models.linear()).fit(rows).stages[-1]
    means = rows.agg(F.avg("item_count").alias("item_count")).first().asDict()
    found = scoring.linear_contributions(rows, "order_id", ["item_count"], line, means)
    return rounded(found.select("order_id", "base_log", "predicted_log", "feature", "contribution"), 4)


@query("residuals_one_feature", f"""
    WITH {_ROWS}, l AS (SELECT {_LINE} FROM x WHERE part = 'train')
    SELECT order_id, round(base + slope * x, 4) AS predicted_log, round(y - base - slope * x, 4) + 0e0 AS residual_log
    FROM x, l WHERE part = 'test'""")
def _(t):
    rows = one_feature_rows(t).withColumn("part", split_label("order_id"))
    fitted = models.assembled(["item_count"], models.linear()).fit(rows.where("part = 'train'"))
    found = metrics.residuals(fitted.transform(rows.where("part = 'test'")), "target_log", "prediction", ["order_id"])
    return found.select("order_id", F.round("predicted_log", 4).alias("predicted_log"),
                        (F.round("residual_log", 4) + 0.0).alias("residual_log"))


@query("cross_validate_one_feature", f"""
    WITH {_ROWS}, l AS (SELECT f.fold, {_LINE} FROM (SELECT DISTINCT fold FROM x) f JOIN x ON x.fold <> f.fold GROUP BY f.fold),
    e AS (SELECT fold, avg(abs(y - base - slope * x)) AS mae FROM x JOIN l USING (fold) GROUP BY fold)
    SELECT count(*) AS folds, round(avg(mae), 5) AS mae_mean, round(stddev_pop(mae), 5) AS mae_std FROM e""")
def _(t):
    rows = one_feature_rows(t)
    mean, spread = models.cross_validate(rows, ["item_count"], models.linear(), "order_id")
    return rows.sparkSession.createDataFrame([(5, round(mean, 5), round(spread, 5))], "folds int, mae_mean double, mae_std double")


@query("vif_two_features", """
    WITH r AS (SELECT 1 / (1 - power(corr(item_count, order_value), 2)) AS v FROM v_kept_value)
    SELECT unnest(['item_count', 'order_value']) AS feature, round(v, 5) AS vif, v > 10 AS dropped FROM r""")
def _(t):
    return rounded(features.vif(one_feature_rows(t), ["item_count", "order_value"]), 5)


def _round_trip(t, name, write, read):
    rows = facts.order_value(facts.dedup_items(t["items"])).select("order_id", "order_value", "item_count")
    path = f"{checkpoint_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    write(rows, path)
    return read(rows.sparkSession, path, rows.schema)


_VALUES = "SELECT order_id, order_value, item_count FROM v_value"


@query("csv_round_trip", _VALUES)
def _(t):
    return _round_trip(t, "order_value_csv", write_csv, read_csv)


@query("parquet_round_trip", _VALUES)
def _(t):
    return _round_trip(t, "order_value_parquet", write_parquet, read_parquet)


@query("csv_pruned", "SELECT order_id, item_count FROM v_value")
def _(t):
    def read(spark, path, schema: T.StructType):
        return read_csv(spark, path, schema, ["order_id", "item_count"])
    return _round_trip(t, "order_value_pruned_csv", write_csv, read)
