"""Linear models, cross-validation and variance inflation from one-scan moments."""

from pyspark.sql import functions as F

from basketry import job
from basketry.operators import gram
from basketry.operators.sampling import fold_number, time_split
from basketry.plans import facts, features, models
from basketry.plans.modeling import modeling_dataset
from checks.registry import SPLIT, query, rounded

FEATURES = ("item_count", "freight_value")

_DRAW = "CAST('0x' || substr(md5('42:' || order_id), 1, 8) AS BIGINT) / 4294967296e0"
_ROWS = f"""x AS (SELECT CAST(item_count AS DOUBLE) AS a, freight_value AS b, ln(1 + order_value) AS y,
      CAST(floor({_DRAW} * 5) AS INT) AS fold FROM v_kept_value)"""
_SUMS = """avg(a) AS ma, avg(b) AS mb, avg(y) AS my, count(*) * var_pop(a) AS aa, count(*) * var_pop(b) AS bb,
      count(*) * covar_pop(a, b) AS ab, count(*) * covar_pop(a, y) AS ay, count(*) * covar_pop(b, y) AS yb, count(*) AS n"""


def _solved(source: str, keys: str = "") -> str:
    """Weights of the two features for each penalty: on the diagonal (ridge), or off the cross products (lasso)."""
    return f"""w AS (SELECT {keys} model, wa, wb, my - wa * ma - wb * mb AS base FROM (
      SELECT *, ((bb + p) * (ay - n * l) - ab * (yb - n * l)) / ((aa + p) * (bb + p) - ab * ab) AS wa,
        ((aa + p) * (yb - n * l) - ab * (ay - n * l)) / ((aa + p) * (bb + p) - ab * ab) AS wb
      FROM {source}, (VALUES ('linear', 0e0, 0e0), ('ridge', 1e0, 0e0), ('lasso', 0e0, 1e-3)) AS m(model, p, l))
      WHERE l = 0 OR (wa > 0 AND wb > 0))"""


def value_rows(t):
    values = facts.valued_orders(facts.order_value(facts.dedup_items(t["items"])), facts.kept_orders(t["orders"]))
    return values.select("order_id", F.col("item_count").cast("double").alias("item_count"), "freight_value",
                         "order_value", F.log1p("order_value").alias("target_log"))


SOLVERS = {"linear": gram.least_squares, "ridge": gram.ridge, "lasso": lambda m, label: gram.lasso(m, label, 1e-3)}


@query("moments_by_fold", f"""
    WITH {_ROWS}, s AS (SELECT fold, {_SUMS} FROM x GROUP BY fold)
    SELECT fold, n, round(ma, 6) AS mean_a, round(mb, 6) AS mean_b, round(aa / n, 6) AS var_a, round(ab / n, 6) AS cov_ab,
      round(yb / n, 6) AS cov_by FROM s""")
def _(t):
    found = gram.moments(value_rows(t), [*FEATURES, "target_log"], fold_number("order_id"))
    rows = [(f, int(m.n), *(round(float(x), 6) for x in (*m.mean[:2], m.cross[0, 0] / m.n, m.cross[0, 1] / m.n, m.cross[1, 2] / m.n)))
            for f, m in found.items()]
    return t["orders"].sparkSession.createDataFrame(
        rows, "fold int, n long, mean_a double, mean_b double, var_a double, cov_ab double, cov_by double")


@query("lines_two_features", f"""
    WITH {_ROWS}, s AS (SELECT {_SUMS} FROM x), {_solved('s')}
    SELECT model, round(wa, 6) AS weight_a, round(wb, 6) AS weight_b, round(base, 5) AS intercept FROM w""")
def _(t):
    whole = gram.total(gram.moments(value_rows(t), [*FEATURES, "target_log"]))
    lines = {name: solve(whole, "target_log") for name, solve in SOLVERS.items()}
    rows = [(n, round(float(f.coefficients[0]), 6), round(float(f.coefficients[1]), 6), round(f.intercept, 5)) for n, f in lines.items()]
    return t["orders"].sparkSession.createDataFrame(rows, "model string, weight_a double, weight_b double, intercept double")


@query("cross_validate_two_features", f"""
    WITH {_ROWS}, s AS (SELECT f.fold, {_SUMS} FROM (SELECT DISTINCT fold FROM x) f JOIN x ON x.fold <> f.fold GROUP BY f.fold),
      {_solved('s', 'fold,')},
      e AS (SELECT model, x.fold, avg(abs(y - base - wa * a - wb * b)) AS mae FROM x JOIN w ON x.fold = w.fold GROUP BY ALL)
    SELECT model, CAST(count(*) AS INT) AS folds, round(avg(mae), 6) AS mae_mean, round(stddev_pop(mae), 6) AS mae_std
    FROM e GROUP BY model""")
def _(t):
    return rounded(gram.cross_validated(value_rows(t), FEATURES, "target_log", fold_number("order_id"), SOLVERS))


@query("vif_three_features", """
    WITH c AS (SELECT corr(item_count, freight_value) AS ab, corr(item_count, order_value) AS ac,
        corr(freight_value, order_value) AS bc FROM v_kept_value),
      d AS (SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS det FROM c)
    SELECT unnest(['item_count', 'freight_value', 'order_value']) AS feature,
      round(unnest([(1 - bc * bc) / det, (1 - ac * ac) / det, (1 - ab * ab) / det]), 5) AS vif, false AS dropped
    FROM d""")
def _(t):
    return rounded(features.vif(value_rows(t), [*FEATURES, "order_value"]), 5)


# The whole feature matrix of the kept orders, default settings. SQL has no closed form for these.

def full_matrix(t):
    """(matrix, columns, variance inflation) as the job makes them."""
    data = modeling_dataset(t, order_count=True, columns=features.matrix_sources(["order_id"]))
    _, matrix, columns, inflation = job.training_matrix(data, SPLIT)
    return matrix, columns, inflation


def line_metrics(t, name):
    matrix, columns, _ = full_matrix(t)
    train, test = time_split(matrix, "order_purchase_timestamp", SPLIT)
    return models.measured(models.fit_lines(train, columns, [name]), test)


@query("fit_linear")
def _(t):
    return line_metrics(t, "linear")


@query("fit_ridge")
def _(t):
    return line_metrics(t, "ridge")


@query("fit_lasso")
def _(t):
    return line_metrics(t, "lasso")


@query("cross_validate")
def _(t):
    matrix, columns, _ = full_matrix(t)
    train, _ = time_split(matrix, "order_purchase_timestamp", SPLIT)
    return gram.cross_validated(train, columns, "target_log", fold_number("order_id"))


@query("vif")
def _(t):
    return full_matrix(t)[2]
