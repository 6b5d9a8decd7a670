"""The whole job: validate, clean, engineer, encode, fit, compare, report.

    python -m basketry.job RAW_DIR BEHAVIOUR_DIR OUT_DIR [--split 2018-04-01] [--models linear,ridge,...]

The exit code is 1 if a contract check fails; nothing is built then. Spark writes everything to OUT_DIR.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from basketry import fixed_values as fv
from basketry.operators import gram
from basketry.operators.sampling import fold_number, time_split
from basketry.plans import drift, features, metrics, modeling, models, scoring, validation
from basketry.session import build_session, cut_lineage
from basketry.sources.tables import read_commerce, save_model, write_csv, write_json, write_parquet

SPLIT = "2018-04-01"
KEPT = ("order_id", "order_purchase_timestamp", "target_log")


def training_matrix(data: DataFrame, split: str = SPLIT) -> tuple[features.Preprocessor, DataFrame, list[str], DataFrame]:
    """(preprocessor, matrix, columns, inflation) of a modeling dataset. Runs Spark jobs.

    Encoders are fitted on rows before the split date, and so is the variance inflation by which
    collinear numeric columns leave the matrix.
    """
    rows = features.matrix_input(features.engineer_features(features.with_target(data)), KEPT)  # of the dataset's copy
    pre = features.fit_preprocessor(rows, split)
    matrix = cut_lineage(features.assert_no_leakage(pre.apply(rows, keep=KEPT)))
    train, _ = time_split(matrix, "order_purchase_timestamp", split)
    inflation = features.vif(train, pre.numeric)
    dropped = {r.feature for r in inflation.where("dropped").collect()}  # one row for each numeric column
    return pre, matrix, [c for c in pre.feature_names if c not in dropped], inflation


def compare_models(matrix: DataFrame, columns: Sequence[str], split: str = SPLIT,
                   names: Sequence[str] | None = None) -> tuple[dict, DataFrame]:
    """Fitted pipelines, and a metrics row for each model on the rows from the split date on.

    The linear models come from the moments of one scan, the trees are fitted one after another.
    """
    train, test = time_split(matrix, "order_purchase_timestamp", split)
    wanted = list(names or (*gram.SOLVERS, *models.TREE_FITS))
    fitted = models.fit_lines(train, columns, [n for n in wanted if n in gram.SOLVERS])
    fitted |= {n: models.TREE_FITS[n](train, columns) for n in wanted if n not in gram.SOLVERS}
    return fitted, models.measured({n: fitted[n] for n in wanted}, test)


def run(spark: SparkSession, tables: Mapping[str, DataFrame], out: str, split: str = SPLIT,
        names: Sequence[str] | None = None) -> bool:
    """Run all steps; False if validation failed."""
    write_json(validation.validate(tables), f"{out}/validation")
    if not validation.all_passed(spark.read.json(f"{out}/validation")):
        return False
    counts = modeling.CleaningCounts()
    write_parquet(modeling.modeling_dataset(tables, counts=counts), f"{out}/modeling_dataset")
    write_json(modeling.counted_audit(spark, counts), f"{out}/cleaning_audit")
    data = spark.read.parquet(f"{out}/modeling_dataset")
    pre, matrix, columns, inflation = training_matrix(data, split)
    pre.save(f"{out}/preprocessor")
    write_csv(inflation, f"{out}/variance_inflation")
    write_csv(features.feature_catalog(spark, pre), f"{out}/feature_catalog")
    write_parquet(matrix.select(*KEPT, *columns), f"{out}/feature_matrix")
    matrix = spark.read.parquet(f"{out}/feature_matrix")

    fitted, comparison = compare_models(matrix, columns, split, names)
    write_parquet(comparison, f"{out}/model_comparison")
    comparison = spark.read.parquet(f"{out}/model_comparison")
    best = metrics.best_model(comparison)
    name = best.first().model
    write_json(metrics.kpi_status(best), f"{out}/kpi_status")
    train, test = time_split(matrix, "order_purchase_timestamp", split)
    write_csv(gram.cross_validated(train, columns, "target_log", fold_number("order_id")), f"{out}/cross_validation")
    write_parquet(metrics.residuals(fitted[name].transform(test), "target_log", "prediction", ["order_id"]),
                  f"{out}/predictions")
    save_model(fitted[name], best, f"{out}/model")
    watched = list(columns)
    if name not in gram.SOLVERS:
        importance = models.feature_importance(fitted[name], columns, train)
        write_csv(importance, f"{out}/feature_importance")
        watched = models.top_features(importance)
    write_parquet(scoring.explained(fitted[name], test, columns, train), f"{out}/explanations")

    scored = fitted[name].transform(drift.labelled_by_time(matrix, "order_purchase_timestamp", split))
    windows = cut_lineage(scored.select("is_ref", *columns, "target_log", "prediction"))
    write_csv(drift.feature_tests(windows, [*watched, "target_log", "prediction"]), f"{out}/feature_drift")
    raw = drift.labelled_by_time(data, "order_purchase_timestamp", split)
    write_csv(drift.feature_tests(raw, [c for c in fv.ONE_HOT_COLUMNS if c in data.columns]), f"{out}/category_drift")
    scores = cut_lineage(drift.psi(windows, columns))
    write_csv(scores, f"{out}/drift_scores")
    write_json(drift.drift_report(scores), f"{out}/drift_report")
    return True


def main(arguments: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw")
    parser.add_argument("behaviour")
    parser.add_argument("out")
    parser.add_argument("--split", default=SPLIT)
    parser.add_argument("--models", help="comma-separated; all by default")
    args = parser.parse_args(arguments)
    spark = build_session("order-value")
    tables = read_commerce(spark, args.raw, args.behaviour)
    tables.setdefault("sessions", tables.get("behavioral_sessions"))
    names = args.models.split(",") if args.models else None
    return 0 if run(spark, tables, args.out, args.split, names) else 1


if __name__ == "__main__":
    sys.exit(main())
