"""Model fitting, comparison and tuning: linear models on one-scan moments, boosted trees and forests on bins."""

from __future__ import annotations

import dataclasses
import json
import random
from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import fixed_values as fv
from basketry.operators import gram, trees
from basketry.operators.forest import Forest
from basketry.operators.forest import fit as fit_forest
from basketry.operators.sampling import fold_number
from basketry.plans.metrics import regression_metrics
from basketry.session import cut_lineage, ship_package

_COLUMNS = {"featuresCol": "features", "labelCol": "target_log", "predictionCol": "prediction"}


def linear(**options) -> LinearRegression:
    """Least squares. Redundant dummies are fine: a singular system falls back to iteration."""
    return LinearRegression(**_COLUMNS, regParam=0.0, standardization=False, **options)


def ridge(train: DataFrame, alpha: float = 1.0, label: str = "target_log", **options) -> LinearRegression:
    """Squared penalty ``alpha`` on the summed loss.

    MLlib averages the loss and measures it in deviations of the label, so its
    parameter is alpha * deviation / rows; both come from one pass.
    """
    row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("std")).first()
    strength = alpha * (row["std"] or 1.0) / max(row.n, 1)
    return LinearRegression(**_COLUMNS, elasticNetParam=0.0, regParam=strength,
                            standardization=False, **options)


def lasso(alpha: float = 0.1, **options) -> LinearRegression:
    return LinearRegression(**_COLUMNS, elasticNetParam=1.0, regParam=alpha, standardization=False,
                            **{"maxIter": 5000, **options})


def boosted(**options) -> GBTRegressor:
    """Boosted trees on absolute error."""
    settings = {"lossType": "absolute", "maxIter": 300, "maxDepth": 6, "stepSize": 0.05,
                "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42}
    return GBTRegressor(**_COLUMNS, **{**settings, **options})


def assembled(columns: Sequence[str], estimator: Estimator) -> Pipeline:
    """Vector assembly at the model edge, then the estimator; a forest reads the columns themselves."""
    if isinstance(estimator, ForestEstimator):
        return Pipeline(stages=[estimator.copy({estimator.columns: list(columns)})])
    return Pipeline(stages=[VectorAssembler(inputCols=list(columns), outputCol="features"), estimator])


class LinePredictor(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted linear model as a pipeline stage; it reads the feature columns themselves, without a vector."""

    columns = Param(Params._dummy(), "columns", "feature columns", TypeConverters.toListString)
    coefficients = Param(Params._dummy(), "coefficients", "a weight for each column", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "prediction where all features are 0", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, columns=None, coefficients=None, intercept=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def line(self) -> gram.Line:
        return gram.Line(tuple(self.getOrDefault(self.columns)), np.array(self.getOrDefault(self.coefficients)),
                         self.getOrDefault(self.intercept))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("prediction", self.line().prediction())


def fit_lines(train: DataFrame, columns: Sequence[str], names: Sequence[str] = tuple(gram.SOLVERS),
              label: str = "target_log") -> dict[str, PipelineModel]:
    """The linear models of these names, all from one scan of the rows. Runs a Spark job."""
    whole = gram.total(gram.moments(train.where(F.col(label).isNotNull()), [*columns, label]))
    lines = {name: gram.SOLVERS[name](whole, label) for name in names}
    return {name: PipelineModel([LinePredictor(
        columns=list(line.columns), coefficients=line.coefficients.tolist(), intercept=line.intercept)])
        for name, line in lines.items()}


class EnsemblePredictor(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted boosted trees as a pipeline stage; the nodes are kept as text in a parameter."""

    nodes = Param(Params._dummy(), "nodes", "columns, base and nodes of the trees", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, nodes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, ensemble: trees.Ensemble) -> EnsemblePredictor:
        return cls(nodes=json.dumps({"columns": ensemble.columns, "base": ensemble.base,
                                     "trees": [dataclasses.asdict(t) for t in ensemble.trees]}))

    def ensemble(self) -> trees.Ensemble:
        found = json.loads(self.getOrDefault(self.nodes))
        return trees.Ensemble(found["columns"], found["base"], [trees.Tree(**t) for t in found["trees"]])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        return dataset.withColumn("prediction", self.ensemble().prediction())


class ForestPredictor(EnsemblePredictor):
    """A fitted forest as a pipeline stage; its nodes become text when it is saved."""

    _forest = None

    @classmethod
    def of(cls, ensemble: Forest) -> ForestPredictor:
        found = cls()
        found._forest = ensemble
        return found

    def ensemble(self) -> Forest:
        if self._forest is None:
            self._forest = Forest.of_text(self.getOrDefault(self.nodes))
        return self._forest

    def write(self):
        self._set(nodes=self.ensemble().text())
        return super().write()


class ForestEstimator(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """A random forest on the bins of the feature columns, all of them at every cut."""

    columns = Param(Params._dummy(), "columns", "feature columns", TypeConverters.toListString)
    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of cuts of a tree", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a leaf", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the bags", TypeConverters.toInt)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "column whose hash decides the bags", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns=None, numTrees=200, maxDepth=15, minInstancesPerNode=10, seed=42,
                 labelCol="target_log", keyCol="order_id"):
        super().__init__()
        self._setDefault(numTrees=200, maxDepth=15, minInstancesPerNode=10, seed=42, labelCol="target_log", keyCol="order_id")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ForestPredictor:
        of = self.getOrDefault
        return ForestPredictor.of(fit_forest(dataset, of(self.columns), of(self.labelCol), of(self.keyCol), of(self.numTrees),
                                             of(self.maxDepth), of(self.minInstancesPerNode), of(self.seed)))


def forest(**options) -> ForestEstimator:
    """200 trees of depth 15 with 10 rows a leaf, unless set otherwise."""
    return ForestEstimator(**options)


# Boosting on absolute error, and on squared error with the tuned settings.
ABSOLUTE = trees.Settings(rounds=300, rate=0.05, depth=6, row_share=0.8, column_share=0.8, loss="absolute")
TUNED = trees.Settings(**fv.TUNED_TREES)


def fit_boosted(train: DataFrame, columns: Sequence[str], settings: trees.Settings = ABSOLUTE,
                label: str = "target_log", key: str = "order_id") -> PipelineModel:
    """Boosted trees on gradient histograms. Runs Spark jobs, one for each level of each tree."""
    return PipelineModel([EnsemblePredictor.of(trees.boost(train, columns, label, key, settings))])


def fit_tuned(train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """The stored tuned settings, all of them."""
    return fit_boosted(train, columns, TUNED)


# How each model of the comparison is fitted; the linear ones share one scan (``fit_lines``).
TREE_FITS = {"forest": lambda train, columns: assembled(columns, forest()).fit(train),
             "boosted": fit_boosted, "tuned": fit_tuned}


def measured(fitted: dict[str, Model], test: DataFrame) -> DataFrame:
    """One metrics row for each model on the test rows."""
    rows = None
    for name, model in fitted.items():
        scored = regression_metrics(model.transform(test), "target_log", "prediction")
        row = scored.select(F.lit(name).alias("model"), *scored.columns)
        rows = row if rows is None else rows.unionByName(row)
    return rows


def fit_and_measure(train: DataFrame, test: DataFrame, columns: Sequence[str],
                    models: dict[str, Estimator]) -> tuple[dict[str, Model], DataFrame]:
    """Fitted pipelines and one metrics row per model on the test rows."""
    fitted = {name: assembled(columns, estimator).fit(train) for name, estimator in models.items()}
    return fitted, measured(fitted, test)


def cross_validate(train: DataFrame, columns: Sequence[str], estimator: Estimator, key: str,
                   folds: int = 5, parallelism: int = 4) -> tuple[float, float]:
    """Mean and population deviation of the log-space MAE over hash folds of the key.

    The columns are stored first, since each fold is trained on and measured. Runs Spark jobs.
    """
    keyed = cut_lineage(train.select(*columns, "target_log", fold_number(key, folds).alias("fold")))
    cv = CrossValidator(
        estimator=assembled(columns, estimator), estimatorParamMaps=[{}], numFolds=folds,
        evaluator=RegressionEvaluator(labelCol="target_log", metricName="mae"),
        foldCol="fold", parallelism=parallelism).fit(keyed)
    return float(cv.avgMetrics[0]), float(cv.stdMetrics[0])


class OriginalSpaceMae(Evaluator):
    """Mean absolute error after undoing the log transform; smaller is better."""

    def _evaluate(self, dataset: DataFrame) -> float:
        error = F.abs(F.expm1("target_log") - F.expm1("prediction"))
        return float(dataset.agg(F.avg(error)).first()[0])

    def isLargerBetter(self) -> bool:
        return False


def tune(train: DataFrame, columns: Sequence[str], trials: int = 50, seed: int = 42,
         parallelism: int = 4, rounds: tuple[int, int] = (300, 1500)) -> tuple[dict, float]:
    """Random search over boosted-tree settings; returns the best settings and their MAE."""
    rng = random.Random(seed)
    estimator = boosted(lossType="squared")
    pipeline = assembled(columns, estimator)
    grid = []
    for _ in range(trials):
        grid += (ParamGridBuilder()
                 .baseOn({estimator.maxIter: rng.randint(*rounds),
                          estimator.stepSize: 10 ** rng.uniform(-2, -1),
                          estimator.maxDepth: rng.randint(3, 12),
                          estimator.minInstancesPerNode: rng.randint(5, 100),
                          estimator.subsamplingRate: rng.uniform(0.6, 1.0),
                          estimator.featureSubsetStrategy: f"{rng.uniform(0.6, 0.99):.3f}"}).build())
    fit = TrainValidationSplit(estimator=pipeline, estimatorParamMaps=grid, evaluator=OriginalSpaceMae(),
                               trainRatio=0.8, seed=seed, parallelism=parallelism).fit(train)
    best = min(range(len(grid)), key=lambda i: fit.validationMetrics[i])
    return {p.name: v for p, v in grid[best].items()}, float(fit.validationMetrics[best])


def feature_importance(model: Model, columns: Sequence[str], train: DataFrame) -> DataFrame:
    """(feature, importance) of a tree pipeline, highest first; as many rows as features."""
    stage = model.stages[-1]
    if isinstance(stage, EnsemblePredictor):
        rows = list(stage.ensemble().importance().items())
    else:
        rows = [(c, float(w)) for c, w in zip(columns, stage.featureImportances.toArray())]
    return train.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def top_features(importance: DataFrame, k: int = 15) -> list[str]:
    return [r.feature for r in importance.orderBy(F.desc("importance"), "feature").limit(k).collect()]


def missing_columns(model_columns: Sequence[str], df: DataFrame) -> tuple[list[str], list[str]]:
    """Model columns the data lacks, and data columns the model does not know."""
    return (sorted(set(model_columns) - set(df.columns)), sorted(set(df.columns) - set(model_columns)))
