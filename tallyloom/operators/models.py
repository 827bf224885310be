"""Regression models of several families and their comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .linear import regression_metrics
from .partials import spread
from .trees import DefaultForest, PrunedTree, RandomisedTrees, SecondOrderBoosting, TreesModel


def regressors(
    label: str, n_features: int, trees: int = 5000, rounds: int = 15, default_trees: int = 500, seed: int = 11
) -> dict[str, Estimator]:
    """The compared families with their fixed settings."""
    common = {"labelCol": label, "featuresCol": "features"}
    # Settings of the compared models.
    return {
        "linear": LinearRegression(**common, solver="auto", regParam=0.0),
        "elastic_net": LinearRegression(**common, regParam=10.0, elasticNetParam=0.1),
        "tree": PrunedTree(**common, max_depth=5, min_n=7, complexity=0.001),
        "forest": RandomisedTrees(**common, trees=trees, mtry=8, min_n=10, seed=seed),
        "forest_default": DefaultForest(**common, trees=default_trees, seed=seed),
        "boosted": SecondOrderBoosting(**common, rounds=rounds, rate=0.25, max_depth=7, mtry=min(30, n_features), seed=seed),
    }


def fit_all(
    train: DataFrame, features: Sequence[str], label: str, estimators: Mapping[str, Estimator]
) -> dict[str, PipelineModel]:
    """Fit every family on the same cached vectors; a small file must not leave all fits to one core."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    data = spread(assembler.transform(train).select("features", label)).persist()
    try:
        return {name: PipelineModel([assembler, est.fit(data)]) for name, est in estimators.items()}
    finally:
        data.unpersist()


def workflow(features: Sequence[str], estimator: Estimator, *before) -> Pipeline:
    """Feature stages and a model as one estimator on raw rows."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return Pipeline(stages=[*before, assembler, estimator])


def predict_all(models: Mapping[str, PipelineModel], df: DataFrame, keep: Sequence[str], together: bool = False) -> DataFrame:
    """Predictions of models that share their feature stages, in one long table ``(model_id, keep..., pred)``.

    The feature vector is built once, and every model adds its own column to
    the same rows. ``together`` sorts rows of equal features next to each other;
    trees route them once.
    """
    first = next(iter(models.values()))
    wide = PipelineModel(first.stages[:-1]).transform(df)
    if together and any(isinstance(m.stages[-1], TreesModel) for m in models.values()):
        wide = _near(wide.select(*keep, "features"))
    for i, model in enumerate(models.values()):
        wide = model.stages[-1].copy().setPredictionCol(f"__p{i}").transform(wide)
    cells = [F.struct(F.lit(n).alias("model_id"), F.col(f"__p{i}").alias("pred")) for i, n in enumerate(models)]
    return wide.select(*keep, F.inline(F.array(*cells)))


def _near(wide: DataFrame) -> DataFrame:
    """Rows sorted by a hash of their features; many rows of equal features may lie in several partitions."""
    keyed = wide.withColumns({"__k": F.xxhash64(vector_to_array("features")), "__r": F.monotonically_increasing_id()})
    return keyed.repartitionByRange(wide.rdd.getNumPartitions(), "__k", "__r").sortWithinPartitions("__k").drop("__k", "__r")


def metrics_all(models: Mapping[str, Model], df: DataFrame, label: str) -> DataFrame:
    return regression_metrics(predict_all(models, spread(df), [label], together=True), label, "pred", ["model_id"])


def _last(model: Model) -> Model:
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def importance(spark: SparkSession, model: Model, features: Sequence[str]) -> DataFrame:
    """Impurity importance per feature, largest first."""
    values = _last(model).featureImportances.toArray().tolist()
    table = spark.createDataFrame(list(zip(features, values)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def coefficients(spark: SparkSession, model: Model, features: Sequence[str]) -> DataFrame:
    """Coefficients of a linear model, largest absolute value first."""
    last = _last(model)
    rows = [("(Intercept)", float(last.intercept)), *zip(features, last.coefficients.toArray().tolist())]
    table = spark.createDataFrame(rows, "term string, estimate double")
    return table.orderBy(F.desc(F.abs("estimate")), "term")


def parameters(spark: SparkSession, model_id: str, model: Model) -> DataFrame:
    """All settings of a fitted model as rows."""
    last = _last(model)
    found = {p.name: v for p, v in last.extractParamMap().items()} | getattr(last, "settings", {})
    return spark.createDataFrame([(model_id, n, str(v)) for n, v in sorted(found.items())], "model_id string, param string, value string")
