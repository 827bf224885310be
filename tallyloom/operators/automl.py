"""Model search: several families, cross-validated, stacked, ranked on a separate frame.

Unlike a search that ranks models on its own test rows, the leaderboard frame
is a third part of the data, so that test metrics stay honest.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import kept
from . import networks
from .evaluate import leaderboard
from .split import folds as with_folds

FOLD = "__fold"
FOLD_SALT = 1009  # draws of the folds are independent of the draws of a split


#: Rows that are worth a task of their own: a fit hands out its tasks again for every step.
TASK_ROWS = 4096
#: The same where many fits run at a time: their steps are many and short, and other fits keep the cores busy.
SHARED_TASK_ROWS = 1 << 16


def dealt(df: DataFrame, task_rows: int | None = None) -> DataFrame:
    """Cached, evenly over as many partitions as the rows need, and as many as there are cores if they need more."""
    df = df.persist()
    n = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    now, need = df.rdd.getNumPartitions(), max(1, -(-n // (task_rows or TASK_ROWS)))
    parts = need if need < cores else max(cores, min(now, need))
    if parts == now:
        return df
    out = df.repartition(parts).persist()
    out.count()
    df.unpersist()
    return out


@dataclass
class Candidate:
    """A named estimator; its output columns carry the name, so that models can be chained."""

    model_id: str
    estimator: Estimator


@dataclass
class Search:
    """Result of a search."""

    models: dict[str, PipelineModel]
    cross_validation: list[tuple[str, float, float]]
    skipped: list[str] = field(default_factory=list)

    def cv_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.cross_validation, "model_id string, cv_auc double, seconds double").orderBy(
            F.desc("cv_auc"), "model_id"
        )


def columns_of(model_id: str) -> dict[str, str]:
    safe = "".join(ch if ch.isalnum() else "_" for ch in model_id)
    return {"probabilityCol": f"p_{safe}", "rawPredictionCol": f"r_{safe}", "predictionCol": f"y_{safe}"}


def network(model_id: str, n_features: int, label: str, hidden: Sequence[int] = (10,), epochs: int = 50, seed: int = 5):
    """Feed-forward network with two outputs."""
    return Candidate(
        model_id,
        MultilayerPerceptronClassifier(
            featuresCol="features", labelCol=label, layers=[n_features, *hidden, 2], maxIter=epochs, seed=seed,
            **columns_of(model_id),
        ),
    )


def candidates(n_features: int, label: str, trees: int = 50, rounds: int = 50, seed: int = 5) -> list[Candidate]:
    """Default families, quickest first so that a short budget still yields models."""
    common = {"featuresCol": "features", "labelCol": label}
    return [
        Candidate("GLM_1", LogisticRegression(**common, regParam=0.01, **columns_of("GLM_1"))),
        Candidate("DRF_1", RandomForestClassifier(**common, numTrees=trees, seed=seed, **columns_of("DRF_1"))),
        network("DeepLearning_1", n_features, label, seed=seed),
        _boosted("GBM_1", label, rounds, seed),
        _support_vectors("SVC_1", label),
    ]


def _support_vectors(model_id: str, label: str) -> Candidate:
    """Linear support vectors; a logistic curve over the margin gives the probability."""
    own = columns_of(model_id)
    margin, cut = own["rawPredictionCol"], own["predictionCol"]
    svc = LinearSVC(featuresCol="features", labelCol=label, regParam=0.01, rawPredictionCol=margin, predictionCol=f"m{cut}")
    curve = LogisticRegression(
        featuresCol=margin, labelCol=label, regParam=1e-4, rawPredictionCol=f"m{margin}", predictionCol=cut,
        probabilityCol=own["probabilityCol"],
    )
    return Candidate(model_id, Pipeline(stages=[svc, curve]))


def _boosted(model_id: str, label: str, rounds: int, seed: int) -> Candidate:
    own = columns_of(model_id)
    trees = GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds, seed=seed)
    trees.setProbabilityCol(own["probabilityCol"]).setRawPredictionCol(own["rawPredictionCol"])
    return Candidate(model_id, trees.setPredictionCol(own["predictionCol"]))


def prepare(train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Assemble and scale; learned on training rows."""
    raw = VectorAssembler(inputCols=list(features), outputCol="__raw", handleInvalid="error")
    scaler = StandardScaler(inputCol="__raw", outputCol="features", withMean=True)
    return PipelineModel([raw, scaler.fit(raw.transform(train))])


def search(
    train: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    folds: int = 5,
    budget_seconds: float | None = None,
    wanted: Sequence[Candidate] | None = None,
    stack: bool = True,
    parallel: int = 6,
) -> Search:
    """Fit every candidate with cross-validation, then a stacked model over all of them.

    The fold of a row is a function of its key. When the time budget is used
    up, remaining candidates are skipped and named in the result; at least one
    is always fitted.
    """
    stages = prepare(train, features)
    data = dealt(_folded(stages.transform(train), key, folds).select(key, "features", label, FOLD), SHARED_TASK_ROWS)
    start, result, parts = time.time(), Search({}, []), {}
    wanted = list(wanted if wanted is not None else candidates(len(features), label))
    try:
        # Without a budget the fits of all candidates share the cores; with one, candidates come one after the other.
        for some in [wanted] if budget_seconds is None and wanted else [[c] for c in wanted]:
            if result.models and budget_seconds is not None and time.time() - start > budget_seconds:
                result.skipped += [c.model_id for c in some]
                continue
            seconds = [0.0] * len(some)
            fits = _cross_validate(data, [(c, {}) for c in some], label, folds, parallel, seconds=seconds)
            for c, (whole, held, auc), took in zip(some, fits, seconds):
                result.models[c.model_id] = PipelineModel([*stages.stages, whole])
                result.cross_validation.append((c.model_id, auc, took))
                parts[c.model_id] = held
        if stack and len(parts) > 1:
            began = time.time()
            meta, auc = _stack(data, parts, label, folds)
            bases = [result.models[m].stages[-1] for m in parts]
            result.models[STACKED] = PipelineModel([*stages.stages, *bases, *meta.stages])
            result.cross_validation.append((STACKED, auc, time.time() - began))
    finally:
        data.unpersist()
    return result


def fit_one(train: DataFrame, features: Sequence[str], wanted: Candidate) -> PipelineModel:
    """One candidate on all training rows, without cross-validation."""
    stages = prepare(train, features)
    return PipelineModel([*stages.stages, wanted.estimator.fit(stages.transform(train))])


def _folded(df: DataFrame, key: str, folds: int) -> DataFrame:
    return with_folds(df, key, folds, salt=FOLD_SALT, name=FOLD)


STACKED = "StackedEnsemble_AllModels"


def _cross_validate(
    data: DataFrame, settings: Sequence[tuple[Candidate, dict]], label: str, folds: int, parallel: int, whole: bool = True,
    seconds: list[float] | None = None,
) -> list[tuple]:
    """``(model on all rows, models per held-out fold, mean AUC)`` for every setting; ``seconds`` gets the time from
    the start of its first fit to the end of its last.

    All fits are independent jobs; a few are submitted at the same time, so the
    executors stay busy while single fits wait for their slowest task. Rows in few
    partitions leave room for more fits: as many as the cores take tasks of.
    """
    parallel = max(parallel, data.sparkSession.sparkContext.defaultParallelism // max(1, data.rdd.getNumPartitions()))
    jobs = [(i, f) for i in range(len(settings)) for f in [*([None] if whole else []), *range(folds)]]

    def timed(job):
        began = time.time()
        return fit(job), began, time.time()

    def fit(job):
        i, f = job
        c, params = settings[i]
        rows = data if f is None else data.filter(F.col(FOLD) != f)
        model = c.estimator.fit(rows, params) if params else c.estimator.fit(rows)
        if f is None:
            return i, f, model, None
        judge = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=columns_of(c.model_id)["rawPredictionCol"])
        return i, f, model, judge.evaluate(model.transform(data.filter(F.col(FOLD) == f)))

    with ThreadPool(max(1, min(parallel, len(jobs)))) as pool:
        done = pool.map(inheritable_thread_target(data.sparkSession)(timed), jobs, chunksize=1)
    for i in range(len(settings) if seconds is not None else 0):
        spans = [(began, ended) for (j, *_), began, ended in done if j == i]
        seconds[i] = max(e for _, e in spans) - min(b for b, _ in spans)
    done, out = [d for d, *_ in done], []
    for i in range(len(settings)):
        mine = {f: (model, auc) for j, f, model, auc in done if j == i}
        held = [mine[f][0] for f in range(folds)]
        out.append((mine[None][0] if whole else None, held, sum(mine[f][1] for f in range(folds)) / folds))
    return out


def _stack(data: DataFrame, parts: dict[str, list], label: str, folds: int) -> tuple[PipelineModel, float]:
    """Logistic model over out-of-fold probabilities.

    Each fold is scored by the models that did not see it. All base models add
    their own column to the same rows, so no join is needed.
    """
    held = []
    for f in range(folds):
        rows = data.filter(F.col(FOLD) == f)
        held.append(reduce(lambda df, models: models[f].transform(df), parts.values(), rows))
    keep = [label, *[columns_of(m)["probabilityCol"] for m in parts]]
    out_of_fold = reduce(lambda a, b: a.unionByName(b), [h.select(*keep) for h in held]).persist()
    try:
        joined = VectorAssembler(inputCols=keep[1:], outputCol="__meta")
        meta = LogisticRegression(featuresCol="__meta", labelCol=label, regParam=0.01, **columns_of(STACKED))
        model = meta.fit(joined.transform(out_of_fold))
        return PipelineModel([joined, model]), float(model.summary.areaUnderROC)
    finally:
        out_of_fold.unpersist()


def score(models: dict[str, PipelineModel], df: DataFrame, key: str, label: str | None = None) -> DataFrame:
    """Long scored table ``(model_id, row_id, label, score)`` of all models from one pass over the rows."""
    wide, todo = df, dict(models)
    if STACKED in models:  # the stacked model scores its base models on the way
        out = models[STACKED].transform(df)
        found = {m: columns_of(m)["probabilityCol"] for m in models if columns_of(m)["probabilityCol"] in out.columns}
        scores = [vector_to_array(c)[1].alias(f"__s_{c}") for c in found.values()]
        wide = out.select(*df.columns, *scores)
        todo = {m: model for m, model in models.items() if m not in found}
    for name, model in todo.items():
        own = columns_of(name)["probabilityCol"]
        out = model.transform(wide)
        wide = out.select(*wide.columns, vector_to_array(own)[1].alias(f"__s_{own}"))
    cells = [
        F.struct(F.lit(m).alias("model_id"), F.col(f"__s_{columns_of(m)['probabilityCol']}").alias("score"))
        for m in models
    ]
    truth = F.col(label).cast("int") if label else F.lit(None).cast("int")
    return wide.select(F.col(key).alias("row_id"), truth.alias("label"), F.inline(F.array(*cells))).select(
        "model_id", "row_id", "label", "score"
    )


def board(found: Search, frame: DataFrame, key: str, label: str) -> DataFrame:
    """Leaderboard of all models on rows that took no part in fitting."""
    return leaderboard(kept(score(found.models, frame, key, label), "scored"))


def network_grid(
    train: DataFrame, key: str, features: Sequence[str], label: str,
    hidden: Sequence[Sequence[int]] = ((10, 10, 10), (50, 20, 10), (20, 20, 20)),
    epochs: Sequence[int] = (10, 50, 100), folds: int = 5, parallel: int = 6,
) -> tuple[PipelineModel, list[tuple[str, int, float]]]:
    """Network size x epochs, cross-validated. Returns the best model and the sorted grid.

    All sizes and folds are trained in common passes, and the longest fit of a size hands out the shorter ones.
    """
    stages = prepare(train, features)
    data = dealt(_folded(stages.transform(train), key, folds).select("features", label, FOLD))
    base = network("DeepLearning_grid", len(features), label)
    sizes = [[len(features), *h, 2] for h in hidden]
    layers, rounds = base.estimator.layers, base.estimator.maxIter
    grid = ParamGridBuilder().addGrid(layers, sizes).addGrid(rounds, list(epochs)).build()
    spark = data.sparkSession
    passed = networks.rows_of(data, label, FOLD).persist()
    judge = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=base.estimator.getRawPredictionCol())
    try:
        wanted = []
        for size in sizes:
            start = networks.model_with(spark, base.estimator.copy({layers: size})).weights.toArray()
            wanted += [(size, f, start, epochs) for f in range(folds)]
        fitted = networks.fit_all(passed, wanted)

        def held_out(job):
            params, f = job
            weights = fitted[sizes.index(params[layers]) * folds + f][params[rounds]]
            model = networks.model_with(spark, base.estimator.copy(params), weights)
            return judge.evaluate(model.transform(data.filter(F.col(FOLD) == f)))

        jobs = [(params, f) for params in grid for f in range(folds)]
        with ThreadPool(max(1, min(parallel, len(jobs)))) as pool:
            areas = pool.map(inheritable_thread_target(spark)(held_out), jobs, chunksize=1)
        rows = [
            (str(params[layers][1:-1]), int(params[rounds]), sum(areas[i * folds : (i + 1) * folds]) / folds, i)
            for i, params in enumerate(grid)
        ]
        rows.sort(key=lambda r: (-r[2], r[0], r[1]))
        best = base.estimator.fit(data, grid[rows[0][3]])
    finally:
        passed.unpersist()
        data.unpersist()
    return PipelineModel([*stages.stages, best]), [r[:3] for r in rows]
