"""Search over settings by successive halving.

Settings are drawn by a hash per family, so a search can be repeated. Every rung scores the settings that are left by
cross-validation on a sample of the training rows, keeps the best part and goes on with a larger sample. The samples are
nested: a row belongs to a rung if the hash of its key lies below the rung's share, so the rows of a rung contain those of
the rung before. Settings that fall out stay as rows of the result.
"""

from __future__ import annotations

from collections.abc import Sequence

import xxhash
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import hash_uniform
from .automl import FOLD, Candidate, _cross_validate, _folded, columns_of, dealt, network, prepare

FAMILIES = ("GLM", "DRF", "GBM", "DeepLearning")
BOARD = "model_id string, family string, settings string, rung int, n_rows long, cv_auc double, kept boolean"


def _draw(seed: int, name: str, n: int, what: str) -> float:
    return xxhash.xxh64_intdigest(f"{seed}/{name}/{n}/{what}") / 2.0**64


def drawn(n_features: int, label: str, count: int, seed: int = 7, families: Sequence[str] = FAMILIES) -> list[tuple[Candidate, str, dict]]:
    """``count`` candidates, the families in turn, with the settings drawn for each."""
    out = []
    for i in range(count):
        family, n = families[i % len(families)], i // len(families) + 1
        name = f"{family}_{n}"

        def between(low, high, what, name=name, n=n):
            return low + (high - low) * _draw(seed, name, n, what)

        common = {"featuresCol": "features", "labelCol": label, **columns_of(name)}
        if family == "GLM":
            settings = {"regParam": round(10 ** between(-4, 0, "penalty"), 6), "elasticNetParam": round(between(0, 1, "mix"), 3)}
            candidate = Candidate(name, LogisticRegression(**common, **settings))
        elif family == "DRF":
            settings = {"numTrees": int(between(10, 60, "trees")), "maxDepth": int(between(3, 9, "depth")), "minInstancesPerNode": int(between(1, 11, "rows")),
                        "featureSubsetStrategy": ("sqrt", "onethird", "all")[int(between(0, 3, "features"))]}
            candidate = Candidate(name, RandomForestClassifier(**common, seed=seed, **settings))
        elif family == "GBM":
            settings = {"maxIter": int(between(5, 30, "rounds")), "maxDepth": int(between(2, 6, "depth")), "stepSize": round(between(0.05, 0.3, "step"), 3)}
            own = {k: v for k, v in common.items() if not k.endswith("Col") or k in ("featuresCol", "labelCol", "predictionCol")}
            trees = GBTClassifier(**own, seed=seed, **settings)
            trees.setProbabilityCol(common["probabilityCol"]).setRawPredictionCol(common["rawPredictionCol"])
            candidate = Candidate(name, trees)
        else:
            hidden = [int(between(4, 31, f"layer{k}")) for k in range(int(between(1, 3, "layers")))]
            settings = {"hidden": hidden, "epochs": int(between(20, 101, "epochs"))}
            candidate = network(name, n_features, label, hidden, settings["epochs"], seed)
        out.append((candidate, family, settings))
    return out


def shares(rungs: int, keep: int) -> list[float]:
    """Share of the rows of every rung; the last has all."""
    return [float(keep) ** -(rungs - 1 - r) for r in range(rungs)]


def sample(data: DataFrame, key: str, share: float, seed: int = 7) -> DataFrame:
    """Rows whose draw lies below the share; a larger share contains a smaller one."""
    return data.filter(hash_uniform(F.col(key), F.lit("rung"), F.lit(seed)) < share) if share < 1 else data


def search(
    train: DataFrame, key: str, features: Sequence[str], label: str, count: int = 63, rungs: int = 3, keep: int = 3, folds: int = 2,
    seed: int = 7, parallel: int = 6,
) -> tuple[PipelineModel, list[tuple]]:
    """The best model on all training rows, and a row per setting and rung it took part in.

    ``keep`` is the factor by which settings become fewer and rows more from rung to rung.
    """
    stages = prepare(train, features)
    data = dealt(_folded(stages.transform(train), key, folds).select(key, "features", label, FOLD))
    try:
        left = drawn(len(features), label, count, seed)
        rows: list[tuple] = []
        for rung, share in enumerate(shares(rungs, keep)):
            part = dealt(sample(data, key, share, seed)) if share < 1 else data
            n = part.count()
            found = _cross_validate(part, [(c, {}) for c, _, _ in left], label, folds, parallel, whole=False)
            if part is not data:
                part.unpersist()
            scored = sorted(zip(left, found), key=lambda e: (-e[1][2], e[0][0].model_id))
            most = max(1, len(left) // keep) if rung < rungs - 1 else 1
            rows += [(c.model_id, family, str(settings), rung, n, float(auc), i < most) for i, ((c, family, settings), (_, _, auc)) in enumerate(scored)]
            left = [setting for setting, _ in scored[:most]]
        best = left[0][0].estimator.fit(data)
    finally:
        data.unpersist()
    return PipelineModel([*stages.stages, best]), rows


def board(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), BOARD)
