"""Evaluation of scored rows.

Input is always one long table ``(model_id, row_id, label, score)`` with label
0/1, so that the tables of all models come from one query. Rows are counted per
distinct score before anything is ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import sent
from .ordering import ROWS_PER_TASK, measure, running

BY = "model_id"


def score_counts(scored: DataFrame) -> DataFrame:
    """Rows and positives per model and distinct score."""
    known = scored.filter(F.col("score").isNotNull() & F.col("label").isNotNull())
    return known.groupBy(BY, "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("pos")
    )


def _class_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy(BY).agg(F.sum("pos").alias("p_all"), F.sum(F.col("n") - F.col("pos")).alias("n_all"))


def threshold_table(scored: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Counts and rates for every distinct score used as threshold (score >= threshold is positive)."""
    counts = score_counts(scored)
    size = measure(counts, [BY])
    sums = {"__n": "n", "tps": "pos"}
    up = running(counts, [BY], [-F.col("score")], cumsum=sums, rows_per_task=rows_per_task, size=size)
    full = up.join(sent(_class_totals(counts), size.groups), BY)
    tps, fps = F.col("tps"), F.col("__n") - F.col("tps")
    tns, fns = F.col("n_all") - fps, F.col("p_all") - tps
    return full.select(
        BY,
        F.col("score").alias("threshold"),
        tps.alias("tps"),
        fps.alias("fps"),
        tns.alias("tns"),
        fns.alias("fns"),
        F.try_divide(tps, F.col("p_all")).alias("tpr"),
        F.try_divide(fps, F.col("n_all")).alias("fpr"),
        F.try_divide(tps, tps + fps).alias("precision"),
        F.try_divide(tps, F.col("p_all")).alias("recall"),
        F.try_divide(2 * tps, 2 * tps + fps + fns).alias("f1"),
        F.try_divide(tps + tns, F.col("p_all") + F.col("n_all")).alias("accuracy"),
        F.col("pos").alias("pos_here"),
        (F.col("n") - F.col("pos")).alias("neg_here"),
    )


def roc_points(thresholds: DataFrame) -> DataFrame:
    return thresholds.select(BY, "threshold", "fpr", "tpr")


def pr_points(thresholds: DataFrame) -> DataFrame:
    return thresholds.select(BY, "threshold", "recall", "precision")


def _area_aggregates() -> dict[str, Column]:
    p_all, n_all = F.col("tps") + F.col("fns"), F.col("fps") + F.col("tns")
    pairs = F.sum(F.col("neg_here") * (F.col("tps") - F.col("pos_here") / 2))
    before_t, before_f = F.col("tps") - F.col("pos_here"), F.col("fps") - F.col("neg_here")
    before = F.coalesce(F.try_divide(before_t, before_t + before_f), F.col("precision"))
    step = F.try_divide(F.col("pos_here"), p_all) * (F.col("precision") + before) / 2
    return {"auc": F.try_divide(pairs, F.max(p_all).cast("double") * F.max(n_all)), "aucpr": F.sum(step)}


def areas(thresholds: DataFrame) -> DataFrame:
    """Exact AUC, Gini and the area under precision-recall per model.

    AUC is the rank form: every pair of a positive and a negative counts 1, or
    1/2 when the scores are equal. The precision-recall area is the trapezoid
    between neighbouring thresholds, starting at recall 0 with the precision of
    the first one.
    """
    out = thresholds.groupBy(BY).agg(*[c.alias(n) for n, c in _area_aggregates().items()])
    return out.select(BY, "auc", (2 * F.col("auc") - 1).alias("gini"), "aucpr")


def best_threshold(thresholds: DataFrame, metric: str = "f1") -> DataFrame:
    """The row with the largest metric per model; of equal rows the highest threshold."""
    row = F.struct(*[c for c in thresholds.columns if c != BY])
    best = thresholds.groupBy(BY).agg(F.max_by(row, F.struct(metric, "threshold")).alias("r"))
    return best.select(BY, "r.*")


def log_loss(label: Column, score: Column, eps: float = 1e-15) -> Column:
    """Loss of one row."""
    p = F.least(F.greatest(score, F.lit(eps)), F.lit(1 - eps))
    return -F.when(label == 1, F.log(p)).otherwise(F.log(1 - p))


def probability_metrics(scored: DataFrame) -> DataFrame:
    """Log loss, mean squared error and its root per model."""
    known = scored.filter(F.col("score").isNotNull() & F.col("label").isNotNull())
    gap = F.col("label") - F.col("score")
    out = known.groupBy(BY).agg(
        F.avg(log_loss(F.col("label"), F.col("score"))).alias("logloss"), F.avg(gap * gap).alias("mse")
    )
    return out.select(BY, "logloss", F.sqrt("mse").alias("rmse"), "mse")


def confusion(best: DataFrame) -> DataFrame:
    """Confusion matrix with totals and error rates from one threshold row per model."""
    r = {c: F.col(c) for c in ("tps", "fps", "tns", "fns")}

    def line(position, actual, no, yes, wrong):
        return F.struct(
            F.lit(position).alias("position"), F.lit(actual).alias("actual"), no.alias("predicted_no"),
            yes.alias("predicted_yes"), wrong.alias("errors"), (no + yes).alias("cases"),
            F.try_divide(wrong, no + yes).alias("error"),
        )

    cells = F.array(
        line(1, "No", r["tns"], r["fps"], r["fps"]),
        line(2, "Yes", r["fns"], r["tps"], r["fns"]),
        line(3, "Totals", r["tns"] + r["fns"], r["fps"] + r["tps"], r["fps"] + r["fns"]),
    )
    return best.select(BY, "threshold", F.inline(cells))


def leaderboard(scored: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per model: auc, logloss, aucpr, mean_per_class_error, rmse, mse; best auc first.

    All six metrics are sums over distinct scores, so they come from a single
    aggregate of the threshold table.
    """
    score, pos, neg = F.col("threshold"), F.col("pos_here"), F.col("neg_here")
    here = pos + neg
    loss = pos * log_loss(F.lit(1), score) + neg * log_loss(F.lit(0), score)
    square = pos * (1 - score) * (1 - score) + neg * score * score
    best = F.max_by(F.struct("tps", "fps", "tns", "fns"), F.struct("f1", "threshold"))
    table = threshold_table(scored, rows_per_task).groupBy(BY).agg(
        *[c.alias(n) for n, c in _area_aggregates().items()],
        F.try_divide(F.sum(loss), F.sum(here)).alias("logloss"),
        F.try_divide(F.sum(square), F.sum(here)).alias("mse"),
        best.alias("b"),
    )
    miss = F.try_divide(F.col("b.fns"), F.col("b.fns") + F.col("b.tps"))
    alarm = F.try_divide(F.col("b.fps"), F.col("b.fps") + F.col("b.tns"))
    return table.select(
        BY, "auc", "logloss", "aucpr", ((miss + alarm) / 2).alias("mean_per_class_error"),
        F.sqrt("mse").alias("rmse"), "mse",
    ).orderBy(F.desc("auc"), BY)


def with_label(scored: DataFrame, best: DataFrame, no: str = "No", yes: str = "Yes") -> DataFrame:
    """Predicted label and both probabilities, cut at the model's own best threshold.

    ``best`` has one row per model. The models of the scored rows are counted, and so few thresholds are broadcast
    that no scored row is shuffled.
    """
    models = scored.select(BY).distinct()
    cut = best.select(BY, F.col("threshold").alias("__cut")).join(models, BY, "left_semi")
    joined = scored.join(sent(cut, models.count()), BY)
    return joined.select(
        *scored.columns,
        F.when(F.col("score") >= F.col("__cut"), yes).otherwise(no).alias("predict"),
        (1 - F.col("score")).alias(no),
        F.col("score").alias(yes),
    )


def ranked(scored: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Scored rows with their truth, highest score first."""
    return scored.select(BY, "row_id", "score", "label", *keep).orderBy(F.desc("score"), "row_id")
