"""Presentation of leaderboards and the four charts of the best models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_match
from .evaluate import BY, leaderboard, pr_points, roc_points, threshold_table
from .gainlift import fine_gain_lift
from .ordering import running
from .reshape import lengthen

ORDERS = ("auc", "logloss")


def _order(order_by) -> str:
    chosen = (order_by if isinstance(order_by, str) else order_by[0]).lower()
    if chosen not in ORDERS:
        raise ValueError(f"order_by = {chosen!r} is not permitted, use one of {ORDERS}")
    return chosen


def ranked_board(board: DataFrame) -> DataFrame:
    """Leaderboard with its row number (one row per model, best auc first) and the model family."""
    placed = running(board, [], [-F.col("auc"), BY], row_number="rank")
    return placed.withColumn("family", first_match(F.col(BY), "[^_]+"))


def board_long(board: DataFrame, order_by="auc", n_max: int = 20) -> DataFrame:
    """Top models with auc and logloss in long form.

    ``bar`` is the place on the axis: by auc ascending, or by logloss descending,
    so that the better model stands higher.
    """
    chosen = _order(order_by)
    kept = ranked_board(board).filter(F.col("rank") <= n_max)
    by = F.col("auc") if chosen == "auc" else -F.col("logloss")
    placed = running(kept, [], [by, -F.col("rank")], row_number="bar", bound=n_max)
    named = placed.withColumn("label", F.concat_ws(". ", F.col("rank").cast("string"), BY))
    return lengthen(named, ["rank", "label", "family", "bar"], list(ORDERS), position="position")


def model_at(board: DataFrame, position: int = 1) -> str:
    """Id of the model at a leaderboard position."""
    found = board.orderBy(F.desc("auc"), BY).offset(position - 1).limit(1).select(BY).collect()
    if not found:
        raise IndexError(f"the leaderboard has no position {position}")
    return found[0][0]


def performance_charts(scored: DataFrame, order_by="auc", max_models: int = 3) -> dict[str, DataFrame]:
    """ROC, precision-recall, gain and lift data of the best models.

    ``legend`` numbers the models by the chosen metric, best first.
    """
    chosen = _order(order_by)
    board = ranked_board(leaderboard(scored)).filter(F.col("rank") <= max_models)
    by = -F.col("auc") if chosen == "auc" else F.col("logloss")
    numbered = running(board, [], [by, BY], row_number="legend", bound=max_models).select(
        BY, "legend", F.bround("auc", 3).alias("auc"), F.bround("logloss", 4).alias("logloss")
    )
    lines_of_legend = numbered.collect()  # at most max_models rows
    legend = F.broadcast(scored.sparkSession.createDataFrame(lines_of_legend, numbered.schema))
    best = scored.filter(F.col(BY).isin([r[BY] for r in lines_of_legend]))
    thresholds = threshold_table(best)
    lines = fine_gain_lift(best)
    base = ["group", "cumulative_data_fraction"]
    return {
        "roc": roc_points(thresholds).join(legend, BY),
        "precision_recall": pr_points(thresholds).join(legend, BY),
        "gain": lines.select(BY, *base, F.col("cumulative_capture_rate").alias("gain")).join(legend, BY),
        "lift": lines.select(BY, *base, F.col("cumulative_lift").alias("lift")).join(legend, BY),
    }
