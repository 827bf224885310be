"""Gain and lift tables and the data of their charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.steps import how_many_reached
from .evaluate import BY, score_counts
from .keys import sent
from .ordering import ROWS_PER_TASK, measure, ntile, running
from .reshape import lengthen

# Shares of the data at which the finer table is cut.
FRACTIONS = (0.01, 0.02, 0.03, 0.04, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def decile_table(scored: DataFrame, n: int = 10, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Cases and responses per score bucket; group 1 holds the highest scores."""
    bucket = ntile(scored, [BY], ["score", "row_id"], n, rows_per_task=rows_per_task)
    counts = bucket.groupBy(BY, "ntile").agg(
        F.count(F.lit(1)).alias("cases"), F.sum(F.col("label").cast("long")).alias("responses")
    )
    top = counts.groupBy(BY).agg(F.max("ntile").alias("__top"))
    return counts.join(top, BY).select(
        BY, "ntile", (F.col("__top") + 1 - F.col("ntile")).alias("group"), "cases", "responses"
    )


def gain_lift(table: DataFrame) -> DataFrame:
    """Cumulative gain and lift from cases and responses per group (a few rows per model)."""
    whole = W.partitionBy(BY)
    so_far = whole.orderBy("group").rowsBetween(W.unboundedPreceding, W.currentRow)
    cases, responses = F.col("cases"), F.col("responses")
    out = table.select(
        BY, "group", "cases", "responses",
        F.sum(responses).over(so_far).alias("cumulative_responses"),
        F.try_divide(responses, F.sum(responses).over(whole)).alias("pct_responses"),
        F.try_divide(F.sum(responses).over(so_far), F.sum(responses).over(whole)).alias("gain"),
        F.try_divide(F.sum(cases).over(so_far), F.sum(cases).over(whole)).alias("cumulative_pct_cases"),
    )
    fraction = F.col("cumulative_pct_cases")
    return out.withColumns(
        {
            "lift": F.try_divide(F.col("gain"), fraction),
            "gain_baseline": fraction,
            "lift_baseline": F.try_divide(fraction, fraction),
        }
    )


def fine_gain_lift(scored: DataFrame, fractions=FRACTIONS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Gain and lift at fixed shares of the data; rows of equal score stay together."""
    counts = score_counts(scored)
    size = measure(counts, [BY])
    up = running(counts, [BY], [-F.col("score")], cumsum={"__n": "n"}, rows_per_task=rows_per_task, size=size)
    totals = counts.groupBy(BY).agg(F.sum("n").alias("__all"))
    start = F.try_divide(F.col("__n") - F.col("n"), F.col("__all"))
    group = how_many_reached(fractions, start) + 1
    grouped = (
        up.join(sent(totals, size.groups), BY)
        .withColumn("group", group)
        .groupBy(BY, "group")
        .agg(F.sum("n").alias("cases"), F.sum("pos").alias("responses"), F.min("score").alias("lower_threshold"))
    )
    table = gain_lift(grouped)
    return table.join(grouped.select(BY, "group", "lower_threshold"), [BY, "group"]).select(
        BY,
        "group",
        F.col("cumulative_pct_cases").alias("cumulative_data_fraction"),
        "lower_threshold",
        F.col("gain").alias("cumulative_capture_rate"),
        F.col("lift").alias("cumulative_lift"),
    )


def gain_chart(table: DataFrame) -> DataFrame:
    """Gain and its baseline in long form."""
    return _chart(table, "gain", F.col("cumulative_pct_cases"))


def lift_chart(table: DataFrame) -> DataFrame:
    """Lift and its baseline 1 in long form."""
    return _chart(table, "lift", F.lit(1.0))


def _chart(table: DataFrame, name: str, baseline: Column) -> DataFrame:
    wide = table.select(BY, "group", "cumulative_pct_cases", name, baseline.cast("double").alias("baseline"))
    return lengthen(wide, [BY, "group", "cumulative_pct_cases"], [name, "baseline"])
