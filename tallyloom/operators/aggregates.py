"""Counts, shares and grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import case_when, is_in
from .keys import attach
from .ordering import ROWS_PER_TASK, running


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per combination of keys; missing keys form a group of their own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str], **sums: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def count_if(condition: Column) -> Column:
    """Number of rows for which a condition is true."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def range_by(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Smallest and largest measure per group, labelled with the measure's name."""
    out = df.groupBy(*keys).agg(F.min(measure).alias("min"), F.max(measure).alias("max"))
    return out.withColumn("measure_var", F.lit(measure)).withColumn(measure, F.lit("test"))


def share_within(
    df: DataFrame, by: Sequence[str] = (), value: str = "n", name: str = "share", few: bool = False
) -> DataFrame:
    """Value divided by the total of its group, or by the grand total without keys.

    Totals come from their own partial aggregate and are joined back, so a
    group with very many rows is never gathered in one task. ``few`` says that
    the rows are few by their meaning, such as one per outcome: then they are
    made once and the grand total is taken in one task.
    """
    if not by and few:
        total = F.sum(value).over(Window.partitionBy())
        return df.withColumn(name, F.try_divide(F.col(value).cast("double"), total.cast("double")))
    if not by:
        total = df.agg(F.sum(value)).scalar()
        return df.withColumn(name, F.try_divide(F.col(value).cast("double"), total.cast("double")))
    totals = df.groupBy(*by).agg(F.sum(value).alias("__total"))
    joined = attach(df, totals, by)
    share = F.try_divide(F.col(value).cast("double"), F.col("__total").cast("double"))
    return joined.withColumn(name, share).drop("__total")


def cumulative_share(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    tie_break: Sequence[str],
    name: str = "cumulative",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Running total of a value from largest to smallest within each group."""
    return running(df, by, [-F.col(value), *tie_break], cumsum={name: value}, rows_per_task=rows_per_task)


def above_baseline(
    df: DataFrame, name: str, values: Sequence, baseline: float, share: str = "share", flag: str = "above_baseline"
) -> DataFrame:
    """Keep the rows with the given outcome and mark shares above a baseline with Yes/No."""
    kept = df.filter(is_in(F.col(name), values))
    return kept.withColumn(flag, case_when([(F.col(share) > baseline, "Yes")], "No"))
