"""Outcome rates per group with cost and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import UNITS, money, needs_cents, turnover_cost
from ..functions.text import join_text
from ..session import kept
from .aggregates import above_baseline, count_by, share_within
from .factors import levels_by
from .keys import attach

# Fixed value: share of leavers taken as the industry average.
INDUSTRY_BASELINE = 0.088


def outcome_kpi(
    df: DataFrame, by: Sequence[str], outcome: str, value: str, baseline: float = INDUSTRY_BASELINE, salary: float = 80000
) -> DataFrame:
    """Per group: number and share of rows with an outcome, flag against a baseline, cost."""
    counts = share_within(count_by(df, *by, outcome), by)
    rated = above_baseline(counts, outcome, [value], baseline)
    return rated.withColumn("cost", turnover_cost(F.col("n"), salary=salary))


def labelled_bars(
    df: DataFrame,
    by: Sequence[str] = (),
    value: str = "cost",
    unit: str = "0",
    reorder: bool = True,
    reverse: bool = False,
) -> DataFrame:
    """Label, value text and bar position for a bar chart.

    Labels join the group columns (the first column when none is given). Cents
    are shown only while all values are small and some has a fraction. With
    ``reorder`` bars are placed by the median value of their label.
    """
    df = kept(df, "bars")  # the bars of a chart, read several times below
    by = list(by) or df.columns[:1]
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    named = df.withColumn("name", join_text(*[F.col(c) for c in by], sep=": "))
    cents = df.agg(needs_cents(F.col(value) / F.lit(UNITS[unit]))).scalar()
    text = F.when(cents, money(F.col(value), 2, unit)).otherwise(money(F.col(value), 0, unit))
    named = named.withColumn("value_text", text)
    if not (reorder or reverse):
        return named
    if reorder:
        levels = levels_by(named, "name", value, "median", descending=reverse, few=True)
    else:
        levels = levels_by(named.withColumn("__zero", F.lit(0.0)), "name", "__zero", "max")
        last = levels.agg(F.max("code")).scalar()
        levels = levels.withColumn("code", last + 1 - F.col("code"))
    placed = levels.select(F.col("level").alias("name"), F.col("code").cast("int").alias("bar"))
    return attach(named, placed, ["name"])
