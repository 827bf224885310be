"""Conditionals and aggregates with explicit rules for missing values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def if_else(condition: Column, yes, no) -> Column:
    """Two-way choice; a missing condition gives a missing result, not the else branch."""
    return F.when(condition.isNull(), F.lit(None)).when(condition, yes).otherwise(no)


def case_when(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """First true branch wins; a missing condition counts as false."""
    (first, value), *rest = branches
    out = F.when(first, value)
    for condition, value in rest:
        out = out.when(condition, value)
    return out.otherwise(default)


def is_in(col: Column, values: Iterable) -> Column:
    """Membership that is never missing, so it can be negated safely."""
    values = list(values)
    present = [v for v in values if v is not None]
    test = F.coalesce(col.isin(present), F.lit(False)) if present else F.lit(False)
    return (test | col.isNull()) if len(present) < len(values) else test


def strict(aggregate: Column, col: Column) -> Column:
    """Aggregate that becomes missing as soon as one input is missing.

    Spark aggregates skip missing values; wrap them with this where one missing
    input must spoil the result.
    """
    return F.when(F.count(F.lit(1)) == F.count(col), aggregate)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields a missing value for a zero divisor (ANSI mode raises)."""
    return F.try_divide(top, bottom)


def half_even(col: Column, digits: int = 0) -> Column:
    """Rounding with ties to the even digit."""
    return F.bround(col, digits)
