"""Joins on group keys that treat missing keys as equal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# One-row-per-group tables are broadcast up to this counted number of groups.
FEW_GROUPS = 10_000


def sent(table: DataFrame, groups: int | None) -> DataFrame:
    """The table of one row per group, to be broadcast if so few groups were counted."""
    return F.broadcast(table) if groups is not None and groups <= FEW_GROUPS else table


def attach(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "left", groups: int | None = None) -> DataFrame:
    """Add the columns of ``right`` to the rows of ``left``; missing keys match each other.

    Without a counted number of ``groups`` (rows of ``right``) there is no
    broadcast hint: the adaptive planner broadcasts ``right`` only if its
    measured size is below the threshold, and splits hot keys otherwise.
    """
    if not by:
        raise ValueError("attach needs at least one key")
    renamed = right.select(
        *[F.col(k).alias(f"__{k}") for k in by], *[c for c in right.columns if c not in by]
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by])
    return left.join(sent(renamed, groups), same, how).drop(*[f"__{k}" for k in by])
