"""Categories with an ordered list of levels.

A levels table has the columns ``level`` and ``code`` (from 1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import attach
from .ordering import running
from .quantiles import quantiles

# More levels than this cannot become columns; such a column is an identifier.
MAX_LEVELS = 2000


def levels_sorted(df: DataFrame, name: str) -> DataFrame:
    """Levels in text order."""
    values = df.filter(F.col(name).isNotNull()).select(F.col(name).alias("level")).distinct()
    return _coded(values, ["level"])


def levels_first_seen(df: DataFrame, name: str, position: str) -> DataFrame:
    """Levels in the order in which they first appear by a row position."""
    values = (
        df.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("level")).agg(F.min(position).alias("__at"))
    )
    return _coded(values, ["__at", "level"])


def levels_by(
    df: DataFrame, name: str, value: str, stat: str = "median", descending: bool = False, few: bool = False
) -> DataFrame:
    """Levels ordered by a statistic of another column: median, max or mean.

    ``few`` says that the rows are few by their meaning, such as the bars of a chart.
    """
    kept = df.filter(F.col(name).isNotNull()).withColumnRenamed(name, "level")
    if stat == "median" and few:
        found = kept.groupBy("level").agg(F.percentile(F.col(value).cast("double"), F.lit(0.5)).alias("__s"))
    elif stat == "median":
        found = quantiles(kept, [value], [0.5], ["level"]).select("level", F.col("value").alias("__s"))
    elif stat in ("max", "mean"):
        agg = {"max": F.max, "mean": F.avg}[stat](value)
        found = kept.groupBy("level").agg(agg.cast("double").alias("__s"))
    else:
        raise ValueError(f"unknown statistic {stat!r}")
    return _coded(found, [-F.col("__s") if descending else F.col("__s"), "level"], keep=["__s"]).withColumnRenamed(
        "__s", stat
    )


def reverse(levels: DataFrame) -> DataFrame:
    last = levels.agg(F.max("code")).scalar()
    return levels.withColumn("code", (last + 1 - F.col("code")).cast("int"))


def relevel(levels: DataFrame, first: Sequence[str]) -> DataFrame:
    """Named levels to the front in the given order, the others keep their order."""
    front = F.array_position(F.array(*[F.lit(v) for v in first]), F.col("level"))
    key = F.when(front > 0, front - F.lit(len(first) + 1)).otherwise(F.lit(0))
    ordered = levels.select("level", key.alias("__k"), F.col("code").alias("__c"))
    return _coded(ordered, ["__k", "__c"])


def codes(df: DataFrame, name: str, levels: DataFrame, out: str | None = None) -> DataFrame:
    """Replace (or add) a category by its 1-based code; unknown levels become missing."""
    out = out or name
    keyed = levels.select(F.col("level").alias(name), F.col("code").alias("__code"))
    joined = attach(df, keyed, [name])
    return joined.withColumn(out, F.col("__code")).drop("__code")


def level_lists(df: DataFrame, names: Sequence[str], limit: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted levels of several columns on the driver, for work that makes columns out of levels.

    An approximate distinct count (one pass, nothing shuffled but sketches)
    rejects columns with far too many levels before their values are gathered;
    the exact check follows on what was gathered.
    """
    names = list(names)
    if not names:
        return {}
    sizes = df.agg(*[F.approx_count_distinct(F.col(n).cast("string")).alias(n) for n in names]).first().asDict()
    wide = [n for n in names if sizes[n] > 1.25 * limit]
    out = {n: [] for n in names}
    if not wide:
        cells = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).cast("string").alias("value")) for n in names])
        for r in df.select(F.inline(cells)).filter(F.col("value").isNotNull()).distinct().collect():
            out[r["key"]].append(r["value"])
        wide = [n for n in names if len(out[n]) > limit]
    if wide:
        raise ValueError(f"too many levels (over {limit}) in {wide}")
    return {n: sorted(v) for n, v in out.items()}


def many_levels(df: DataFrame, names: Sequence[str], limit: int | None = None) -> list[str]:
    """Columns with about so many levels that their codes are joined and not written into the plan."""
    if not names:
        return []
    sizes = df.agg(*[F.approx_count_distinct(F.col(n).cast("string")).alias(n) for n in names]).first().asDict()
    return [n for n in names if sizes[n] > 0.8 * (limit or MAX_LEVELS)]


def code_of(col: Column, levels: Sequence[str]) -> Column:
    """1-based code by a known level list, inside one projection."""
    at = F.array_position(F.array(*[F.lit(v) for v in levels]), col)
    return F.when(at > 0, at.cast("double"))


def _coded(values: DataFrame, order: Sequence, keep: Sequence[str] = ()) -> DataFrame:
    placed = running(values, [], order, row_number="__n")
    return placed.select("level", F.col("__n").cast("int").alias("code"), *keep)
