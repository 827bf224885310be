"""Row filters, missing values, positions and distinct values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import columns
from .ordering import ROWS_PER_TASK, running


def is_complete(df: DataFrame, names: Sequence[str] | None = None) -> Column:
    """Whether a row has no missing value; not-a-number counts as missing."""
    wanted = [f for f in df.schema.fields if not names or f.name in names]
    cells = [F.col(f"`{f.name}`").isNotNull() for f in wanted]
    cells += [~F.isnan(f"`{f.name}`") for f in wanted if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return reduce(lambda a, b: a & b, cells, F.lit(True))


def complete_cases(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows without missing values."""
    return df.filter(is_complete(df, names))


def fill_numbers(df: DataFrame, value: float = 0, names: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(value, list(names) if names else None)


def fill_everything(df: DataFrame, value: int = -1, names: Sequence[str] | None = None) -> DataFrame:
    """Every missing cell becomes ``value``; text columns receive it as text."""
    names = list(names) if names else None
    return df.na.fill(value, names).na.fill(str(value), names)


def carry_down(
    df: DataFrame, name: str, order: Sequence[Column | str], by: Sequence[str] = (), rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Fill missing cells with the last non-missing value above them."""
    filled = running(df, by, order, carry={"__carried": name}, rows_per_task=rows_per_task)
    return filled.withColumn(name, F.col("__carried")).drop("__carried")


def numbered(
    df: DataFrame, order: Sequence[Column | str], name: str = "row", by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Consecutive row numbers from 1 in a stated order."""
    return running(df, by, order, row_number=name, rows_per_task=rows_per_task)


def row_at(df: DataFrame, order: Sequence[Column | str], position: int) -> DataFrame:
    """The row at a position (from 1) of the stated order."""
    return df.orderBy(*order).offset(position - 1).limit(1)


def top(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of the stated order; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def top_within(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """First ``n`` rows of every group."""
    placed = running(df, by, order, row_number="__pos", rows_per_task=rows_per_task)
    return placed.filter(F.col("__pos") <= n).drop("__pos")


def values_long(df: DataFrame, names: Sequence[str], cast: str = "string") -> DataFrame:
    """Long form ``(key, value)`` of some columns, nothing else kept."""
    cells = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).cast(cast).alias("value")) for n in names])
    return df.select(F.inline(cells))


def distinct_texts(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """All distinct values of every text column as rows."""
    return values_long(df, names or columns.textual(df)).distinct()
