"""Choosing, ordering and renaming columns. Pure schema work: no job is run."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def between(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in column order."""
    cols = df.columns
    return cols[cols.index(first) : cols.index(last) + 1]


def containing(df: DataFrame, text: str) -> list[str]:
    """Names that contain a text, ignoring case."""
    return [c for c in df.columns if text.lower() in c.lower()]


def numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def textual(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def excluding(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Names of the frame that are not in ``names``, in column order."""
    gone = set(names)
    return [c for c in df.columns if c not in gone]


def move_first(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names, *excluding(df, names))


def sort_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """New names by old name; unknown old names are an error."""
    unknown = set(names) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.withColumnsRenamed(dict(names))


def rename_by_pattern(df: DataFrame, pattern: str, by: str) -> DataFrame:
    """Replace a pattern in every name; two columns must not end up with one name."""
    names = [re.sub(pattern, by, c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"renaming makes duplicates: {names}")
    return df.toDF(*names)


def safe_names(df: DataFrame) -> DataFrame:
    """Spaces and dashes in names become underscores."""
    return rename_by_pattern(df, "[ -]", "_")


def over(df: DataFrame, names: Sequence[str], change: Callable[[Column], Column]) -> DataFrame:
    """Same expression over many columns, in place."""
    return df.withColumns({n: change(F.col(n)) for n in names})
