"""Equi joins with the key rules of the analyses: natural keys, differing names, star decode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .keys import attach
from .reshape import found_names


def left_lookup(left: DataFrame, right: DataFrame, on: Sequence[str] | Mapping[str, str] | None = None) -> DataFrame:
    """Left join that keeps the left key columns; missing keys match each other.

    ``on`` is a list of shared names, a mapping ``left name -> right name``, or
    nothing for all shared names.
    """
    if on is None:
        on = [c for c in left.columns if c in right.columns]
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    renamed = right.withColumnsRenamed({r: l for l, r in pairs.items() if l != r})
    return attach(left, renamed, list(pairs))


def lookup_chain(base: DataFrame, tables: Sequence[tuple[DataFrame, Sequence[str] | Mapping[str, str]]]) -> DataFrame:
    """Several left lookups one after another."""
    return reduce(lambda df, step: left_lookup(df, step[0], step[1]), tables, base)


def matching(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on shared names."""
    return left.join(right, list(on), "inner")


def expand_grid(spark: SparkSession, **values: Sequence) -> DataFrame:
    """All combinations of short value lists given by the caller."""
    out = spark.range(1).select()
    for name, items in values.items():
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in items])).alias(name))
    return out


def decode(df: DataFrame, dictionary: DataFrame, keep_code: bool = False) -> DataFrame:
    """Replace codes by labels with a long dictionary ``(column_name, key, value)``.

    All dictionaries are turned into one map per column by one aggregate of
    the dictionary (which lists codes, not data rows), and every column is
    decoded in the same projection: one pass over the data and no join per
    column. Codes without an entry become missing. A dictionary beyond
    ``MAX_DICTIONARY`` entries is data: its columns are decoded by joins.
    """
    rows = (
        dictionary.filter(F.col("key").isNotNull())
        .groupBy("column_name", F.col("key").cast("double").alias("key"))
        .agg(F.min("value").alias("value"))
        .limit(MAX_DICTIONARY + 1)
        .collect()
    )
    if len(rows) > MAX_DICTIONARY:
        return _decode_by_join(df, dictionary, keep_code)
    tables: dict[str, dict[float, str]] = {}
    for r in rows:
        tables.setdefault(r["column_name"], {})[r["key"]] = r["value"]
    decoded = {}
    for name, entries in tables.items():
        if name not in df.columns:
            continue
        pairs = [F.lit(x) for item in sorted(entries.items()) for x in item]
        label = F.try_element_at(F.create_map(*pairs), F.col(name).cast("double"))
        decoded[f"{name}_value" if keep_code else name] = label
    return df.withColumns(decoded)


def _decode_by_join(df: DataFrame, dictionary: DataFrame, keep_code: bool) -> DataFrame:
    entries = dictionary.filter(F.col("key").isNotNull()).groupBy("column_name", F.col("key").cast("double").alias("__key"))
    entries = entries.agg(F.min("value").alias("__label"))
    named = {r[0] for r in dictionary.filter(F.col("column_name").isin(*df.columns)).select("column_name").distinct().collect()}
    out = df
    for name in (c for c in df.columns if c in named):
        own = entries.filter(F.col("column_name") == name).select("__key", "__label")
        out = out.join(own, F.col(name).cast("double") == F.col("__key"), "left")
        out = out.withColumn(f"{name}_value" if keep_code else name, F.col("__label")).drop("__key", "__label")
    return out


# Beyond this many entries a dictionary is data, not metadata.
MAX_DICTIONARY = 10_000


def carry_key(df: DataFrame, key: Sequence[str], *pieces: Sequence[Column | str]) -> list[DataFrame]:
    """Split a table by columns into parts that all keep the row key."""
    return [df.select(*key, *cols) for cols in pieces]


def bind(parts: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Put tables side by side by row key (there are no row positions to rely on)."""
    return reduce(lambda a, b: a.join(b, list(key), "inner"), parts)


REST = "rest"


def split_by(df: DataFrame, name: str, values: Sequence | None = None) -> dict:
    """One filtered frame per listed value, or per value found, and under ``REST`` the rows with any other or no value."""
    if values is None:
        values = [v for v in found_names(df, name) if v is not None]
    listed = F.coalesce(F.col(name).isin(*values), F.lit(False))
    return {v: df.filter(F.col(name) == F.lit(v)) for v in values} | {REST: df.filter(~listed)}


def merge(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
