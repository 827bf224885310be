"""Long and wide forms, feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import attach
from .ordering import running


#: Most columns that a wide table gets from the data.
MOST_COLUMNS = 5000


def found_names(df: DataFrame, name: str) -> list:
    """Distinct values in order, a missing one last."""
    found = df.select(name).distinct().limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"over {MOST_COLUMNS} distinct values in {name}; a table cannot have a column for each")
    return sorted((r[0] for r in found), key=lambda v: (v is None, v or 0))


def widen(
    df: DataFrame, ids: Sequence[str], names_from: str, values_from: str, values: Sequence | None = None, fill=None, missing: str = "NA"
) -> DataFrame:
    """One column per listed value, or per value found; that of a missing value is named ``missing``.

    ``fill`` replaces absent cells only, not stored missing ones.
    """
    if values is None:
        df = df.withColumn(names_from, F.coalesce(F.col(names_from).cast("string"), F.lit(missing)))
        values = found_names(df, names_from)
    cell = F.first(F.struct(F.col(values_from).alias("v")))
    wide = df.groupBy(*ids).pivot(names_from, list(values)).agg(cell)
    picked = []
    for v in values:
        at = F.col(f"`{v}`")
        picked.append(F.when(at.isNull(), F.lit(fill)).otherwise(at["v"]).alias(str(v)))
    return wide.select(*ids, *picked)


def lengthen(
    df: DataFrame, ids: Sequence[str], names: Sequence[str], key: str = "key", value: str = "value",
    cast: str | None = None, position: str | None = None,
) -> DataFrame:
    """One row per listed column; ``position`` keeps the column order as a number."""
    cells = []
    for i, n in enumerate(names):
        col = F.col(n).cast(cast) if cast else F.col(n)
        parts = [F.lit(n).alias(key), col.alias(value)]
        if position:
            parts.append(F.lit(i).alias(position))
        cells.append(F.struct(*parts))
    return df.select(*ids, F.inline(F.array(*cells)))


def nest(df: DataFrame, ids: Sequence[str], cells: dict[str, str], key: str, value: str, out: str) -> DataFrame:
    """Several columns of a row as one nested table of ``(key, value)`` rows."""
    packed = [F.struct(F.lit(k).alias(key), F.col(c).cast("double").alias(value)) for k, c in cells.items()]
    return df.select(*ids, F.array(*packed).alias(out))


def unnest(df: DataFrame, name: str) -> DataFrame:
    """Array of structs back to rows."""
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.inline(name))


def assemble(df: DataFrame, names: Sequence[str], out: str = "features") -> DataFrame:
    """Vector column of numeric columns."""
    return VectorAssembler(inputCols=list(names), outputCol=out, handleInvalid="error").transform(df)


def array_vectors(df: DataFrame, name: str, out: str = "features") -> DataFrame:
    """Vector column from an array column."""
    return df.withColumn(out, array_to_vector(F.col(name).cast("array<double>")))


def item_positions(df: DataFrame, item: str) -> DataFrame:
    """Consecutive position from 0 for every distinct item."""
    items = df.select(item).filter(F.col(item).isNotNull()).distinct()
    placed = running(items, [], [item], row_number="__n")
    return placed.select(item, (F.col("__n") - 1).cast("int").alias("position"))


def user_item_vectors(df: DataFrame, user: str, item: str, value: str, out: str = "features") -> tuple[DataFrame, int]:
    """One sparse vector per user over all items; absent items, and those whose values are all missing, count as 0.

    The long table is summed per (user, item) first, so what is gathered per
    user is at most one entry per distinct item, never raw rows. Returns the
    vectors and the number of items.
    """
    cells = df.filter(F.col(item).isNotNull()).groupBy(user, item).agg(F.sum(value).alias("__v"))
    places = item_positions(df, item)
    width = places.count()
    # A missing sum has no place among the numbers of a vector; its user stays.
    entry = F.when(F.col("__v").isNotNull(), F.struct("position", F.col("__v").cast("double").alias("v")))
    lists = attach(cells, places, [item]).groupBy(user).agg(F.array_sort(F.collect_list(entry)).alias("__e"))
    build = _sparse_vector(width)
    vectors = lists.select(user, build(F.col("__e.position"), F.col("__e.v")).alias(out))
    return vectors, width


def _sparse_vector(width: int):
    """Spark has no built-in for this change of representation; the arrays are handed on as they are, batch by batch."""

    @F.arrow_udf(VectorUDT())
    def build(index: pa.Array, values: pa.Array) -> pa.Array:
        n = len(index)
        return pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, width, np.int32)), index, values], ["type", "size", "indices", "values"])

    return build
