"""Helpers shared by the corpus operators: scratch tables, row keys, packed exchanges and distributed ranks.

Packed exchange: numpy work needs many small records in one task. Sent as rows, each would cost some 40 bytes; here
a task groups its records by target partition and sends one binary value per target. A partition holds the records of
a bounded share of the input (the number of partitions follows the input), so its task works in bounded memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: Input bytes whose records one partition of a packed exchange receives.
PART_BYTES = 32 << 20
#: Fewest partitions of a packed exchange.
LEAST_PARTS = 12


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes to the shared scratch folder and reads back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(total: int) -> int:
    return max(LEAST_PARTS, -(-int(total or 0) // PART_BYTES))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The rows with a column ``__key`` (long), unique and in the order of the ids, and the bytes of all texts.

    Where ids are unique and not null the key is the id. Else rows that share an id are separate documents in the
    order of their texts, rows without id come last, and the keys are row numbers of that order, kept in a table.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(F.col(text_col).cast("string")).alias("size"))
    seen = narrow.groupBy("id").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    total, doubtful = seen.agg(F.sum("bytes"), F.max(F.when((F.col("n") > 1) | F.col("id").isNull(), 1).otherwise(0))).first()
    total = int(total or 0)
    if not doubtful:
        return docs.withColumn("__key", F.col(id_col).cast("long")), total
    order = [F.col(id_col).asc_nulls_last(), F.col(text_col).asc_nulls_first()]
    ordered = docs.repartitionByRange(parts_for(total), *order).sortWithinPartitions(*order)
    return stored(ordered.withColumn("__key", F.monotonically_increasing_id()), "keyed"), total


def identified(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(key, id, text) by ``keyed``, and the bytes of all texts."""
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows, total = keyed(narrow, "id", "text")
    return rows.select(F.col("__key").alias("key"), "id", "text"), total


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array and the n + 1 borders of its values; nulls are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    borders = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[borders[0] : borders[-1]], borders - borders[0]


def sizes_of(column: pa.Array) -> np.ndarray:
    """Bytes of every value of a string column; 0 for nulls."""
    return np.diff(texts_of(column)[1])


def in_key_order(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of a batch by ascending key, so that the first of equal records is the earliest."""
    keys = np.asarray(batch.column("key"))
    if len(keys) > 1 and (np.diff(keys) < 0).any():
        return batch.take(pa.array(np.argsort(keys, kind="stable")))
    return batch


def planes(values: np.ndarray, width: int | None = None) -> bytes:
    """Bytes of an array, equal byte places together, so that the compressor of the shuffle finds the zeros."""
    if len(values) == 0:
        return b""
    table = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return np.ascontiguousarray(table[:, :width].T).tobytes()


def unplanes(data: memoryview, at: int, n: int, dtype, width: int | None = None) -> tuple[np.ndarray, int]:
    dtype = np.dtype(dtype)
    width = width or dtype.itemsize
    table = np.zeros((n, dtype.itemsize), np.uint8)
    table[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T
    return table.reshape(-1).view(dtype), at + n * width


def pack(keys: np.ndarray, places: np.ndarray, *others: tuple[np.ndarray, int | None]) -> bytes:
    """Records in the order of (key, place), as differences, and further columns with their width in bytes."""
    n = len(keys)
    same = np.zeros(n, bool)
    same[1:] = keys[1:] == keys[:-1]
    steps = np.diff(keys, prepend=np.int64(0))
    moves = places - np.where(same, np.concatenate([[0], places[:-1]]), 0)
    head = np.array([n], np.int64).tobytes()
    return head + planes(steps.astype(np.int64)) + planes(moves.astype(np.int64)) + b"".join(planes(c, w) for c, w in others)


def unpack(data: bytes, *kinds: tuple[str, int | None]) -> list[np.ndarray]:
    """Inverse of ``pack``: keys, places and the further columns of the given (dtype, width)."""
    n = int(np.frombuffer(data, np.int64, 1)[0])
    steps, at = unplanes(data, 8, n, np.int64)
    moves, at = unplanes(data, at, n, np.int64)
    keys, sums = np.cumsum(steps), np.cumsum(moves)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if n else np.zeros(0, np.int64)
    base = np.concatenate([[0], sums])[starts]
    places = sums - np.repeat(base, np.diff(np.append(starts, n)))
    out = [keys, places]
    for dtype, width in kinds:
        column, at = unplanes(data, at, n, dtype, width)
        out.append(column)
    return out


def by_part(part: np.ndarray, n_parts: int):
    """(part, indices in their order) for every part that has records."""
    order = np.argsort(part, kind="stable")
    borders = np.searchsorted(part[order], np.arange(n_parts + 1))
    for p in np.flatnonzero(np.diff(borders)):
        yield int(p), order[borders[p] : borders[p + 1]]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values over all their bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def folded(*columns: np.ndarray, seed: int = 0) -> np.ndarray:
    """One hash of several 64-bit columns."""
    out = np.full(len(columns[0]), seed, np.uint64)
    for c in columns:
        out = mixed(out * np.uint64(0x94D049BB133111EB) + c)
    return out


def first_of_equal(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For records in order: a group number per record, and whether it is the first of its equal ones."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        sorted_c = c[order]
        new[1:] |= sorted_c[1:] != sorted_c[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    first = np.zeros(len(order), bool)
    first[order[new]] = True  # lexsort is stable, so this is the earliest record of the group
    return group, first


def ranked(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group, without a task that holds a whole group.

    Rows are dealt into about sqrt(rows) ranges of the leading order column, which must be a lowercase hex text that
    is spread evenly. Sums of ranges give the start of each range, a window inside each range does the rest. Neither
    the rows of a range nor the ranges of a group exceed a small multiple of sqrt(rows), however hot the group is.
    """
    rows = df.count()
    digits = max(1, min(7, round(np.log(max(rows, 1)) / np.log(16) / 2)))
    cut = df.withColumn("__range", F.substring(order[0], 1, digits))
    sums = cut.groupBy(*group, "__range").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__range").alias("__r"),
                         F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*group, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = cut.withColumn("__within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = F.col("__range") == F.col("__r")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    joined = within.join(starts, same)
    return joined.withColumn(out, F.col("__start") + F.col("__within")).drop(
        "__range", "__r", "__start", "__within", *[f"__g{i}" for i in range(len(group))]
    )


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
