"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.split import draw


def dataset(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Text table with a header and a declared schema (no inference pass over the data)."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return spark.read.schema(schema).option("header", True).option("mode", mode).csv(path)


def read_sheet(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    schema: T.StructType | None = None,
    header_cell: str | None = None,
) -> DataFrame:
    """Exported spreadsheet page without usable header.

    All cells arrive as text under ``names``. With ``header_cell``, rows above
    and including the header are recognised by content (title rows fill only
    the first cell, the header row starts with ``header_cell``) because a
    distributed reader has no line numbers. ``schema`` casts afterwards; a
    cell that cannot be cast becomes missing.
    """
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.schema(text).option("header", False).csv(path)
    if header_cell is not None:
        first, *others = names
        drop = F.col(first).eqNullSafe(header_cell)
        if others:
            title = F.coalesce(*[F.col(n) for n in others]).isNull()
            drop = drop | title
        df = df.filter(~drop)
    if schema is not None:
        df = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return df


def read_saved(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Saved table (parquet)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def literal_table(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def even_sequence(spark: SparkSession, start: float, stop: float, length: int, name: str = "value") -> DataFrame:
    """``length`` evenly spaced numbers, both ends included."""
    step = (stop - start) / (length - 1) if length > 1 else 0.0
    return spark.range(length).select((F.lit(float(start)) + F.col("id") * F.lit(step)).alias(name))


def expand_steps(start: float, stop: float, length: int) -> list[float]:
    """Evenly spaced numbers for a short parameter list."""
    return [start + i * ((stop - start) / (length - 1)) for i in range(length)]


def uniform_table(spark: SparkSession, n: int, ranges: Mapping[str, tuple[float, float]], seed: int) -> DataFrame:
    """``n`` rows of independent uniform columns.

    Values are draws of the row number, with a salt of its own for every column, so a recomputed partition yields the
    same numbers.
    """
    cells = enumerate(ranges.items())
    return spark.range(n).select(
        *[(draw(F.col("id"), seed + i) * F.lit(float(hi - lo)) + F.lit(float(lo))).alias(name) for i, (name, (lo, hi)) in cells]
    )


def hash_uniform(*cols: Column) -> Column:
    """Uniform number in [0, 1) that depends only on its inputs."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(2**53))


def schema_table(df: DataFrame) -> DataFrame:
    """Column names, types and positions as rows."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "error"
) -> None:
    """Write a result. By default an existing target is an error."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def folder_listing(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder with size and time; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
