"""Reproducible random splits.

The draw of a row is a function of its key and a salt, so the split does not
depend on partitioning, is the same after a task is run again, and needs no
shuffle. Exact sizes are available at the price of one ordering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import attach
from .ordering import ROWS_PER_TASK, running

# Multiplier and modulus of a 32-bit integer mixing hash, and the step between salts.
_MULTIPLIER = 73244475
_MODULUS = 4294967296
_SALT_STEP = 1000003


def _mixed(h: Column) -> Column:
    return F.pmod(h.bitwiseXOR(F.shiftright(h, 16)) * F.lit(_MULTIPLIER), F.lit(_MODULUS))


def draw(key: Column, salt: int = 0) -> Column:
    """Number in [0, 1) from an integer key; different salts give unrelated numbers.

    Two rounds of xor-shift and multiplication: plain multiplication would make
    the draws of two salts differ by a constant, and a second split would then
    depend on the first.
    """
    key = key.cast("long")
    h = F.pmod(key.bitwiseXOR(F.shiftright(key, 32)), F.lit(_MODULUS)) + F.lit(salt * _SALT_STEP)
    h = _mixed(_mixed(F.pmod(h, F.lit(_MODULUS))))
    return h.bitwiseXOR(F.shiftright(h, 16)) / F.lit(float(_MODULUS))


def draw_sql(key: str, salt: int = 0) -> str:
    """The same draw in SQL with ``xor`` and ``>>``."""
    h = f"((xor({key}, {key} >> 32) % {_MODULUS} + {salt * _SALT_STEP}) % {_MODULUS})"
    for _ in range(2):
        h = f"((xor({h}, {h} >> 16) * {_MULTIPLIER}) % {_MODULUS})"
    return f"CAST(xor({h}, {h} >> 16) / {_MODULUS}.0 AS DOUBLE)"


def split(df: DataFrame, key: str, prop: float, salt: int = 0, name: str = "split", parts=("train", "test")) -> DataFrame:
    """Mark rows as train or test; sizes are close to the proportion."""
    first, second = parts
    return df.withColumn(name, F.when(draw(F.col(key), salt) < prop, first).otherwise(second))


def parts(df: DataFrame, key: str, prop: float, salt: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train and test frames."""
    test = draw(F.col(key), salt) < prop
    return df.filter(test), df.filter(~test)


def split_exact(
    df: DataFrame, key: str, prop: float, by: Sequence[str] = (), salt: int = 0, name: str = "split",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Exactly ``floor(prop * rows)`` train rows, overall or within every stratum."""
    by = list(by)
    drawn = df.withColumn("__draw", draw(F.col(key), salt))
    placed = running(drawn, by, ["__draw", key], row_number="__pos", rows_per_task=rows_per_task)
    if by:
        counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
        placed = attach(placed, counts, by)
    else:
        placed = placed.withColumn("__n", df.agg(F.count(F.lit(1))).scalar())
    train = F.col("__pos") <= F.floor(F.col("__n") * F.lit(float(prop)))
    return placed.withColumn(name, F.when(train, "train").otherwise("test")).drop("__draw", "__pos", "__n")


def strata_coverage(df: DataFrame, stratum: str, name: str = "split") -> DataFrame:
    """For every stratum: does it occur in both parts?"""
    found = df.groupBy(stratum).agg(F.count_distinct(F.col(name)).alias("n_parts"))
    return found.withColumn("in_both", F.col("n_parts") == 2)


def folds(df: DataFrame, key: str, k: int = 5, salt: int = 0, name: str = "fold") -> DataFrame:
    """Fold number 0..k-1 per row."""
    return df.withColumn(name, F.floor(draw(F.col(key), salt) * F.lit(k)).cast("int"))
