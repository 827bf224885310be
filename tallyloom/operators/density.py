"""Densities of numeric columns per class, from counts on a grid.

Every value gives its weight to the two grid points around it, so the rows are read for one aggregate whose size depends on
columns, classes and grid alone. The counts of a class are then convolved with a normal kernel.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import attach
from .profile import one_pass

POINTS = 64


def _spans(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Least and greatest value of every column."""
    wide = one_pass(df, {f"{e}_{n}": f(F.col(n).cast("double")) for n in names for e, f in (("low", F.min), ("high", F.max))}).first()
    return {n: (wide[f"low_{n}"], wide[f"high_{n}"]) for n in names if wide[f"low_{n}"] is not None}


def grid_counts(df: DataFrame, names: Sequence[str], by: str, points: int = POINTS) -> DataFrame:
    """``(by, key, point, weight)``: rows per grid point, shared between the points on both sides of a value."""
    spans = _spans(df, names)
    cells = []
    for n, (low, high) in spans.items():
        step = (high - low) / (points - 1) or 1.0
        at = (F.col(n).cast("double") - F.lit(low)) / F.lit(step)
        base = F.least(F.floor(at), F.lit(points - 2)).cast("int")
        part = at - base
        for point, weight in ((base, 1 - part), (base + 1, part)):
            cells.append(F.struct(F.lit(n).alias("key"), point.alias("point"), weight.alias("weight")))
    if not cells:
        return df.sparkSession.createDataFrame([], f"{by} {df.schema[by].dataType.simpleString()}, key string, point int, weight double")
    long = df.select(by, F.inline(F.array(*cells))).filter(F.col("weight").isNotNull())
    return long.groupBy(by, "key", "point").agg(F.sum("weight").alias("weight"))


def bandwidth(sd: Column, n: Column) -> Column:
    """Normal reference rule; a class without spread gets none."""
    return F.lit(1.06) * F.when(sd > 0, sd) * F.pow(n.cast("double"), F.lit(-0.2))


def class_densities(df: DataFrame, names: Sequence[str], by: str, points: int = POINTS) -> DataFrame:
    """``(by, key, n, bandwidth, x, density)`` on the same grid for all classes of a column.

    Missing values are left out; a missing class is a class of its own. A class of one distinct value has no density.
    """
    spans = _spans(df, names)
    stats = [F.struct(F.lit(n).alias("key"), F.col(n).cast("double").alias("value")) for n in spans]
    counts = grid_counts(df, names, by, points)
    if not stats:
        return counts.select(by, "key", F.lit(0).cast("long").alias("n"), *[F.col("weight").alias(c) for c in ("bandwidth", "x", "density")])
    found = df.select(by, F.inline(F.array(*stats))).filter(F.col("value").isNotNull()).groupBy(by, "key").agg(
        F.count("*").alias("n"), F.stddev_samp("value").alias("__sd"))
    found = found.withColumn("bandwidth", bandwidth(F.col("__sd"), F.col("n"))).filter(F.col("bandwidth").isNotNull()).drop("__sd")
    # One list of at most ``points`` cells per class and column.
    lists = counts.groupBy(by, "key").agg(F.array_sort(F.collect_list(F.struct("point", "weight"))).alias("cells"))
    ends = F.create_map(*[x for n, (low, high) in spans.items() for x in (F.lit(n), F.array(F.lit(float(low)), F.lit(float(high))))])
    met = attach(lists, found, [by, "key"]).filter(F.col("bandwidth").isNotNull())
    low, high = F.element_at(ends, F.col("key"))[0], F.element_at(ends, F.col("key"))[1]
    step = (high - low) / F.lit(points - 1)

    def density(j: Column) -> Column:
        def add(total: Column, cell: Column) -> Column:
            u = (j - cell["point"]) * step / F.col("bandwidth")
            return total + cell["weight"] * F.exp(-u * u / 2)

        return F.aggregate(F.col("cells"), F.lit(0.0), add) / (F.col("n") * F.col("bandwidth") * F.lit((2 * pi) ** 0.5))

    rows = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda j: F.struct((low + j * step).alias("x"), density(j).alias("density")))
    return met.select(by, "key", "n", "bandwidth", F.inline(rows))
