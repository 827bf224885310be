"""Straight lines, least squares, intervals."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.steps import how_many_reached
from ..sources.tables import hash_uniform
from .factors import level_lists
from .gram import Line, least_squares, ridge, t_quantile, t_tail
from .ordering import average_rank
from .partials import reduced
from .profile import correlation
from .recipe import dummy_name


def line(intercept, slope, x: Column) -> Column:
    return intercept + slope * x


def line_distance(df: DataFrame, x: str, y: str, intercept: float, slope: float) -> DataFrame:
    """Root mean square distance between a line and the points."""
    gap = F.col(y) - line(F.lit(float(intercept)), F.lit(float(slope)), F.col(x))
    return df.agg(F.sqrt(F.avg(gap * gap)).alias("distance"))


def line_search(df: DataFrame, x: str, y: str, candidates: DataFrame) -> DataFrame:
    """Distance of every candidate line ``(a1, a2)`` to the points.

    The mean squared distance of a line is a quadratic function of its two
    parameters, so five moments of the points give the distance of any number
    of candidates: points and candidates are never multiplied out.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    u, v = F.col(x).cast("double"), F.col(y).cast("double")
    moments = df.filter(both).agg(
        F.struct(
            F.avg(u).alias("mx"), F.avg(v).alias("my"), F.var_pop(u).alias("vx"), F.var_pop(v).alias("vy"),
            F.covar_pop(u, v).alias("c"),
        ).alias("m")
    )
    m = moments.scalar()
    a1, a2 = F.col("a1"), F.col("a2")
    shift = m["my"] - a1 - a2 * m["mx"]
    square = m["vy"] - 2 * a2 * m["c"] + a2 * a2 * m["vx"] + shift * shift
    return candidates.withColumn("dist", F.sqrt(F.greatest(square, F.lit(0.0))))


def best_by_rank(df: DataFrame, value: str, n: int = 10) -> DataFrame:
    """Rows whose average rank is at most ``n`` (ties share the mean rank)."""
    return average_rank(df, [], value, "rank").filter(F.col("rank") <= n)


def simple_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per group (or over all rows): the optimum of the same distance."""
    u, v = F.col(x).cast("double"), F.col(y).cast("double")
    return df.groupBy(*by).agg(
        F.regr_intercept(v, u).alias("intercept"),
        F.regr_slope(v, u).alias("slope"),
        F.regr_r2(v, u).alias("r2"),
        F.regr_count(v, u).alias("n"),
    )


def interaction(df: DataFrame, number: str, category: str, levels: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Columns of ``number * category``: the number, level dummies, and their products."""
    levels = list(levels) if levels is not None else level_lists(df, [category])[category]
    names = [number]
    for level in levels[1:]:
        name = dummy_name(category, level)
        hit = (F.col(category) == level).cast("double")
        df = df.withColumns({name: hit, f"{number}_x_{name}": hit * F.col(number)})
        names += [name, f"{number}_x_{name}"]
    return df, names


def coefficient_table(spark: SparkSession, fit: Line) -> DataFrame:
    """Terms with estimate, standard error, t and p, smallest p first."""
    rows = []
    for name, b, se in zip(fit.names, fit.coefficients, fit.errors):
        t = float(b / se) if se > 0 else float("nan")
        rows.append((name, float(b), float(se), t, t_tail(t, fit.dof)))
    table = spark.createDataFrame(
        rows, "term string, estimate double, std_error double, statistic double, p_value double"
    )
    return table.orderBy(F.asc_nulls_last("p_value"), "term")


def _design(fit: Line) -> list[Column]:
    return [F.lit(1.0), *[F.col(n).cast("double") for n in fit.names[1:]]]


def predict(df: DataFrame, fit: Line, name: str = "pred") -> DataFrame:
    """Point predictions as one column expression."""
    parts = [F.lit(float(b)) * x for b, x in zip(fit.coefficients, _design(fit))]
    return df.withColumn(name, sum(parts[1:], parts[0]))


def predict_interval(df: DataFrame, fit: Line, level: float = 0.95) -> DataFrame:
    """Prediction with the confidence interval of the mean."""
    x = _design(fit)
    spread = F.lit(0.0)
    for i in range(len(x)):
        for j in range(i, len(x)):
            factor = float(fit.inverse[i, j]) * (1.0 if i == j else 2.0)
            spread = spread + F.lit(factor) * x[i] * x[j]
    half = F.lit(t_quantile(level, fit.dof)) * F.sqrt(F.greatest(spread, F.lit(0.0)) * F.lit(float(fit.sigma2)))
    out = predict(df, fit)
    return out.withColumns({"pred_lower": F.col("pred") - half, "pred_upper": F.col("pred") + half})


# Cumulative Poisson(1) probabilities for counts 0..7.
_POISSON = tuple(float(v) for v in np.cumsum(np.exp(-1) / np.array([1, 1, 2, 6, 24, 120, 720, 5040])))


def poisson_weight(*seed: Column) -> Column:
    """Poisson(1) count that depends only on its inputs."""
    u = hash_uniform(*seed)
    return how_many_reached(_POISSON, u).cast("double")


def drawn_counts(h: np.ndarray, replicates: int, seed: int) -> np.ndarray:
    """Table replicates x rows of ``poisson_weight(key, replicate, seed)``; ``h`` is the hash of the keys."""
    out = hashed_int(hashed_int(h[None, :], np.arange(1, replicates + 1)[:, None]), np.array([[seed]]))
    u = (out >> np.uint64(11)) * 2.0**-53
    return sum((u >= c).astype(np.float64) for c in _POISSON)


def hashed_int(seed: np.ndarray, value: np.ndarray) -> np.ndarray:
    """xxHash64 of 32-bit whole numbers, as Spark's ``xxhash64`` goes on with a further int column."""
    # The primes of xxHash64.
    p1, p2, p3, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    h = (seed + p5 + np.uint64(4)) ^ ((value.astype(np.uint64) & np.uint64(0xFFFFFFFF)) * p1)
    h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * p2 + p3
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def bootstrap_interval(
    df: DataFrame, key: str, names: Sequence[str], target: str, points: DataFrame, replicates: int = 200,
    level: float = 0.95, seed: int = 1,
) -> DataFrame:
    """Interval of the mean prediction at some points by the Poisson bootstrap.

    Each replicate weights the rows by a count drawn from the row key. A batch
    multiplies its table of replicates x row weights with the products of every
    row, so a row is read once and a task hands on one small matrix per
    replicate. ``points`` is a short table of new rows.
    """
    names = list(names)
    width = len(names) + 1
    cells = [F.col(n).cast("double") for n in (*names, target)]
    data = df.select(key, *names, target).na.drop().select(F.xxhash64(key).alias("h"), F.array(F.lit(1.0), *cells).alias("x"))

    def products(batches):
        total = np.zeros((replicates, (width + 1) ** 2))
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)
            h = np.asarray(batch.column("h")).view(np.uint64)
            step = max(1, (1 << 21) // max(replicates, (width + 1) ** 2))
            for at in range(0, len(x), step):
                some = x[at : at + step]
                square = (some[:, :, None] * some[:, None, :]).reshape(len(some), -1)
                total += drawn_counts(h[at : at + step], replicates, seed) @ square
        return total

    # replicates x coefficients: a fixed small number of values, whatever the data
    sums = reduced(data, replicates * (width + 1) ** 2, products).reshape(replicates, width + 1, width + 1)
    betas = [ridge(s[:width, :width], s[:width, width], s[width, width], 0.0)[0].tolist() for s in sums]
    design = [F.lit(1.0), *[F.col(n).cast("double") for n in names]]
    draws = []
    for b in betas:
        parts = [F.lit(float(v)) * x for v, x in zip(b, design)]
        draws.append(sum(parts[1:], parts[0]))
    sorted_draws = F.array_sort(F.array(*draws))
    low = max(0, int(round((1 - level) / 2 * (len(betas) - 1))))
    high = len(betas) - 1 - low
    mean = F.aggregate(F.array(*draws), F.lit(0.0), lambda a, v: a + v) / F.lit(float(len(betas)))
    return points.withColumns(
        {"pred": mean, "pred_lower": F.get(sorted_draws, F.lit(low)), "pred_upper": F.get(sorted_draws, F.lit(high))}
    )


def regression_metrics(df: DataFrame, truth: str, estimate: str, by: Sequence[str] = ()) -> DataFrame:
    """rmse, rsq (squared correlation) and mae in long form, over rows where both are present."""
    both = df.filter(F.col(truth).isNotNull() & F.col(estimate).isNotNull())
    y, p = F.col(truth).cast("double"), F.col(estimate).cast("double")
    r = correlation(y, p)
    wide = both.groupBy(*by).agg(
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"), (r * r).alias("rsq"), F.avg(F.abs(y - p)).alias("mae")
    )
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("estimate")) for m in ("rmse", "rsq", "mae")]
    return wide.select(*by, F.inline(F.array(*cells)))


__all__ = [
    "Line", "best_by_rank", "bootstrap_interval", "coefficient_table", "interaction", "least_squares", "line",
    "line_distance", "line_search", "poisson_weight", "predict", "predict_interval", "regression_metrics", "simple_fit",
]
