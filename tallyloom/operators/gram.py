"""Weighted cross-product sums, and the small linear solves made from them.

All sums are built-in aggregates with map-side partials: one row per group
reaches the solver, whatever the number of data rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cross_sums(names: Sequence[str], target: str, weight: Column | None = None) -> list[Column]:
    """Aggregates: ``xx`` (upper triangle), ``xy``, ``yy``, ``n``, with an intercept as first feature."""
    w = weight if weight is not None else F.lit(1.0)
    x = [F.lit(1.0), *[F.col(n).cast("double") for n in names]]
    y = F.col(target).cast("double")
    xx = [F.sum(w * x[i] * x[j]) for i in range(len(x)) for j in range(i, len(x))]
    return [
        F.array(*xx).alias("xx"),
        F.array(*[F.sum(w * a * y) for a in x]).alias("xy"),
        F.sum(w * y * y).alias("yy"),
        F.sum(w).alias("w"),
        F.count(F.lit(1)).alias("n"),
    ]


def unpack(row_xx: Sequence[float], width: int) -> np.ndarray:
    """Full symmetric matrix from its upper triangle."""
    full = np.zeros((width, width))
    full[np.triu_indices(width)] = row_xx
    return full + np.triu(full, 1).T


def independent(matrix: np.ndarray, tolerance: float = 1e-9) -> list[int]:
    """Positions of columns that are not linear combinations of earlier ones.

    One Cholesky factorisation for all columns: a column that is kept is taken out of the later ones, so the
    diagonal holds what the kept columns do not explain.
    """
    rest = np.array(matrix, float)
    keep: list[int] = []
    for i in range(len(rest)):
        if rest[i, i] > tolerance * matrix[i, i] and matrix[i, i] > 0:
            keep.append(i)
            row = rest[i, i + 1 :] / math.sqrt(rest[i, i])
            rest[i + 1 :, i + 1 :] -= np.outer(row, row)
    return keep


@dataclass
class Line:
    """Least-squares fit: terms, coefficients, their covariance and the residual degrees of freedom."""

    names: list[str]
    coefficients: np.ndarray
    inverse: np.ndarray
    sigma2: float
    dof: int
    aliased: list[str]

    @property
    def errors(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.inverse) * self.sigma2, 0))


def least_squares(df: DataFrame, names: Sequence[str], target: str) -> Line:
    """Ordinary least squares from one aggregate; combinations of other columns are left out.

    Columns are centred with the means of a first aggregate, which keeps the
    sums of squares well conditioned when values are large.
    """
    names = list(names)
    clean = df.select(*names, target).na.drop()
    means = clean.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate([*names, target])]).first()
    if means[0] is None:
        raise ValueError("no complete rows to fit")
    shifted = clean.select(*[(F.col(c) - F.lit(m)).alias(c) for c, m in zip([*names, target], means)])
    if len(names) <= _WRITTEN_OUT:
        row = shifted.agg(*cross_sums(names, target)).first()
    else:
        row = wide_cross_sums(shifted, names, target)
    width = len(names) + 1
    xx, xy = unpack(row["xx"], width), np.array(row["xy"])
    keep = independent(xx)
    inverse = np.linalg.inv(xx[np.ix_(keep, keep)])
    beta = inverse @ xy[keep]
    sse = max(row["yy"] - beta @ xy[keep], 0.0)
    dof = int(row["n"]) - len(keep)
    kept = [names[i - 1] for i in keep if i > 0]
    # back to uncentred columns: intercept' = mean(y) - sum(beta * mean(x))
    shift = np.eye(len(keep))
    for a, i in enumerate(keep):
        if i > 0:
            shift[0, a] = -means[i - 1]
    beta_full = shift @ beta
    beta_full[0] += means[len(names)]
    return Line(
        names=["(Intercept)", *kept],
        coefficients=beta_full,
        inverse=shift @ inverse @ shift.T,
        sigma2=sse / dof if dof > 0 else float("nan"),
        dof=dof,
        aliased=[names[i - 1] for i in range(1, width) if i not in keep],
    )


def ridge(xx: np.ndarray, xy: np.ndarray, yy: float, penalty: float) -> tuple[np.ndarray, float]:
    """Ridge solution (intercept unpenalised) and weighted r-squared from cross sums."""
    extra = np.full(xx.shape[0], penalty)
    extra[0] = 0.0
    beta = np.linalg.lstsq(xx + np.diag(extra), xy, rcond=None)[0]
    mean_y = xy[0] / xx[0, 0]
    total = yy - xx[0, 0] * mean_y**2
    residual = yy - 2 * beta @ xy + beta @ xx @ beta
    return beta, (1 - residual / total if total > 1e-12 else 0.0)


def t_tail(t: float, dof: float) -> float:
    """Two-sided tail probability of Student's t."""
    if math.isnan(t) or dof <= 0:
        return float("nan")
    return _incomplete_beta(dof / 2, 0.5, dof / (dof + t * t))


def t_quantile(level: float, dof: float) -> float:
    """Value that |t| stays below with probability ``level``."""
    low, high = 0.0, 1e3
    for _ in range(200):
        mid = (low + high) / 2
        if 1 - t_tail(mid, dof) < level:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - _incomplete_beta(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + numerator * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + numerator / (c if abs(c) > tiny else tiny)
            h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * h / a


# Up to this many columns the sums are written out as built-in aggregates.
_WRITTEN_OUT = 25


def wide_cross_sums(df: DataFrame, names: Sequence[str], target: str) -> dict:
    """Cross sums for many columns: one partial matrix per partition, added up by position."""
    width = len(names) + 1
    cols = [*names, target]

    def partial(batches):
        xx, xy, yy, n = np.zeros((width, width)), np.zeros(width), 0.0, 0
        for pdf in batches:
            block = pdf.to_numpy(dtype=float)
            x, y = np.hstack([np.ones((len(block), 1)), block[:, :-1]]), block[:, -1]
            xx, xy, yy, n = xx + x.T @ x, xy + x.T @ y, yy + y @ y, n + len(block)
        import pandas as pd

        yield pd.DataFrame({"sums": [np.concatenate([xx[np.triu_indices(width)], xy, [yy, n]])]})

    parts = df.select(*[F.col(c).cast("double") for c in cols]).mapInPandas(partial, "sums array<double>")
    added = parts.select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    sums = np.zeros(width * (width + 1) // 2 + width + 2)
    for r in added.collect():  # one number per pair of columns
        sums[r["at"]] = r["v"]
    cut = width * (width + 1) // 2
    return {"xx": sums[:cut], "xy": sums[cut : cut + width], "yy": sums[-2], "n": sums[-1]}
