"""Leading principal components without a covariance matrix.

A randomised range finder: some random directions are multiplied with the centred rows and back, a few times, until the
directions span what the rows vary along most. What moves is one table of columns x directions, so the number of columns may
be large and rows may be sparse. Centring is done on the products; the rows stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .partials import reduced

#: Directions beyond the wanted components, and most passes over the rows.
SPARE, PASSES = 30, 12
#: Passes end when the variances along the components change by less than this share.
SETTLED = 1e-9
#: Entries of a dense block that a task holds at a time.
ENTRIES = 1 << 21


class Block:
    """Some rows, sparse or dense, that can be multiplied from both sides."""

    def __init__(self, vectors: pa.StructArray, width: int):
        kinds = np.asarray(vectors.field("type"))
        values, indices = vectors.field("values"), vectors.field("indices")
        self.n, self.width = len(vectors), width
        sizes = np.diff(np.asarray(values.offsets))
        self.row = np.repeat(np.arange(self.n), sizes)
        self.value = np.asarray(values.flatten(), np.float64)
        # A dense row names no places: they are 0, 1, 2, ...
        place = np.arange(len(self.row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        sparse = np.repeat(kinds == 0, sizes)
        if sparse.any():
            place[sparse] = np.asarray(indices.flatten())
        self.place = place

    def times(self, m: np.ndarray) -> np.ndarray:
        """Rows times a table of columns x directions."""
        out = np.zeros((self.n, m.shape[1]))
        step = max(1, ENTRIES // m.shape[1])
        for at in range(0, len(self.row), step):
            row, place, value = (v[at : at + step] for v in (self.row, self.place, self.value))
            first = np.flatnonzero(np.diff(row, prepend=-1))
            out[row[first]] += np.add.reduceat(value[:, None] * m[place], first, 0)
        return out

    def back(self, y: np.ndarray) -> np.ndarray:
        """Transposed rows times a table of rows x directions."""
        return np.stack([np.bincount(self.place, self.value * y[self.row, j], self.width) for j in range(y.shape[1])], 1)


def vector_struct(name: str):
    return F.unwrap_udt(F.col(name)).alias("v")


def blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Block]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            # A copy, so that the lists of the slice begin at their own entries.
            yield Block(pa.concat_arrays([batch.column("v").slice(at, 4096).take(pa.array(range(min(4096, batch.num_rows - at))))]), width)


def _gathered(rows: DataFrame, mean: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Centred rows, transposed, times centred rows, times the directions."""
    width, many = directions.shape

    def partial(batches):
        shift = mean @ directions
        total, sums = np.zeros((width, many)), np.zeros(many)
        for block in blocks(batches, width):
            y = block.times(directions) - shift
            total += block.back(y)
            sums += y.sum(0)
        return total - np.outer(mean, sums)

    return reduced(rows, width * many, partial).reshape(width, many)


def leading_components(vectors: DataFrame, k: int, name: str = "features", seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, components as columns, variances along them) of a vector column. The vectors should be persisted.

    The largest coordinate of every component is positive. Fewer columns than ``k`` give that many components.
    """
    mean = vectors.select(Summarizer.mean(F.col(name)).alias("m"), F.count(name).alias("n")).first()
    if not mean["n"]:
        return np.zeros(0), np.zeros((0, 0)), np.zeros(0)
    n, mean = mean["n"], mean["m"].toArray()
    rows = vectors.filter(F.col(name).isNotNull()).select(vector_struct(name))
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(mean), min(len(mean), k + SPARE))))[0]
    before = None
    for _ in range(PASSES):
        found = _gathered(rows, mean, basis)
        small = basis.T @ found
        variance, turn = np.linalg.eigh((small + small.T) / 2)
        variance, turn = variance[::-1][:k], turn[:, ::-1][:, :k]
        components = basis @ turn
        if before is not None and np.abs(variance - before).max() <= SETTLED * max(abs(variance[0]), 1e-300):
            break
        before, basis = variance, np.linalg.qr(found)[0]
    sign = np.sign(components[np.abs(components).argmax(0), np.arange(components.shape[1])])
    return mean, components * np.where(sign == 0, 1, sign), variance / max(n - 1, 1)


def scores(vectors: DataFrame, found: tuple, ids: Sequence[str], names: Sequence[str], name: str = "features") -> DataFrame:
    """Ids and the place of every row along the components; a missing vector has none."""
    mean, components, _ = found
    width, kinds = len(mean), ", ".join(f"{n} double" for n in names)

    @F.arrow_udf(kinds)
    def placed(v: pa.Array) -> pa.Array:
        out = np.full((len(v), len(names)), np.nan)
        good = np.flatnonzero(np.asarray(v.is_valid()))
        if len(good) and width:
            for at in range(0, len(good), 4096):
                some = good[at : at + 4096]
                # As in Spark's own projection the mean is not taken off.
                out[some, : components.shape[1]] = Block(v.take(pa.array(some)), width).times(components)
        absent = np.isnan(out)
        return pa.StructArray.from_arrays([pa.array(out[:, j], pa.float64(), mask=absent[:, j]) for j in range(len(names))], list(names))

    placed_ = vectors.select(*ids, placed(vector_struct(name)).alias("__p"))
    return placed_.select(*ids, *[F.col(f"__p.{n}").alias(n) for n in names])
