"""k-means for many numbers of clusters and many restarts in common passes over the vectors.

All models advance together. A pass reads the vectors once; a task multiplies its rows with the centers of all open models
at a time, and adds up rows, counts and costs per center. Partial sums are packed, some models to a record, and added on
the executors, so that the driver gets one vector per center. A model whose centers stand still leaves.

Starting centers come from k-means|| in rounds that all models share: every round draws rows with a chance in proportion
to their squared distance from the candidates so far. The draws are hashes of the row and the model, so they do not depend
on how the rows are partitioned. The candidates of a model, weighted by the rows nearest to each, are few; they are reduced
to k centers on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .partials import reduced, spread

#: Entries of the distance matrix that a task holds at a time.
ENTRIES = 1 << 22
#: Rounds of drawing, and candidates drawn in a round for one center.
ROUNDS, DRAWN = 2, 2
#: A model is done when no center moves further than this.
STILL = 1e-4


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows_of(vectors: DataFrame, name: str) -> DataFrame:
    """Vectors as arrays with a hash per row; what all passes read."""
    array = F.col(name).cast("array<double>") if vectors.schema[name].dataType.typeName() == "array" else vector_to_array(F.col(name))
    return vectors.select(array.alias("x")).filter(F.col("x").isNotNull()).withColumn("h", F.xxhash64("x"))


def blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(vectors, hashes), so many at a time that a table of rows x ``width`` stays small."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x, h = batch.column("x"), np.asarray(batch.column("h")).view(np.uint64)
        x = np.asarray(x.flatten()).reshape(batch.num_rows, -1)
        most = max(16, ENTRIES // max(1, width, x.shape[1]))
        for at in range(0, len(x), most):
            yield x[at : at + most], h[at : at + most]


class Segments:
    """The centers of all models in one table; models of equal size next to each other are handled at a time."""

    def __init__(self, centers: Sequence[np.ndarray]):
        self.sizes = np.array([len(c) for c in centers])
        self.ends = np.cumsum(self.sizes)
        self.table = np.concatenate(centers)
        self.square = (self.table**2).sum(1)
        cuts = np.flatnonzero(np.diff(self.sizes, prepend=-1))
        self.groups = [(int(a), int(b), int(self.sizes[a])) for a, b in zip(cuts, [*cuts[1:], len(self.sizes)])]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of the table nearest to every vector, and the squared distance, for each model."""
        far = self.square - 2 * (x @ self.table.T)
        own, least = (np.empty((len(x), len(self.sizes)), t) for t in (np.int64, np.float64))
        for a, b, k in self.groups:
            start = self.ends[a] - k
            part = far[:, start : self.ends[b - 1]].reshape(len(x), b - a, k)
            pick = part.argmin(2)
            own[:, a:b] = pick + start + k * np.arange(b - a)
            least[:, a:b] = np.take_along_axis(part, pick[:, :, None], 2)[:, :, 0]
        return own, np.maximum(least + (x**2).sum(1)[:, None], 0)


def added(rows: DataFrame, width: int, numbers: int, work: Callable) -> np.ndarray:
    """Sum over all partitions of the ``numbers`` values that ``work(vectors, total)`` adds to ``total``."""

    def partial(batches):
        total = np.zeros(numbers)
        for x, _ in blocks(batches, width):
            work(x, total)
        return total

    return reduced(rows, numbers, partial)


def costs(rows: DataFrame, centers: Sequence[np.ndarray]) -> np.ndarray:
    """Total within-cluster sum of squares of every model."""
    models = Segments(centers)
    return added(rows, len(models.table), len(centers), lambda x, total: np.add(total, models.nearest(x)[1].sum(0), out=total))


def moved(rows: DataFrame, centers: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Centers after one step; a center without rows stays."""
    models = Segments(centers)
    many, d = models.table.shape

    def work(x, total):
        total = total.reshape(many, d + 1)
        own = models.nearest(x)[0]
        wide = np.concatenate([x, np.ones((len(x), 1))], 1)
        for a, b, k in models.groups:
            start = models.ends[a] - k
            count = (b - a) * k
            at = np.zeros((len(x), count))
            at[np.arange(len(x))[:, None], own[:, a:b] - start] = 1.0
            total[start : start + count] += at.T @ wide

    sums = added(rows, 2 * many, many * (d + 1), work).reshape(many, d + 1)
    count = sums[:, d:]
    table = np.where(count > 0, sums[:, :d] / np.maximum(count, 1), models.table)
    return np.split(table, models.ends[:-1])


def weights(rows: DataFrame, centers: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Rows nearest to every center."""
    models = Segments(centers)
    many = len(models.table)

    def work(x, total):
        total += np.bincount(models.nearest(x)[0].ravel(), minlength=many)

    return np.split(added(rows, many, many, work), models.ends[:-1])


def seeds_of(models: Sequence[tuple[int, int]]) -> np.ndarray:
    """A number per model, from its restart and number of clusters."""
    pairs = np.array(models, np.uint64).reshape(-1, 2)
    return mixed(pairs[:, 1] * np.uint64(0x9E3779B97F4A7C15) + mixed(pairs[:, 0] + np.uint64(1)))


def first_rows(rows: DataFrame, seeds: np.ndarray) -> list[np.ndarray]:
    """For every model the row with the smallest draw."""

    def work(batches):
        best = None
        for x, h in blocks(batches, len(seeds)):
            draw = mixed(h[:, None] ^ seeds)
            at = draw.argmin(0)
            new = draw[at, np.arange(len(seeds))], x[at]
            if best is None:
                best = new
            else:
                less = new[0] < best[0]
                best = np.where(less, new[0], best[0]), np.where(less[:, None], new[1], best[1])
        if best is not None:
            data = [v.tobytes() for v in np.ascontiguousarray(best[1])]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(seeds)), pa.int32()), pa.array(best[0].view(np.int64)), pa.array(data, pa.binary())], ["model", "draw", "data"])

    found = rows.mapInArrow(work, "model int, draw long, data binary")
    low = F.col("draw").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))  # order of the unsigned number
    best = found.groupBy("model").agg(F.min_by("data", low).alias("data")).collect()
    return [np.frombuffer(r["data"], np.float64)[None] for r in sorted(best)]


def drawn(rows: DataFrame, centers: Sequence[np.ndarray], cost: np.ndarray, seeds: np.ndarray, wanted: np.ndarray, turn: int) -> list[np.ndarray]:
    """New candidates of every model; equal vectors once."""
    models = Segments(centers)
    turn_seeds = mixed(seeds + np.uint64(turn + 1))

    def work(batches):
        seen = set()
        for x, h in blocks(batches, len(models.table)):
            chance = models.nearest(x)[1] * (wanted / np.maximum(cost, 1e-300))
            draw = (mixed(h[:, None] ^ turn_seeds) >> np.uint64(11)) * 2.0**-53
            row, model = np.nonzero(draw < chance)
            out = [(m, x[i].tobytes()) for i, m in zip(row.tolist(), model.tolist())]
            out = [o for o in out if not (o in seen or seen.add(o))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())], ["model", "data"])

    found = rows.mapInArrow(work, "model int, data binary").distinct().collect()
    new: list[list[bytes]] = [[] for _ in centers]
    for r in found:
        new[r["model"]].append(bytes(r["data"]))
    d = models.table.shape[1]
    return [np.concatenate([c, np.frombuffer(b"".join(sorted(n)), np.float64).reshape(-1, d)]) for c, n in zip(centers, new)]


def few_centers(points: np.ndarray, weight: np.ndarray, k: int, seed: int, steps: int = 30) -> np.ndarray:
    """k centers of weighted candidates: drawn one after the other by weighted distance, then moved to their means."""
    draw = np.random.default_rng(seed)
    distinct, first = np.unique(points, axis=0, return_index=True)
    if len(distinct) <= k:
        return points[np.sort(first)]
    weight = np.maximum(weight, 1e-9)
    chosen = [int(draw.choice(len(points), p=weight / weight.sum()))]
    far = ((points - points[chosen[0]]) ** 2).sum(1)
    for _ in range(k - 1):
        mass = weight * far
        if mass.sum() <= 0:
            break
        chosen.append(int(draw.choice(len(points), p=mass / mass.sum())))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
    centers = points[chosen]
    for _ in range(steps):
        own = ((points**2).sum(1)[:, None] - 2 * points @ centers.T + (centers**2).sum(1)).argmin(1)
        at = np.zeros((len(points), len(centers)))
        at[np.arange(len(points)), own] = weight
        mass = at.sum(0)[:, None]
        new = np.where(mass > 0, (at.T @ points) / np.maximum(mass, 1e-300), centers)
        if (new == centers).all():
            break
        centers = new
    return centers


def starts(rows: DataFrame, models: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """Starting centers of models (k, seed); fewer than k where there are fewer distinct vectors."""
    seeds = seeds_of(models)
    centers = first_rows(rows, seeds)
    if not centers:
        return []
    wanted = np.array([float(DRAWN * k) for k, _ in models])
    for turn in range(ROUNDS):
        centers = drawn(rows, centers, costs(rows, centers), seeds, wanted, turn)
    return [few_centers(c, w, k, s) for c, w, (k, s) in zip(centers, weights(rows, centers), models)]


def fit_all(vectors: DataFrame, models: Sequence[tuple[int, int]], name: str = "features", max_iter: int = 20) -> list[tuple[np.ndarray, float, int]]:
    """(centers, total within-cluster sum of squares, steps) of every model (k, seed). 

    All vectors must have one length; missing ones take no part. Without vectors the result is empty.
    """
    rows = spread(rows_of(vectors, name)).persist()
    try:
        return _fit_all(rows, models, max_iter)
    finally:
        rows.unpersist()


def _fit_all(rows: DataFrame, models: Sequence[tuple[int, int]], max_iter: int) -> list[tuple[np.ndarray, float, int]]:
    # Models of equal k next to each other share matrix operations.
    order = sorted(range(len(models)), key=lambda i: models[i])
    centers = starts(rows, [models[i] for i in order])
    if not centers:
        return []
    steps = [0] * len(centers)
    open_ = list(range(len(centers)))
    for _ in range(max_iter):
        new = moved(rows, [centers[i] for i in open_])
        still = []
        for i, c in zip(open_, new):
            steps[i] += 1
            if ((c - centers[i]) ** 2).sum(1).max() > STILL**2:
                still.append(i)
            centers[i] = c
        open_ = still
        if not open_:
            break
    out: list = [None] * len(models)
    for i, c, w, n in zip(order, centers, costs(rows, centers).tolist(), steps):
        out[i] = (c, w, n)
    return out
