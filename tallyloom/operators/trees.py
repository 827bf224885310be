"""Regression trees grown level by level from sums of the rows.

All trees of a group take a level at a time: a task routes its rows down the trees as they are and adds up, per open node,
what the splits need. The driver gets the sums, whose number depends on trees, nodes and features, and chooses.

* Randomised trees: every node draws some features and one threshold for each, uniform between the least and greatest
  value in the node. One pass finds these borders, one the sums left of the thresholds. Draws are hashes of tree, node
  and feature; rows are weighted by a Poisson count of tree and row, which stands for drawing with replacement. Rows lie
  sorted by a hash of their features, so that a task adds up the weights of equal features and routes them once. Where many
  rows share their features, the weights are drawn once and their sums per tree kept for all passes.
* A bagged forest with the rules of Spark's: features in 32 bins, the best split of a drawn third of the features. Rows of
  equal bins and label are counted, and the draw of each of them is part of one Poisson count.
* Histogram trees: every node sees all features in bins. A single tree is grown on sums of squares and then pruned by its
  weakest links; a boosted one on first and second derivatives, with penalised leaf weights. Both read one row per distinct
  features, with count, sum and sum of squares of its labels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .manymeans import mixed
from .partials import reduced, spread

#: Pairs of row and tree that a task holds at a time, and trees that grow together.
PAIRS, TOGETHER = 1 << 21, 500
#: Pairs that a core holds next to it while it draws for them.
NEAR = 1 << 15
#: Groups of trees that grow at the same time, so that executors work while the driver chooses splits for another group.
GROUPS = 3
#: Rows of a partition that is sorted by features.
SORTED = 500_000
#: Pairs from which on sums are kept if each stands for so many rows or more, four times as many beyond so many bytes of
#: sums; and bytes of them in a partition.
KEPT, SHARED, KEPT_SMALL, KEPT_BYTES = 1 << 24, 4, 1 << 28, 32 << 20
#: Rows up to which the forest with default settings is fitted by Spark, and its bins and depth.
FEW, BINS, DEPTH = 1 << 17, 32, 5
#: Sums of a level that the trees of a bagged group may need, and distinct values of a feature that are fetched.
SUMS, VALUES = 1 << 22, 10_000
#: Thresholds per feature of histogram trees.
EDGES = 63

# Chance of at most 0, 1, 2, ... with mean one.
_POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)])


# The same as least numbers of 53 bits. By its leading 12 bits a number has a count, or -1 where they leave it open.
_LEAST = np.ceil(_POISSON * 2.0**53).astype(np.uint64)
_COUNTS = np.searchsorted(_LEAST, np.arange(1 << 12, dtype=np.uint64) << np.uint64(41), "right").astype(np.int8)
_COUNTS[np.unique(_LEAST >> np.uint64(41)).astype(np.int64)] = -1


def _scattered(*keys) -> np.ndarray:
    out = np.zeros(1, np.uint64)
    for k in keys:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + np.atleast_1d(k).astype(np.uint64))
    return out >> np.uint64(11)


def uniform(*keys) -> np.ndarray:
    """Number in [0, 1) from some 64-bit keys."""
    return _scattered(*keys) * 2.0**-53


@dataclass
class Trees:
    """Nodes of all trees; an inner node has a feature, a threshold and its left child (the right one follows it)."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    gain: np.ndarray
    depth: int = 0

    @classmethod
    def planted(cls, n: int) -> Trees:
        return cls(np.arange(n), np.full(n, -1), np.zeros(n), np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n))

    def grown(self, nodes: np.ndarray, feature: np.ndarray, threshold: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Splits nodes and returns their left children."""
        n, m = len(self.feature), len(nodes)
        left = n + 2 * np.arange(m)
        self.feature[nodes], self.threshold[nodes], self.left[nodes], self.gain[nodes] = feature, threshold, left, gain
        more = np.zeros(2 * m)
        self.feature = np.concatenate([self.feature, np.full(2 * m, -1)])
        self.left = np.concatenate([self.left, more.astype(np.int64)])
        self.threshold, self.value, self.weight, self.gain = (np.concatenate([v, more]) for v in (self.threshold, self.value, self.weight, self.gain))
        self.depth += 1
        return left

    def route(self, x: np.ndarray, roots: np.ndarray | None = None) -> np.ndarray:
        """Node that every row reaches in every tree."""
        roots = self.roots if roots is None else roots
        # Leaves lead to themselves: they compare with an infinite threshold.
        inner = self.feature >= 0
        feature, flat = np.maximum(self.feature, 0), np.ascontiguousarray(x).ravel()
        threshold, left = np.where(inner, self.threshold, np.inf), np.where(inner, self.left, np.arange(len(inner)))
        node = np.repeat(roots[None, :], len(x), 0)
        row = (np.arange(len(x)) * x.shape[1])[:, None]
        for _ in range(self.depth):
            node = left[node] + (flat[row + feature[node]] > threshold[node])
        return node

    def routing(self, value: bool = False) -> Trees:
        """What tasks need to route rows, with the values of the nodes if they score them."""
        none = np.zeros(0)
        return Trees(self.roots, self.feature.astype(np.int32), self.threshold, self.left.astype(np.int32), self.value if value else none, none, none, self.depth)

    def predict(self, x: np.ndarray, start: float, share: float) -> np.ndarray:
        """``start`` plus ``share`` times the sum of the leaf values."""
        out = np.full(len(x), start)
        for at in range(0, len(self.roots), TOGETHER):
            roots = self.roots[at : at + TOGETHER]
            step = max(1, PAIRS // len(roots))
            for lo in range(0, len(x), step):
                out[lo : lo + step] += share * self.value[self.route(x[lo : lo + step], roots)].sum(1)
        return out

    def importance(self, features: int) -> np.ndarray:
        """Share of every feature in the gains, tree by tree; the trees count the same."""
        owner = np.zeros(len(self.feature), np.int64)
        owner[self.roots] = np.arange(len(self.roots))
        inner = np.flatnonzero(self.feature >= 0)
        for node in inner.tolist():  # children come after their parents
            owner[self.left[node]] = owner[self.left[node] + 1] = owner[node]
        table = np.zeros((len(self.roots), features))
        np.add.at(table, (owner[inner], self.feature[inner]), self.gain[inner])
        total = table.sum(1, keepdims=True)
        mean = (table / np.where(total > 0, total, 1)).sum(0)
        return mean / mean.sum() if mean.sum() > 0 else mean


def joined(parts: list[Trees]) -> Trees:
    base = np.cumsum([0] + [len(p.feature) for p in parts])
    return Trees(np.concatenate([p.roots + b for p, b in zip(parts, base)]), *[np.concatenate([getattr(p, n) for p in parts]) for n in ("feature", "threshold")],
                 np.concatenate([p.left + b for p, b in zip(parts, base)]), *[np.concatenate([getattr(p, n) for p in parts]) for n in ("value", "weight", "gain")],
                 max(p.depth for p in parts))


def rows_of(df: DataFrame, features: str, label: str) -> DataFrame:
    rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")).filter("x is not null and y is not null")
    return spread(rows.withColumn("h", F.xxhash64("x", "y")))


def blocks(batches: Iterator[pa.RecordBatch], trees: int, names: tuple[str, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """(features, other columns...), some rows at a time."""
    step = max(16, PAIRS // max(1, trees))
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)
        others = [np.asarray(batch.column(n)) for n in names]
        for at in range(0, len(x), step):
            yield x[at : at + step], *[v[at : at + step] for v in others]


# -- randomised trees ----------------------------------------------------------------------------------------------


def drawn_weights(h: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """How often a row is drawn for a tree."""
    out = np.empty((len(h), len(trees)))
    step = max(1, NEAR // max(1, len(trees)))
    for at in range(0, len(h), step):
        draw = _scattered(seed, trees[None, :], h[at : at + step, None])
        count = _COUNTS[(draw >> np.uint64(41)).view(np.int64)]
        left = np.nonzero(count < 0)
        count[left] = np.searchsorted(_LEAST, draw[left], "right")
        out[at : at + step] = count
    return out


@lru_cache(4096)
def _least_of(mean: int) -> tuple[int, np.ndarray]:
    """(first, least numbers of 53 bits with a count above first, first + 1, ...) of a Poisson count of this mean."""
    reach = 12 * math.sqrt(mean) + 30
    first = max(0, math.floor(mean - reach))
    counts = np.arange(first, math.ceil(mean + reach))
    logs = np.concatenate([[math.lgamma(first + 1)], np.log(counts[1:])]).cumsum()
    chance = np.exp(counts * math.log(mean) - mean - logs).cumsum()
    return first, np.ceil(np.minimum(chance, 1.0) * 2.0**53).astype(np.uint64)


def drawn_counts(h: np.ndarray, c: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """How often the ``c`` rows with this hash are drawn for a tree, each by a count of mean one."""
    out = np.empty((len(h), len(trees)))
    one = c == 1
    out[one] = drawn_weights(h[one], trees, seed)
    for k in np.unique(c[~one]):
        own = c == k
        first, least = _least_of(int(k))
        out[own] = first + np.searchsorted(least, _scattered(seed, trees[None, :], h[own, None]), "right")
    return out


def drawn_together(h: np.ndarray, c: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """The same if equal rows share their draw."""
    return drawn_weights(h, trees, seed) * c[:, None]


def drawn_all(h: np.ndarray, c: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """The same without a draw."""
    return np.repeat(c[:, None], len(trees), 1)


def by_features(rows: DataFrame) -> DataFrame:
    """Equal rows counted, and sorted so that rows of equal features lie together; many of them may lie in several partitions."""
    found = rows.groupBy("x", "y", "h").agg(F.count("*").cast("double").alias("c"))
    return _sorted(found)


def _sorted(found: DataFrame) -> DataFrame:
    found = found.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = max(found.sparkSession.sparkContext.defaultParallelism, -(-found.count() // SORTED))
        placed = found.withColumn("k", F.xxhash64("x")).repartitionByRange(parts, "k", "h").sortWithinPartitions("k", "h").drop("k").persist()
        placed.count()
        return placed
    finally:
        found.unpersist()


def _matrix(column: pa.Array) -> np.ndarray:
    """Features of a batch, numbers or one byte each."""
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _starts(x: np.ndarray) -> np.ndarray:
    """First rows of runs of equal features."""
    return np.flatnonzero(np.append(True, (x[1:] != x[:-1]).any(1)))


def _equal_features(batches, numbers, seed, draw, powers: int):
    """(features, per power p of the label the sums of weight * label^p over the rows of these features in every tree)."""
    step, near = max(16, PAIRS // len(numbers)), max(1, NEAR // len(numbers))
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x = _matrix(batch.column("x"))
        if "sums" in batch.schema.names:
            for at in range(0, len(x), step):
                sums = np.frombuffer(b"".join(batch.column("sums")[at : at + step].to_pylist()), np.float64).reshape(-1, 3, len(numbers))
                yield x[at : at + step], [sums[:, p] for p in range(powers)]
            continue
        y, h, c = np.asarray(batch.column("y")), np.asarray(batch.column("h")).view(np.uint64), np.asarray(batch.column("c"))
        for at in range(0, len(x), step):
            some = x[at : at + step]
            first = _starts(some)
            run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(some))))
            sums = [np.zeros((len(first), len(numbers))) for _ in range(powers)]
            for lo in range(0, len(some), near):  # what a core holds next to it
                own = slice(at + lo, min(at + lo + near, at + len(some)))
                runs = run[lo : lo + near]
                starts = np.flatnonzero(np.diff(runs, prepend=-1))
                weight = draw(h[own], c[own], numbers, seed)
                for p in range(powers):
                    if p:
                        weight *= y[own, None]
                    sums[p][runs[starts]] += np.add.reduceat(weight, starts, 0) if len(starts) < len(runs) else weight
            yield some[first], sums


def kept_sums(rows: DataFrame, numbers: np.ndarray, seed: int, draw) -> DataFrame:
    """Per features, or part of their rows, the sums of weight, weight * label and weight * label^2 in every tree."""
    near = max(1, NEAR // len(numbers))

    def work(batches):
        held, total, out = None, None, []

        def packed():
            kind = pa.binary() if isinstance(out[0][0], bytes) else pa.list_(pa.float64())
            return pa.RecordBatch.from_arrays([pa.array([v for v, _ in out], kind), pa.array([s for _, s in out], pa.binary())], ["x", "sums"])

        for batch in batches:
            x, y = _matrix(batch.column("x")), np.asarray(batch.column("y"))
            h, c = np.asarray(batch.column("h")).view(np.uint64), np.asarray(batch.column("c"))
            powers = np.stack([np.ones(len(y)), y, y * y])
            for at in range(0, len(x), near):
                some = x[at : at + near]
                weight = draw(h[at : at + near], c[at : at + near], numbers, seed)
                first = _starts(some)
                for a, b in zip(first, [*first[1:], len(some)]):
                    sums = powers[:, at + a : at + b] @ weight[a:b]
                    if held is not None and (some[a] == held).all():
                        total += sums
                        continue
                    if held is not None:
                        out.append((held.tobytes() if held.dtype == np.uint8 else held, total.tobytes()))
                    held, total = some[a], sums
                    if len(out) * total.nbytes >= 1 << 22:
                        yield packed()
                        out = []
        if held is not None:
            out.append((held.tobytes() if held.dtype == np.uint8 else held, total.tobytes()))
            yield packed()

    return rows.select("x", "y", "h", "c").mapInArrow(work, f"x {rows.schema['x'].dataType.simpleString()}, sums binary")


def _drawn_once(rows: DataFrame, count: int, cells: int, numbers: np.ndarray, seed: int, draw) -> DataFrame:
    """The rows, or their sums in these trees where these are far fewer."""
    size = cells * len(numbers) * 24
    if count * len(numbers) < KEPT or cells * SHARED * (4 if size > KEPT_SMALL else 1) > count:
        return rows
    sums, parts = kept_sums(rows, numbers, seed, draw), -(-size // KEPT_BYTES)
    return (sums.repartition(parts) if parts > rows.rdd.getNumPartitions() else sums).persist()


def _in_open_nodes(grown: Trees, slots: np.ndarray, x, weight):
    """(slot, row, place) of all pairs of row and tree whose node is open."""
    slot = slots[grown.route(x)]
    some = np.flatnonzero((slot >= 0) & (weight > 0))
    return slot.ravel()[some], some // slot.shape[1], some


def randomised(rows: DataFrame, features: int, trees: int, mtry: int, min_n: int = 10, max_depth: int = 8, seed: int = 1, replace: bool = True) -> Trees:
    """Trees with one random threshold per node and drawn feature; the best of them splits the node."""
    groups = [range(at, min(trees, at + TOGETHER)) for at in range(0, trees, TOGETHER)]
    draw = drawn_together if replace else drawn_all
    rows = by_features(rows)
    count, cells = rows.agg(F.count("*"), F.count_distinct("x")).first()

    def grow(group):
        numbers = np.array(group)
        own = _drawn_once(rows, count, cells, numbers, seed, draw)
        try:
            return _randomised(own, features, numbers, min(mtry, features), min_n, max_depth, seed, draw)
        finally:
            if own is not rows:
                own.unpersist()

    try:
        with ThreadPool(max(1, min(GROUPS, len(groups)))) as pool:
            return joined(pool.map(inheritable_thread_target(rows.sparkSession)(grow), groups, chunksize=1))
    finally:
        rows.unpersist()


def _randomised(rows, features, numbers, mtry, min_n, max_depth, seed, draw) -> Trees:
    grown = Trees.planted(len(numbers))
    owner = numbers.copy()  # number of the tree of every node
    path = np.ones(len(numbers), np.int64)  # place of every node in its tree
    open_ = np.arange(len(numbers))
    for level in range(max_depth + 1):
        if len(open_) == 0:
            break
        u = uniform(seed, 1, owner[open_][:, None], path[open_][:, None], np.arange(features)[None, :])
        chosen = np.argsort(u, axis=1)[:, :mtry] if level < max_depth else np.zeros((len(open_), 0), np.int64)
        slots = np.full(len(grown.feature), -1)
        slots[open_] = np.arange(len(open_))
        low, high = _borders(rows, grown, slots, chosen, numbers, seed, draw)
        u = uniform(seed, 2, owner[open_][:, None], path[open_][:, None], chosen)
        threshold = low + u * (high - low)
        threshold = np.where(high > low, np.minimum(threshold, np.nextafter(high, -np.inf)), np.nan)
        total, left = _left_sums(rows, grown, slots, chosen, threshold, numbers, seed, draw)
        n, s = total[:, 0], total[:, 1]
        grown.weight[open_], grown.value[open_] = n, s / np.maximum(n, 1e-300)
        ln, ls = left[:, :, 0], left[:, :, 1]
        rn, rs = n[:, None] - ln, s[:, None] - ls
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = ls**2 / ln + rs**2 / rn - (s**2 / n)[:, None]
        gain = np.where((ln > 0) & (rn > 0) & ~np.isnan(threshold), gain, -np.inf)
        if gain.shape[1] == 0:
            break
        best = gain.argmax(1)
        at = np.arange(len(open_))
        split = np.flatnonzero((n >= min_n) & (gain[at, best] > 1e-12 * np.maximum(1.0, total[:, 2])))
        if len(split) == 0:
            break
        pick = best[split]
        nodes = open_[split]
        first = grown.grown(nodes, chosen[split, pick], threshold[split, pick], gain[split, pick])
        open_ = np.stack([first, first + 1], 1).ravel()
        owner = np.concatenate([owner, np.repeat(owner[nodes], 2)])
        path = np.concatenate([path, np.stack([2 * path[nodes], 2 * path[nodes] + 1], 1).ravel()])
    return grown


def _borders(rows, grown, slots, chosen, numbers, seed, draw) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of the drawn features in every open node."""
    shape, grown = chosen.shape, grown.routing()

    def work(batches):
        least = np.full((2, *shape), np.inf)
        for x, (weight,) in _equal_features(batches, numbers, seed, draw, 1):
            slot, row, _ = _in_open_nodes(grown, slots, x, weight)
            if len(slot) == 0:
                continue
            order = np.argsort(slot.astype(np.uint16) if shape[0] <= 1 << 16 else slot, kind="stable")
            slot, row = slot[order], row[order]
            first = np.flatnonzero(np.diff(slot, prepend=-1))
            own = slot[first]
            for j in range(shape[1]):
                v = x[row, chosen[slot, j]]
                least[0, own, j] = np.minimum(least[0, own, j], np.minimum.reduceat(v, first))
                least[1, own, j] = np.minimum(least[1, own, j], -np.maximum.reduceat(v, first))
        return least

    if shape[1] == 0:
        return np.zeros(shape), np.zeros(shape)
    low, high = reduced(rows, 2 * shape[0] * shape[1], work, "min").reshape(2, *shape)
    return np.where(np.isfinite(low), low, 0.0), np.where(np.isfinite(high), -high, 0.0)


def _left_sums(rows, grown, slots, chosen, threshold, numbers, seed, draw) -> tuple[np.ndarray, np.ndarray]:
    """Per open node (weight, sum, sum of squares), and per drawn feature (weight, sum) of the rows up to its threshold."""
    many, mtry = chosen.shape
    grown = grown.routing()

    def work(batches):
        total, left = np.zeros((many, 3)), np.zeros((many, mtry, 2))
        for x, sums in _equal_features(batches, numbers, seed, draw, 3):
            slot, row, place = _in_open_nodes(grown, slots, x, sums[0])
            w, wy, wyy = (v.ravel()[place] for v in sums)
            for k, v in enumerate((w, wy, wyy)):
                total[:, k] += np.bincount(slot, v, many)
            for j in range(mtry):
                some = x[row, chosen[slot, j]] <= threshold[slot, j]
                left[:, j, 0] += np.bincount(slot[some], w[some], many)
                left[:, j, 1] += np.bincount(slot[some], wy[some], many)
        return np.concatenate([total.ravel(), left.ravel()])

    found = reduced(rows, many * 3 + many * mtry * 2, work)
    return found[: many * 3].reshape(many, 3), found[many * 3 :].reshape(many, mtry, 2)


# -- bagged forest -------------------------------------------------------------------------------------------------


def splits_of(rows: DataFrame, features: int) -> list[np.ndarray]:
    """Thresholds of every feature: between all neighbouring values, or where the rows up to them come nearest to equal shares."""
    cells = rows.groupBy("x").agg(F.count("*").alias("n")).select("n", F.posexplode("x").alias("f", "v")).groupBy("f", "v").agg(F.sum("n").alias("n")).persist()
    try:
        kinds = {r["f"]: r["kinds"] for r in cells.groupBy("f").agg(F.count("*").alias("kinds")).collect()}
        many = sorted(f for f, k in kinds.items() if k > VALUES)
        out = [np.zeros(0)] * features
        listed = cells.filter(~F.col("f").isin(many)).groupBy("f").agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("v"))
        for r in listed.collect():
            out[r["f"]] = _between(np.array([v for v, _ in r["v"]], float), np.array([n for _, n in r["v"]], float))
    finally:
        cells.unpersist()
    if many:
        shares = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
        ranked = rows.select(F.posexplode("x").alias("f", "v")).filter(F.col("f").isin(many)).groupBy("f").agg(
            F.max("v").alias("most"), F.percentile_approx("v", shares, 10_000).alias("v"))
        for r in ranked.collect():
            out[r["f"]] = np.unique([v for v in r["v"] if v < r["most"]])
    return out


def _between(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    middle = (values[1:] + values[:-1]) / 2
    if len(middle) < BINS:
        return middle
    up_to, share = counts.cumsum(), counts.sum() / BINS
    out, target = [], share
    for i in range(1, len(values)):
        if abs(up_to[i - 1] - target) < abs(up_to[i] - target):
            out.append(middle[i - 1])
            target += share
    return np.array(out)


def binned(rows: DataFrame, splits: list[np.ndarray]) -> DataFrame:
    """Rows with a byte per feature, equal ones counted."""

    def work(batches):
        for batch in batches:
            x = _matrix(batch.column("x"))
            bins = np.stack([np.searchsorted(e, x[:, f]).astype(np.uint8) for f, e in enumerate(splits)], 1)
            ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(len(splits))
            packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(bins))])
            yield pa.RecordBatch.from_arrays([packed, batch.column("y")], ["x", "y"])

    found = rows.select("x", "y").mapInArrow(work, "x binary, y double").groupBy("x", "y").agg(F.count("*").cast("double").alias("c"))
    return found.withColumn("h", F.xxhash64("x", "y"))


def bagged(rows: DataFrame, features: int, trees: int, seed: int = 1) -> Trees:
    """Trees on rows drawn with replacement; the best split of a drawn third of the features splits a node, down to five levels."""
    splits, mtry = splits_of(rows, features), -(-features // 3)
    # A level needs the sums of all bins of the drawn features of its nodes.
    most = np.sort([len(e) + 1 for e in splits])[-mtry:].sum() << (DEPTH - 1)
    together = int(min(TOGETHER, max(1, SUMS // most)))
    rows = _sorted(binned(rows, splits))
    count, cells = rows.agg(F.count("*"), F.count_distinct("x")).first()

    def grow(at):
        numbers = np.arange(at, min(trees, at + together))
        own = _drawn_once(rows, count, cells, numbers, seed, drawn_counts)
        try:
            return _bagged(own, numbers, splits, mtry, seed)
        finally:
            if own is not rows:
                own.unpersist()

    groups = range(0, trees, together)
    try:
        with ThreadPool(max(1, min(GROUPS, len(groups)))) as pool:
            grown = joined(pool.map(inheritable_thread_target(rows.sparkSession)(grow), groups, chunksize=1))
    finally:
        rows.unpersist()
    for node in np.flatnonzero(grown.feature >= 0):
        grown.threshold[node] = splits[grown.feature[node]][int(grown.threshold[node])]
    return grown


def _bagged(rows, numbers, splits, mtry, seed) -> Trees:
    """Trees whose thresholds are bins."""
    features, wide = len(splits), np.array([len(e) + 1 for e in splits])
    grown = Trees.planted(len(numbers))
    owner, path, open_ = numbers.copy(), np.ones(len(numbers), np.int64), np.arange(len(numbers))
    for level in range(DEPTH):
        u = uniform(seed, 4, owner[open_][:, None], path[open_][:, None], np.arange(features)[None, :])
        chosen = np.argsort(u, axis=1)[:, :mtry]
        slots = np.full(len(grown.feature), -1)
        slots[open_] = np.arange(len(open_))
        total, bins = _bin_sums(rows, grown, slots, chosen, wide, numbers, seed)
        grown.weight[open_], grown.value[open_] = total[:, 0], total[:, 1] / np.maximum(total[:, 0], 1e-300)
        best, cut, below = np.full(len(open_), -np.inf), np.zeros((2, len(open_)), np.int64), np.zeros((len(open_), 2))
        for j, sums in enumerate(bins):
            first = np.cumsum(wide[chosen[:, j]]) - wide[chosen[:, j]]
            for w in np.unique(wide[chosen[:, j]]):
                own = np.flatnonzero(wide[chosen[:, j]] == w)
                if w == 1:
                    continue
                left = sums[first[own][:, None] + np.arange(w - 1)].cumsum(1)
                ln, ls = left[..., 0], left[..., 1]
                n, s = total[own, :1], total[own, 1:2]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = ls**2 / ln + (s - ls) ** 2 / (n - ln) - s**2 / n
                gain = np.where((ln > 0) & (n - ln > 0), gain, -np.inf)
                at = gain.argmax(1)
                most = gain[np.arange(len(own)), at]
                more = most > best[own]
                own, at = own[more], at[more]
                best[own], cut[:, own], below[own] = most[more], [chosen[own, j], at], left[np.flatnonzero(more), at]
        split = np.flatnonzero(best > 1e-12 * np.maximum(1.0, total[:, 2]))
        if len(split) == 0:
            break
        nodes = open_[split]
        first = grown.grown(nodes, cut[0, split], cut[1, split].astype(float), best[split])
        for child, sums in ((first, below[split]), (first + 1, total[split, :2] - below[split])):
            grown.weight[child], grown.value[child] = sums[:, 0], sums[:, 1] / sums[:, 0]
        open_ = np.stack([first, first + 1], 1).ravel()
        owner = np.concatenate([owner, np.repeat(owner[nodes], 2)])
        path = np.concatenate([path, np.stack([2 * path[nodes], 2 * path[nodes] + 1], 1).ravel()])
    return grown


def _bin_sums(rows, grown, slots, chosen, wide, numbers, seed) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per open node (weight, sum, sum of squares); per place of a drawn feature (weight, sum) of its bins, node after node."""
    many, mtry = chosen.shape
    widths, grown = wide[chosen], grown.routing()
    start, sizes = widths.cumsum(0) - widths, widths.sum(0)

    def work(batches):
        total, bins = np.zeros((many, 3)), [np.zeros((size, 2)) for size in sizes]
        for x, sums in _equal_features(batches, numbers, seed, drawn_counts, 3):
            slot, row, place = _in_open_nodes(grown, slots, x, sums[0])
            w, wy, wyy = (v.ravel()[place] for v in sums)
            for k, v in enumerate((w, wy, wyy)):
                total[:, k] += np.bincount(slot, v, many)
            for j in range(mtry):
                at = start[slot, j] + x[row, chosen[slot, j]]
                bins[j][:, 0] += np.bincount(at, w, sizes[j])
                bins[j][:, 1] += np.bincount(at, wy, sizes[j])
        return np.concatenate([total.ravel(), *[b.ravel() for b in bins]])

    found = reduced(rows, many * 3 + 2 * int(sizes.sum()), work)
    ends = many * 3 + 2 * np.cumsum(sizes)
    return found[: many * 3].reshape(many, 3), [found[e - 2 * size : e].reshape(size, 2) for e, size in zip(ends, sizes)]


# -- histogram trees -----------------------------------------------------------------------------------------------


def summed(rows: DataFrame) -> DataFrame:
    """Per distinct features: count n, sum s and sum of squares q of the labels."""
    y = F.col("y")
    found = rows.groupBy("x").agg(F.count("*").cast("double").alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q"))
    return found.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def edges_of(rows: DataFrame, features: int) -> list[np.ndarray]:
    """Thresholds of every feature: all distinct values but the greatest, or quantiles of them where they are many."""
    shares = F.array(*[F.lit(i / (EDGES + 1)) for i in range(1, EDGES + 1)])
    cells = rows.select(F.posexplode("x").alias("f", "v")).distinct()
    found = cells.groupBy("f").agg(
        F.count("*").alias("kinds"), F.max("v").alias("most"), F.percentile_approx("v", shares, 10_000).alias("spread"))
    few = found.filter(F.col("kinds") <= EDGES + 1).select(F.col("f").alias("__f"))
    listed = cells.join(few, F.col("f") == F.col("__f")).groupBy("f").agg(F.array_sort(F.collect_list("v")).alias("v"))
    out = [np.zeros(0)] * features
    for r in found.collect():
        out[r["f"]] = np.unique([v for v in r["spread"] if v < r["most"]])
    for r in listed.collect():
        out[r["f"]] = np.array(r["v"][:-1], float)
    return out


@dataclass
class Grown:
    """A histogram tree with (count, first sum, second sum, sum of squares) of every node."""

    trees: Trees
    sums: np.ndarray = field(default_factory=lambda: np.zeros((1, 4)))


def histogram_tree(rows: DataFrame, edges: list[np.ndarray], derivatives, max_depth: int, min_n: float, min_child: float, penalty: float,
                   floor: float = 0.0, mtry: int | None = None, seed: int = 1) -> Grown:
    """One tree on sums of ``derivatives(x, n, s) -> (first, second)`` per bin; the rows are those of ``summed``.

    A split gains G_l^2 / (H_l + penalty) + G_r^2 / (H_r + penalty) - G^2 / (H + penalty), half of which must exceed
    ``floor``. Nodes below ``min_n`` rows stay, as do splits with a second sum below ``min_child`` on a side. Ties go
    to the first feature, then the smallest threshold. ``mtry`` features are drawn for a node.
    """
    features, wide = len(edges), max(1, max(len(e) for e in edges)) + 1
    grown = Grown(Trees.planted(1))
    open_ = np.array([0])
    path = np.ones(1, np.int64)
    for level in range(max_depth + 1):
        tree = grown.trees
        slots = np.full(len(tree.feature), -1)
        slots[open_] = np.arange(len(open_))
        many = len(open_)

        def work(batches, slots=slots, tree=tree, many=many):
            total = np.zeros((many * features * wide, 4))
            for x, n, s, q in blocks(batches, features, ("n", "s", "q")):
                slot = slots[tree.route(x)[:, 0]]
                some = np.flatnonzero(slot >= 0)
                x, n, s, q = x[some], n[some], s[some], q[some]
                first, second = derivatives(x, n, s)
                bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1)
                at = ((slot[some][:, None] * features + np.arange(features)) * wide + bins).ravel()
                for k, v in enumerate((n, first, second, q)):
                    total[:, k] += np.bincount(at, np.repeat(v, features), len(total))
            return total

        table = reduced(rows, many * features * wide * 4, work).reshape(many, features, wide, 4)
        own = table[:, 0].sum(1)
        grown.sums = np.concatenate([grown.sums, np.zeros((len(tree.feature) - len(grown.sums), 4))])
        grown.sums[open_] = own
        tree.weight[open_] = own[:, 0]
        if level == max_depth:
            break
        left = table.cumsum(2)[:, :, :-1]
        right = own[:, None, None] - left
        score = lambda s: s[..., 1] ** 2 / np.maximum(s[..., 2] + penalty, 1e-300)
        gain = score(left) + score(right) - score(own)[:, None, None]
        good = (left[..., 0] > 0) & (right[..., 0] > 0) & (left[..., 2] >= min_child) & (right[..., 2] >= min_child)
        if mtry is not None and mtry < features:
            draw = np.argsort(np.argsort(uniform(seed, 3, path[open_][:, None], np.arange(features)[None, :]), 1), 1)
            good &= (draw < mtry)[:, :, None]
        gain = np.where(good, gain, -np.inf).reshape(many, -1)
        # Sums in another order differ in the last digits; what differs by no more is a tie.
        best = (gain >= gain.max(1, keepdims=True) * (1 - 1e-12)).argmax(1)
        most = gain[np.arange(many), best]
        split = np.flatnonzero((own[:, 0] >= min_n) & (most / 2 > floor + 1e-12 * np.maximum(1.0, own[:, 3])))
        if len(split) == 0:
            break
        f, b = best[split] // (wide - 1), best[split] % (wide - 1)
        nodes = open_[split]
        first = tree.grown(nodes, f, np.array([edges[i][j] for i, j in zip(f, b)]), most[split])
        open_ = np.stack([first, first + 1], 1).ravel()
        path = np.concatenate([path, np.stack([2 * path[nodes], 2 * path[nodes] + 1], 1).ravel()])
    grown.sums = np.concatenate([grown.sums, np.zeros((len(grown.trees.feature) - len(grown.sums), 4))])
    return grown


def risks(sums: np.ndarray) -> np.ndarray:
    """Sum of squared errors around the mean of every node."""
    return sums[:, 3] - sums[:, 1] ** 2 / np.maximum(sums[:, 0], 1)


def weakest_links(tree: Trees, risk: np.ndarray) -> list[tuple[float, list[int], int, float]]:
    """The sequence of pruned trees: (penalty per leaf from which on, inner nodes cut there, leaves left, risk left).

    Of a tree, cutting a node's branch costs (risk of the node - risk of its leaves) / (leaves - 1) per leaf saved; the
    cheapest nodes are cut first, until the root is left.
    """
    feature = tree.feature.copy()
    out = []
    while feature[0] >= 0:
        leaves, below = np.ones(len(feature)), risk.copy()
        for node in range(len(feature) - 1, -1, -1):
            if feature[node] >= 0:
                a, b = tree.left[node], tree.left[node] + 1
                leaves[node], below[node] = leaves[a] + leaves[b], below[a] + below[b]
        reached, stack = [], [0]
        while stack:
            node = stack.pop()
            if feature[node] >= 0:
                reached.append(node)
                stack += [int(tree.left[node]), int(tree.left[node]) + 1]
        cost = {n: max(0.0, (risk[n] - below[n]) / (leaves[n] - 1)) for n in reached}
        least = min(cost.values())
        cut = [n for n in reached if cost[n] <= least * (1 + 1e-9)]
        for n in cut:
            feature[n] = -1
        left_leaves, left_risk, stack = 0, 0.0, [0]
        while stack:
            node = stack.pop()
            if feature[node] >= 0:
                stack += [int(tree.left[node]), int(tree.left[node]) + 1]
            else:
                left_leaves, left_risk = left_leaves + 1, left_risk + risk[node]
        out.append((float(least), sorted(cut), left_leaves, float(left_risk)))
    return out


def pruned(tree: Trees, risk: np.ndarray, penalty: float) -> Trees:
    """The smallest tree of least risk + penalty * leaves."""
    feature = tree.feature.copy()
    for price, cut, _, _ in weakest_links(tree, risk):
        if price > penalty:
            break
        feature[cut] = -1
    stack, keep = [0], {0}
    while stack:
        node = stack.pop()
        if feature[node] >= 0:
            children = [int(tree.left[node]), int(tree.left[node]) + 1]
            keep.update(children)
            stack += children
    gone = np.array([n not in keep for n in range(len(feature))])
    feature[gone] = -1
    gain = np.where(feature >= 0, tree.gain, 0.0)
    return Trees(tree.roots, feature, tree.threshold, tree.left, tree.value, tree.weight, gain, tree.depth)


def single(rows: DataFrame, features: int, max_depth: int, min_n: int, complexity: float) -> tuple[Trees, Grown]:
    """A tree on sums of squares, pruned at ``complexity`` times the risk of the root, and the tree before."""
    rows = summed(rows).persist()
    try:
        grown = histogram_tree(rows, edges_of(rows, features), lambda x, n, s: (s, n), max_depth, min_n, max(1, round(min_n / 3)), 0.0)
    finally:
        rows.unpersist()
    sums = grown.sums
    grown.trees.value = sums[:, 1] / np.maximum(sums[:, 0], 1)
    risk = risks(sums)
    return pruned(grown.trees, risk, complexity * risk[0]), grown


def boosted(rows: DataFrame, features: int, rounds: int, rate: float, max_depth: int, penalty: float = 1.0, floor: float = 0.0,
            min_child: float = 1.0, mtry: int | None = None, seed: int = 1) -> tuple[float, Trees]:
    """(start, trees): each tree takes a step against the derivatives of the squared error of those before."""
    rows = summed(rows).persist()
    try:
        return _boosted(rows, features, rounds, rate, max_depth, penalty, floor, min_child, mtry, seed)
    finally:
        rows.unpersist()


def _boosted(rows, features, rounds, rate, max_depth, penalty, floor, min_child, mtry, seed) -> tuple[float, Trees]:
    start = rows.agg(F.sum("s") / F.sum("n")).first()[0]
    if start is None:
        return 0.0, Trees.planted(1)
    edges, parts = edges_of(rows, features), []
    for turn in range(rounds):
        before = joined(parts) if parts else None

        def derivatives(x, n, s, before=before):
            now = before.predict(x, start, rate) if before else np.full(len(x), start)
            return n * now - s, n

        grown = histogram_tree(rows, edges, derivatives, max_depth, 0, min_child, penalty, floor, mtry, seed + turn)
        grown.trees.value = -grown.sums[:, 1] / (grown.sums[:, 2] + penalty)
        parts.append(grown.trees)
    return float(start), joined(parts)


# -- stages --------------------------------------------------------------------------------------------------------


class TreesModel(Model, HasFeaturesCol, HasPredictionCol):
    """Predicts ``start`` plus ``share`` times the sum of the leaves."""

    def __init__(self, trees: Trees, features: int, start: float, share: float, settings: dict):
        super().__init__()
        self.trees, self.features, self.start, self.share, self.settings = trees, features, start, share, settings

    def setPredictionCol(self, value: str) -> TreesModel:
        return self._set(predictionCol=value)

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.trees.importance(self.features))

    def getNumTrees(self) -> int:
        return len(self.trees.roots)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, start, share = self.trees.routing(value=True), self.start, self.share

        @F.arrow_udf("double")
        def predicted(v: pa.Array) -> pa.Array:
            good = np.flatnonzero(np.asarray(v.is_valid()))
            out = np.full(len(v), np.nan)
            if len(good):
                x = np.asarray(v.take(pa.array(good)).flatten()).reshape(len(good), -1)
                first = _starts(x)
                out[good] = np.repeat(trees.predict(x[first], start, share), np.diff(np.append(first, len(x))))
            return pa.array(out, pa.float64(), mask=np.isnan(out))

        return dataset.withColumn(self.getPredictionCol(), predicted(vector_to_array(self.getFeaturesCol())))


class _TreesEstimator(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    def __init__(self, labelCol: str, featuresCol: str = "features", **settings):
        super().__init__()
        self._set(labelCol=labelCol, featuresCol=featuresCol)
        self.settings = settings

    def _rows(self, dataset: DataFrame) -> tuple[DataFrame, int]:
        rows = rows_of(dataset, self.getFeaturesCol(), self.getLabelCol())
        return rows, int(rows.agg(F.max(F.size("x"))).first()[0] or 0)

    def _model(self, trees: Trees, features: int, start: float, share: float) -> TreesModel:
        model = TreesModel(trees, features, start, share, self.settings)
        return model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())


class RandomisedTrees(_TreesEstimator):
    """Settings: trees, mtry, min_n, max_depth, seed, replace."""

    def getNumTrees(self) -> int:
        return self.settings["trees"]

    def _fit(self, dataset: DataFrame) -> TreesModel:
        rows, features = self._rows(dataset)
        trees = randomised(rows, features, **self.settings)
        return self._model(trees, features, 0.0, 1.0 / len(trees.roots))


class DefaultForest(_TreesEstimator):
    """Spark's forest with its default settings. It keeps a count per row and tree and routes every row down every tree, so
    tables of many rows grow it here by the same rules, from counts of equal rows. Settings: trees, seed."""

    def getNumTrees(self) -> int:
        return self.settings["trees"]

    def _fit(self, dataset: DataFrame) -> Model:
        if dataset.count() <= FEW:
            columns = {"featuresCol": self.getFeaturesCol(), "labelCol": self.getLabelCol(), "predictionCol": self.getPredictionCol()}
            return RandomForestRegressor(numTrees=self.settings["trees"], seed=self.settings["seed"], **columns).fit(dataset)
        rows, features = self._rows(dataset)
        trees = bagged(rows, features, **self.settings)
        return self._model(trees, features, 0.0, 1.0 / len(trees.roots))


class PrunedTree(_TreesEstimator):
    """Settings: max_depth, min_n, complexity."""

    def _fit(self, dataset: DataFrame) -> TreesModel:
        rows, features = self._rows(dataset)
        return self._model(single(rows, features, **self.settings)[0], features, 0.0, 1.0)


class SecondOrderBoosting(_TreesEstimator):
    """Settings: rounds, rate, max_depth, penalty, floor, min_child, mtry, seed."""

    def getMaxIter(self) -> int:
        return self.settings["rounds"]

    def _fit(self, dataset: DataFrame) -> TreesModel:
        rows, features = self._rows(dataset)
        start, trees = boosted(rows, features, **self.settings)
        return self._model(trees, features, start, self.settings["rate"])
