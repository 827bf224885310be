"""Feed-forward networks of many sizes and folds, trained in common passes over the rows.

The starting weights, the loss and the steps are those of Spark's network: sigmoid layers, softmax on top, the mean over
blocks of rows of their mean cross-entropy, and L-BFGS with a strong Wolfe search. All networks advance together. A pass
reads the rows once and returns loss and gradient of every open network, each over the rows outside its fold. A fit hands
out its weights on the way, so that a longer fit covers the shorter ones.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .partials import reduced

#: Rows of a block of Spark's network; the last block of a partition has fewer.
BLOCK = 128
#: Rows that a task multiplies at a time.
ROWS = 16 * BLOCK
MEMORY = 10
TOLERANCE = 1e-6
SUFFICIENT, CURVATURE, TRIES = 1e-4, 0.9, 10

Evaluated = tuple[float, np.ndarray]
Network = tuple[Sequence[int], int, np.ndarray]


class _NoStep(ArithmeticError):
    """No step could be found from here."""


def rows_of(data: DataFrame, label: str, fold: str) -> DataFrame:
    """Features as arrays with label and fold; what all passes read."""
    return data.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("f"))


def gradient(layers: Sequence[int], weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of the rows and its gradient."""
    outputs, parts, at = [x], [], 0
    for k, (n_in, n_out) in enumerate(zip(layers, layers[1:])):
        w = weights[at : at + n_in * n_out].reshape(n_in, n_out)
        z = outputs[-1] @ w
        z += weights[at + n_in * n_out : at + (n_in + 1) * n_out]
        if k < len(layers) - 2:
            np.negative(z, out=z)
            np.exp(z, out=z)
            z += 1
            np.reciprocal(z, out=z)
        else:
            z = np.exp(z - z.max(1, keepdims=True))
            z /= z.sum(1, keepdims=True)
        outputs.append(z)
        parts.append((at, w))
        at += (n_in + 1) * n_out
    target = (y[:, None] == np.arange(layers[-1])).astype(float)
    loss = -float((target * np.log(outputs[-1])).sum())
    total, delta = np.empty(at), outputs[-1] - target
    for k in range(len(parts) - 1, -1, -1):
        at, w = parts[k]
        total[at : at + w.size] = (outputs[k].T @ delta).ravel()
        total[at + w.size : at + w.size + w.shape[1]] = delta.sum(0)
        if k:
            delta = delta @ w.T
            delta *= outputs[k]
            delta *= 1 - outputs[k]
    return loss, total


def blocks(batches: Iterator[pa.RecordBatch], folds: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(fold, features, labels, rows of a block): whole blocks of the rows outside each fold, at last the shorter ones."""
    rest: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)
        y, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "f"))
        for fold in folds:
            keep = own != fold
            xs, ys = x[keep], y[keep]
            if fold in rest:
                xs, ys = np.concatenate([rest[fold][0], xs]), np.concatenate([rest[fold][1], ys])
            full = len(xs) // BLOCK * BLOCK
            for at in range(0, full, ROWS):
                yield fold, xs[at : min(at + ROWS, full)], ys[at : min(at + ROWS, full)], BLOCK
            rest[fold] = xs[full:], ys[full:]
    for fold, (xs, ys) in rest.items():
        if len(xs):
            yield fold, xs, ys, len(xs)


def evaluated(rows: DataFrame, networks: Sequence[Network]) -> list[Evaluated]:
    """Loss and gradient of networks (layers, fold left out, weights) from one pass over the rows."""
    folds = sorted({fold for _, fold, _ in networks})
    ends = np.cumsum([2 + len(w) for _, _, w in networks])

    def partial(batches):
        total = np.zeros(ends[-1])
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            for fold, x, y, block in blocks(batches, folds):
                for end, (layers, left_out, weights) in zip(ends, networks):
                    if left_out == fold:
                        loss, slope = gradient(layers, weights, x, y)
                        own = total[end - len(slope) - 2 : end]
                        own[0] += len(x) / block
                        own[1] += loss / block
                        own[2:] += slope / block
        return total

    sums = np.split(reduced(rows, int(ends[-1]), partial), ends[:-1])
    with np.errstate(divide="ignore", invalid="ignore"):
        return [(float(s[1] / s[0]), s[2:] / s[0]) for s in sums]


def _direction(grad: np.ndarray, moves: Sequence[np.ndarray], turns: Sequence[np.ndarray]) -> np.ndarray:
    """Steepest descent, bent by the last moves and the turns of the gradient in them; latest first."""
    out, shares, products = grad.copy(), [], []
    for move, turn in zip(moves, turns):
        products.append(move @ turn)
        shares.append((move @ out) / products[-1])
        if np.isnan(shares[-1]):
            raise _NoStep
        out -= shares[-1] * turn
    if moves:
        if not products[0] >= 0:
            raise _NoStep
        out *= products[0] / (turns[0] @ turns[0])
    for move, turn, share, product in reversed([*zip(moves, turns, shares, products)]):
        out += (share - (turn @ out) / product) * move
    return -out


def _between(a: tuple, b: tuple) -> float:
    """Minimum of the cubic through two points (step, value, slope), not too near to either."""
    (t0, v0, s0), (t1, v1, s1) = sorted((a, b), key=lambda p: p[0])
    d1 = s0 + s1 - 3 * (v0 - v1) / (t0 - t1)
    d2 = np.sqrt(d1 * d1 - s0 * s1)
    t = t1 - (t1 - t0) * (s1 + d2 - d1) / (s1 - s0 + 2 * d2)
    low, high = t0 + 0.1 * (t1 - t0), t0 + 0.9 * (t1 - t0)
    return low if t < low else high if t > high else float(t)


def _line_search(x: np.ndarray, value: float, grad: np.ndarray, way: np.ndarray, t: float) -> Generator[np.ndarray, Evaluated, tuple]:
    """Step that meets the strong Wolfe conditions, from ``t`` on, and the point, loss and gradient there."""
    slope = float(grad @ way)
    if slope > 0:
        raise _NoStep
    low = (0.0, value, slope)

    def short(c):
        return c[1] > value + SUFFICIENT * c[0] * slope

    for i in range(TRIES):
        to = x + way * t
        new, new_grad = yield to
        if not np.isfinite(new):
            t /= 2
            continue
        c = (t, new, float(new_grad @ way))
        if short(c) or (new >= low[1] and i > 0):
            high = c
            break
        if abs(c[2]) <= CURVATURE * abs(slope):
            return t, to, new, new_grad
        if c[2] >= 0:
            low, high = c, low
            break
        low, t = c, t * 1.5
    else:
        raise _NoStep
    for _ in range(TRIES):
        t = _between(low, high)
        to = x + way * t
        new, new_grad = yield to
        c = (t, new, float(new_grad @ way))
        if short(c) or new >= low[1]:
            high = c
            continue
        if abs(c[2]) <= CURVATURE * abs(slope):
            return t, to, new, new_grad
        if c[2] * (high[0] - low[0]) >= 0:
            high = low
        low = c
    raise _NoStep


def descent(x: np.ndarray, marks: Sequence[int]) -> Generator[np.ndarray, Evaluated, dict[int, np.ndarray]]:
    """Yields points, is sent loss and gradient there; returns the weights after as many steps as each mark says.

    A fit that converges earlier has the same weights for all later marks.
    """
    value, grad = yield x
    first, lately, moves, turns = value, [np.inf], [], []
    done, failed, found = 0, False, {}
    while True:
        found |= {m: x for m in marks if m <= done and m not in found}
        still = len(lately) > 1 and abs(value - max(lately)) <= TOLERANCE * abs(first)
        if len(found) == len(set(marks)) or still or np.linalg.norm(grad) <= max(TOLERANCE * abs(value), 1e-8):
            break
        try:
            way = _direction(grad, moves, turns)
            t, to, new, new_grad = yield from _line_search(x, value, grad, way, 1.0 if done else 1 / np.linalg.norm(way))
            if t * np.linalg.norm(grad) < 1e-10:
                raise _NoStep
        except _NoStep:
            if failed:
                break
            failed, moves, turns = True, [], []
            continue
        moves, turns = [to - x, *moves][:MEMORY], [new_grad - grad, *turns][:MEMORY]
        x, value, grad, done, failed = to, new, new_grad, done + 1, False
        lately = [*lately, value][-20:]
    return {m: found.get(m, x) for m in marks}


def fit_all(rows: DataFrame, wanted: Sequence[tuple[Sequence[int], int, np.ndarray, Sequence[int]]]) -> list[dict[int, np.ndarray]]:
    """Weights after each number of steps, for networks (layers, fold left out, starting weights, numbers of steps)."""
    fits = [descent(start, marks) for _, _, start, marks in wanted]
    points = {i: next(fit) for i, fit in enumerate(fits)}
    out: list[dict[int, np.ndarray]] = [{} for _ in fits]
    while points:
        found = evaluated(rows, [(wanted[i][0], wanted[i][1], w) for i, w in points.items()])
        for i, pair in zip([*points], found):
            try:
                points[i] = fits[i].send(pair)
            except StopIteration as end:
                out[i] = end.value
                del points[i]
    return out


def _two_rows(spark: SparkSession, n_features: int, label: str) -> DataFrame:
    return spark.createDataFrame([(Vectors.dense([0.0] * n_features), float(v)) for v in (0, 1)], ["features", label]).coalesce(1)


def model_with(spark: SparkSession, estimator: MultilayerPerceptronClassifier, weights: np.ndarray | None = None) -> MultilayerPerceptronClassificationModel:
    """Spark's model with these weights, or with those it starts from: a fit without steps."""
    own = estimator.copy({estimator.maxIter: 0} | ({} if weights is None else {estimator.initialWeights: Vectors.dense(weights)}))
    return own.fit(_two_rows(spark, estimator.getLayers()[0], estimator.getLabelCol()))
