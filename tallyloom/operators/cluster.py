"""k-means with restarts, scans over k, cluster tables and a two-dimensional projection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import manymeans
from .joins import left_lookup
from .projection import leading_components, scores

FEATURES = "features"
CLUSTER = "cluster"


@dataclass
class Clustering:
    """Best of several restarts for one k, with its centers."""

    k: int
    withinss: float
    totss: float
    iterations: int
    centers: np.ndarray | None

    @property
    def betweenss(self) -> float:
        return self.totss - self.withinss


def total_ss(vectors: DataFrame) -> float:
    """Sum of squared distances to the overall mean, from one aggregate."""
    row = vectors.select(Summarizer.metrics("variance", "count").summary(F.col(FEATURES)).alias("s")).first()["s"]
    return float(sum(row["variance"])) * (row["count"] - 1) if row["count"] > 1 else 0.0


def kmeans(vectors: DataFrame, k: int, restarts: int = 100, seed: int = 1, max_iter: int = 20, totss: float | None = None) -> Clustering:
    """Fit with several seeds and keep the smallest total within-cluster sum of squares."""
    return scan(vectors, [(k, restarts)], seed, max_iter, totss=totss)[0]


def scan(
    vectors: DataFrame, wanted: Iterable[tuple[int, int]], seed: int = 1, max_iter: int = 20, totss: float | None = None
) -> list[Clustering]:
    """Best clustering for every pair (k, restarts). The vectors should be persisted.

    All restarts of all k advance in common passes (see ``manymeans``). With k = 1 the center is the mean.
    """
    wanted = list(wanted)
    totss = total_ss(vectors) if totss is None else totss
    jobs = [(k, seed + r) for k, restarts in wanted for r in range(restarts if k > 1 else 1)]
    fits = manymeans.fit_all(vectors, jobs, FEATURES, max_iter)
    out = []
    for k, _ in wanted:
        own = [f for j, f in zip(jobs, fits) if j[0] == k]
        centers, within, steps = min(own, key=lambda f: f[1]) if own else (None, 0.0, 0)
        out.append(Clustering(k, totss if k == 1 else within, totss, steps, centers))
    return out


def scree_table(spark: SparkSession, found: Sequence[Clustering]) -> DataFrame:
    rows = [(c.k, c.totss, c.withinss, c.betweenss, c.iterations) for c in found]
    return spark.createDataFrame(rows, "k int, totss double, withinss double, betweenss double, iterations int")


#: Bytes of centers that are sent to every task; they are a parameter of a model, not rows.
CENTER_BYTES = 256 << 20


def nearest(x: Column, numbers: Sequence[int], centers: np.ndarray) -> Column:
    """(cluster, distance) of the nearest center of an array column, by one matrix product per batch.

    Ties go to the smaller number; a missing or empty vector has neither.
    """
    order = np.argsort(numbers, kind="stable")
    numbers, centers = np.asarray(numbers, np.int64)[order], np.ascontiguousarray(np.asarray(centers, np.float64)[order])
    if centers.nbytes > CENTER_BYTES:
        raise ValueError(f"centers of over {CENTER_BYTES} bytes")
    square = (centers**2).sum(1)

    @F.arrow_udf("cluster int, distance double")
    def found(v: pa.Array) -> pa.Array:
        good = np.flatnonzero(np.asarray(v.is_valid()))
        near, far = np.zeros(len(v), np.int64), np.zeros(len(v))
        flat = np.asarray(v.take(pa.array(good)).flatten()).reshape(len(good), -1) if len(good) else np.zeros((0, 1))
        step = max(1, (1 << 22) // max(1, len(centers)))
        for at in range(0, len(flat), step):
            rows = flat[at : at + step]
            own = (square - 2 * rows @ centers.T).argmin(1)
            near[good[at : at + step]] = own
            far[good[at : at + step]] = np.sqrt(((rows - centers[own]) ** 2).sum(1))
        absent = np.ones(len(v), bool)
        absent[good] = False
        return pa.StructArray.from_arrays([pa.array(numbers[near], pa.int32(), mask=absent), pa.array(far, pa.float64(), mask=absent)], ["cluster", "distance"])

    return found(x)


def assign(vectors: DataFrame, centers: np.ndarray) -> DataFrame:
    """Cluster number per row, from 1."""
    found = nearest(vector_to_array(FEATURES), range(1, len(centers) + 1), centers)
    return vectors.withColumn("__near", found).withColumn(CLUSTER, F.col("__near.cluster")).drop("__near")


def centers_table(spark: SparkSession, assigned: DataFrame, centers: np.ndarray) -> DataFrame:
    """Coordinates, size and within-cluster sum of squares per cluster."""
    rows = [(i + 1, [float(v) for v in c]) for i, c in enumerate(centers)]
    table = spark.createDataFrame(rows, f"{CLUSTER} int, center array<double>")
    return table.join(within_ss(assigned.withColumn("__x", vector_to_array(FEATURES)), "__x", CLUSTER, rows), CLUSTER)


def squared_distance(x: Column, y: Column) -> Column:
    """Of two arrays."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def within_ss(df: DataFrame, array: str, cluster: str, centers: Sequence[tuple]) -> DataFrame:
    """Size and sum of squared distances to the own center, per cluster."""
    table = df.sparkSession.createDataFrame([(i, [float(v) for v in c]) for i, c in centers], "__i long, __c array<double>")
    # One row per center, as many as the model has.
    met = df.join(F.broadcast(table) if len(centers) < 10_000 else table, F.col(cluster) == F.col("__i"), "left")
    distance = squared_distance(F.col(array).cast("array<double>"), F.col("__c"))
    return met.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), F.sum(distance).alias("withinss"))


def nearest_center(df: DataFrame, array: str, centers: Sequence[tuple], name: str = CLUSTER) -> DataFrame:
    """Nearest of some given centers ``(number, coordinates)`` and its distance; the smaller number wins a tie."""
    numbers, points = [i for i, _ in centers], np.array([c for _, c in centers], np.float64)
    found = df.withColumn("__near", nearest(F.col(array).cast("array<double>"), numbers, points))
    return found.withColumns({name: F.col("__near.cluster"), "distance": F.col("__near.distance")}).drop("__near")


def mean_centers(df: DataFrame, array: str, by: str) -> list[tuple]:
    """Mean vector per group, for use as fixed centers."""
    vector = array_to_vector(F.col(array).cast("array<double>"))
    means = df.filter(F.col(array).isNotNull()).groupBy(by).agg(Summarizer.mean(vector).alias("c"))
    return sorted((r[by], r["c"].toArray().tolist()) for r in means.collect())


def project_2d(vectors: DataFrame, ids: Sequence[str]) -> DataFrame:
    """First two principal components per row."""
    return scores(vectors, leading_components(vectors, 2, FEATURES), ids, ["x", "y"], FEATURES)


def segments(vectors: DataFrame, centers: np.ndarray, key: str, attributes: DataFrame) -> DataFrame:
    """Projection, cluster and attributes side by side, with a label text."""
    reduced = project_2d(assign(vectors, centers), [key, CLUSTER])
    label = F.format_string("Customer: %s\nCluster: %s", F.col(key).cast("string"), F.col(CLUSTER).cast("string"))
    return left_lookup(reduced, attributes, [key]).withColumn("label_text", label)
