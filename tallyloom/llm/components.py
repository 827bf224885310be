"""Connected components of a graph given by its links, as joins and aggregates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) with the same components as the given links; at most one per node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while (jump := new[new]).tobytes() != new.tobytes():
            new = jump
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a long, b long); the root is the smallest node of its component.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one, then its
    smaller neighbours. The rounds grow with the logarithm of the longest chain. Every round is written to the shared
    scratch folder. A node with many neighbours is only a join key, whose partition the adaptive planner may split.
    """
    pairs = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi > lo").distinct()
    before = None
    while True:
        pairs = stored(pairs, "links")
        state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(30,0)"))).first())
        if state == before or state[0] == 0:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = state
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(pairs.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        larger = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        smallest = larger.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("w"), "m")
        joined = larger.join(smallest, F.col("hi") == F.col("w"))
        pairs = (
            joined.select("lo", "m").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionAll(smallest.select(F.col("w").alias("hi"), F.col("m").alias("lo"))).distinct()
        )
