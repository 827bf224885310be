"""Near-duplicates among vectors by an epsilon grid order join.

Unit vectors with cosine c are sqrt(2 - 2 c) apart; that distance is the side of the grid. Vectors are projected on
the leading principal axes (a rotation, so distances of projections are lower bounds) and sorted by the cells of the
leading axes, label first. Ranges of that order are the sequences to join: a pair is visited only where the cells and
bounding boxes permit a link. A visit halves the longer sequence again and again, drops pairs whose boxes are further
apart than the side, and compares what is left by one matrix product per leaf.

Vectors that are equal are one entry with a number. Leaves count links and give a spanning forest, they never list them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import connected, forest
from .topk import usable

#: Rows from which the principal axes are fitted; the axes decide how much is skipped, never what is found.
AXES_FROM = 4096
CELLS, AXES = 3, 8
SEQUENCE, LEAF = 2048, 256


def principal_axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """Leading axes by dimension from a bounded sample in hash order."""
    sample = rows.orderBy(F.xxhash64("node")).limit(AXES_FROM).select("v").collect()
    by_dim: dict[int, list] = {}
    for (v,) in sample:
        by_dim.setdefault(len(v), []).append(v)
    axes = {}
    for dim, vectors in by_dim.items():
        unit = units(np.array(vectors, float))
        axes[dim] = np.linalg.eigh(np.cov(unit.T).reshape(dim, dim) if len(unit) > 1 else np.eye(dim))[1][:, ::-1][:, : min(AXES, dim)]
    return axes


def units(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def axes_of(axes: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return axes[dim] if dim in axes else np.eye(dim)[:, : min(AXES, dim)]  # any orthonormal axes are right


def vectors_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.diff(np.asarray(column.offsets))
    return size, np.cumsum(size) - size, np.asarray(column.flatten())


def with_cells(rows: DataFrame, axes: dict[int, np.ndarray], side: float) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            size, start, flat = vectors_of(batch.column("v"))
            cells = np.zeros((len(size), CELLS), np.int32)
            for dim in np.unique(size).tolist():
                r = np.flatnonzero(size == dim)
                p = units(flat[start[r][:, None] + np.arange(dim)]) @ axes_of(axes, dim)
                c = np.floor(p[:, :CELLS] / side).astype(np.int32)
                cells[r[:, None], np.arange(c.shape[1])] = c
            out = [batch.column(c) for c in ("node", "many", "label", "v")] + [pa.array(cells[:, i]) for i in range(CELLS)]
            yield pa.RecordBatch.from_arrays(out, names=["node", "many", "label", "v", *(f"x{i}" for i in range(CELLS))])

    return rows.select("node", "many", "label", "v").mapInArrow(work, "node long, many long, label string, v array<double>, x0 int, x1 int, x2 int")


PIECE_SQL = "label string, dim int, low int, high int, box_low array<double>, box_high array<double>, nodes binary, many binary, data binary, name long"


def sequences(batches: Iterator[pa.RecordBatch], axes: dict[int, np.ndarray]):
    """The range of a partition as packed sequences, one per label and dimension."""
    from pyspark import TaskContext

    held = [b for b in batches if b.num_rows]  # a range has a bounded number of rows
    if not held:
        return
    table = pa.Table.from_batches(held)
    table = table.sort_by([("label", "ascending"), ("x0", "ascending"), ("x1", "ascending"), ("x2", "ascending")]).combine_chunks()
    label = table.column("label").to_pylist()
    size, start, flat = vectors_of(table.column("v").chunk(0))
    node, many, x0 = (np.asarray(table.column(c).chunk(0)) for c in ("node", "many", "x0"))
    kinds: dict[tuple[str, int], list[int]] = {}
    for i, (a, b) in enumerate(zip(label, size.tolist())):
        kinds.setdefault((a, b), []).append(i)
    number = 0
    for (name, dim), rows in kinds.items():
        for at in range(0, len(rows), SEQUENCE):
            r = np.array(rows[at : at + SEQUENCE])
            unit = units(flat[start[r][:, None] + np.arange(dim)])
            p = unit @ axes_of(axes, dim)
            values = [name, dim, int(x0[r].min()), int(x0[r].max()), p.min(axis=0).tolist(), p.max(axis=0).tolist(), node[r].tobytes(), many[r].tobytes(),
                      unit.tobytes(), (TaskContext.get().partitionId() << 32) + number]
            types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)],
                                             names=["label", "dim", "low", "high", "box_low", "box_high", "nodes", "many", "data", "name"])


class Visit:
    """Joins two sequences by halving; keeps counts per row and the forest of links."""

    def __init__(self, a, b, axes: np.ndarray, side: float, least: float):
        (self.na, self.ma, self.a), (self.nb, self.mb, self.b) = a, b
        self.pa, self.pb = self.a @ axes, self.b @ axes
        self.same = len(self.na) == len(self.nb) and (self.na == self.nb).all()
        self.side, self.least = side, least
        self.links_a, self.links_b = np.zeros(len(self.na), np.int64), np.zeros(len(self.nb), np.int64)
        self.u: list[np.ndarray] = []
        self.v: list[np.ndarray] = []

    def join(self, a0: int, a1: int, b0: int, b1: int) -> None:
        if self.same and b1 <= a0:
            return  # the mirror image is visited
        low_a, high_a = self.pa[a0:a1].min(axis=0), self.pa[a0:a1].max(axis=0)
        low_b, high_b = self.pb[b0:b1].min(axis=0), self.pb[b0:b1].max(axis=0)
        gap = np.maximum(0, np.maximum(low_b - high_a, low_a - high_b))
        if gap @ gap > self.side * self.side * (1 + 1e-9):
            return
        if max(a1 - a0, b1 - b0) > LEAF:
            if a1 - a0 >= b1 - b0:
                middle = (a0 + a1) // 2
                self.join(a0, middle, b0, b1)
                self.join(middle, a1, b0, b1)
            else:
                middle = (b0 + b1) // 2
                self.join(a0, a1, b0, middle)
                self.join(a0, a1, middle, b1)
            return
        near = self.a[a0:a1] @ self.b[b0:b1].T >= self.least
        if self.same:
            near &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)[None, :]
        r, c = np.nonzero(near)
        if len(r) == 0:
            return
        self.links_a[a0:a1] += near @ self.mb[b0:b1]
        self.links_b[b0:b1] += self.ma[a0:a1] @ near
        u, v = forest(self.na[a0:a1][r], self.nb[b0:b1][c])
        self.u.append(u)
        self.v.append(v)


def joined(batches: Iterator[pa.RecordBatch], axes: dict[int, np.ndarray], side: float, least: float):
    """Partitions hold whole pairs in the order (i, j, side). Rows: links of a node (b null), or a link of the forest."""
    held = None
    for batch in batches:
        for i, j, which, dim, nodes, many, data in zip(*(batch.column(c) for c in ("i", "j", "side", "dim", "nodes", "many", "data"))):
            i, j, dim = i.as_py(), j.as_py(), dim.as_py()
            own = (np.frombuffer(nodes.as_py(), np.int64), np.frombuffer(many.as_py(), np.int64), np.frombuffer(data.as_py(), np.float64).reshape(-1, dim))
            if i != j and which.as_py() == 0:
                held = own
                continue
            visit = Visit(own if i == j else held, own, axes_of(axes, dim), side, least)
            visit.join(0, len(visit.na), 0, len(visit.nb))
            for node, links in ((visit.na, visit.links_a), (visit.nb, visit.links_b)):
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.nulls(len(some), pa.int64()), pa.array(links[some])], names=["a", "b", "links"])
            if visit.u:
                u, v = forest(np.concatenate(visit.u), np.concatenate(visit.v))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.nulls(len(u), pa.int64())], names=["a", "b", "links"])


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept, a row per input row.

    Vectors link when their labels are equal and not null and their cosine in double precision is ``least`` or more.
    Null vectors, zero vectors, empty ones and those with null or non-finite components link with nothing, and vectors
    of different lengths do not meet; such a row is its own component. Rows that repeat an id stay separate rows. Rows
    without id take part; they are not kept, and their component may have no id. An empty table gives an empty
    result. Other columns are not read.
    """
    side = float(np.sqrt(2 - 2 * least))
    cast = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), cast.alias("v"), F.col(label_col).cast("string").alias("label"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("part", F.coalesce(sound & F.col("label").isNotNull(), F.lit(False)))
    classes = rows.filter("part").groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("many"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    axes = principal_axes(classes)
    n = classes.count()
    celled = with_cells(classes, axes, side).repartitionByRange(max(1, -(-n // SEQUENCE), min(12, n // LEAF)), "label", "x0", "x1", "x2", "node")
    pieces = stored(celled.mapInArrow(lambda it: sequences(it, axes), PIECE_SQL), "sequences")
    narrow = pieces.select("label", "dim", "name", "low", "high", "box_low", "box_high")
    one = narrow.select(F.col("label").alias("l"), F.col("dim").alias("d"), F.col("name").alias("i"), F.col("box_low").alias("al"), F.col("box_high").alias("ah"),
                        F.explode(F.sequence(F.col("low") - 1, F.col("high") + 1)).alias("p"))
    two = narrow.select("label", "dim", F.col("name").alias("j"), F.col("box_low").alias("bl"), F.col("box_high").alias("bh"), F.explode(F.sequence("low", "high")).alias("q"))
    gaps = F.zip_with(F.zip_with("bl", "ah", lambda x, y: x - y), F.zip_with("al", "bh", lambda x, y: x - y), lambda x, y: F.greatest(F.lit(0.0), x, y))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)
    pairs = one.join(two, (F.col("l") == F.col("label")) & (F.col("d") == F.col("dim")) & (F.col("p") == F.col("q")))
    pairs = pairs.filter((F.col("i") <= F.col("j")) & (apart <= side * side * (1 + 1e-9))).select("i", "j").distinct()
    body = pieces.select("name", "dim", "nodes", "many", "data")
    first = pairs.join(body, F.col("i") == F.col("name")).withColumn("side", F.lit(0))
    second = pairs.filter("i < j").join(body, F.col("j") == F.col("name")).withColumn("side", F.lit(1))
    spread = max(12, 4 * -(-n // SEQUENCE))
    dealt = first.unionByName(second).drop("name").repartition(spread, "i", "j").sortWithinPartitions("i", "j", "side")
    found = stored(dealt.mapInArrow(lambda it: joined(it, axes, side, least), "a long, b long, links long"), "found")
    links = found.filter("links is not null").groupBy("a").agg(F.sum("links").alias("links"))
    roots = connected(found.filter("b is not null").select("a", "b"))
    placed = classes.select("node", "label", "v", "least", "many").join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    placed = placed.join(links, F.col("node") == F.col("a"), "left").select(
        F.col("label").alias("l"), F.col("v").alias("w"), "least", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"))
    heads = placed.groupBy("root").agg(F.min("least").alias("component")).withColumnRenamed("root", "r")
    named = placed.join(heads, F.col("root") == F.col("r")).select("l", "w", "n_links", "component")
    out = rows.filter("part").join(named, (F.col("label") == F.col("l")) & (F.col("v") == F.col("w"))).select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = rows.filter("not part").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
