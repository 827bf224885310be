"""Exact top-k search by tiled matrix products.

Candidates are dealt into shards; every tile of queries visits every shard. A visit is one matrix product and a partial
selection of the best scores, then the lists of a tile are merged in a tree of bounded fan. Only ids and scores of the
lists move after the first step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD = 1 << 14
TILE = 256
FAN = 16
LONG = (1 << 63) - 1

SENT_SQL = "shard int, kind byte, tile long, dim int, ids binary, data binary"
LISTS_SQL = "tile long, node int, queries binary, places binary, ids binary, scores binary"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and the vector in double precision, of rows that take part."""
    cast = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), cast.alias("v")).filter("vec_id is not null and v is not null and size(v) > 0")
    return rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))


def matrices(batches: Iterator[pa.RecordBatch], scale: float, most: int):
    """(dim, ids, scaled floors) of the rows of a partition, at most ``most`` rows each."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    count: dict[int, int] = {}
    for batch in batches:
        ids, lists = np.asarray(batch.column("vec_id")), batch.column("v")
        size = np.diff(np.asarray(lists.offsets))
        flat = np.floor(np.asarray(lists.flatten()) * scale)
        start = np.cumsum(size) - size
        for dim in np.unique(size).tolist():
            rows = np.flatnonzero(size == dim)
            for at in range(0, len(rows), most):
                some = rows[at : at + most]
                held.setdefault(dim, []).append((ids[some], flat[start[some][:, None] + np.arange(dim)]))
                count[dim] = count.get(dim, 0) + len(some)
                if count[dim] >= most:
                    yield dim, *map(np.concatenate, zip(*held.pop(dim)))
                    count[dim] = 0
    for dim, parts in held.items():
        yield dim, *map(np.concatenate, zip(*parts))


def scores_of(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products: doubles where no sum leaves the whole numbers they hold, else Python's."""
    dim = queries.shape[1]
    if float(np.abs(queries).max(initial=0)) * float(np.abs(shard).max(initial=0)) * dim < 2.0**53:
        return (queries @ shard.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return np.clip(whole(queries) @ whole(shard).T, -LONG, LONG).astype(np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of one row, ties to the smaller id; ids are ascending."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, at = np.flatnonzero(scores > edge), np.flatnonzero(scores == edge)
        chosen = np.concatenate([above, at[: k - len(above)]])
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))][:k]


def visited(batches: Iterator[pa.RecordBatch], k: int):
    """Shards come first in a partition, then the tiles of queries stream by."""
    shards: list[tuple[int, np.ndarray, np.ndarray]] = []
    for batch in batches:
        for shard, kind, tile, dim, ids, data in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4), batch.column(5)):
            ids = np.frombuffer(ids.as_py(), np.int64)
            m = np.frombuffer(data.as_py(), np.float64).reshape(-1, dim)
            if kind == 0:
                order = np.argsort(ids, kind="stable")
                shards.append((dim, ids[order], m[order]))
                continue
            for d, own, rows in shards:
                if d != dim:
                    continue
                all_scores = scores_of(m, rows)
                out_i, out_s, places = [], [], []
                for q, (query, s) in enumerate(zip(ids.tolist(), all_scores)):
                    lo, hi = np.searchsorted(own, query), np.searchsorted(own, query, "right")
                    if hi > lo:  # not the query itself
                        pick = best(np.delete(own, slice(lo, hi)), np.delete(s, slice(lo, hi)), k)
                        pick = pick + (pick >= lo) * (hi - lo)
                    else:
                        pick = best(own, s, k)
                    out_i.append(own[pick])
                    out_s.append(s[pick])
                    places.append(np.full(len(pick), q, np.int32))
                yield list_row(tile, shard, ids, places, out_i, out_s)


def list_row(tile, node, queries, places, ids, scores) -> pa.RecordBatch:
    joined = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (places, ids, scores)]
    values = [tile, node, queries.tobytes(), joined[0].astype(np.int32).tobytes(), joined[1].tobytes(), joined[2].tobytes()]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=["tile", "node", "queries", "places", "ids", "scores"])


def merged(table: pa.Table, k: int) -> pa.Table:
    """Lists of one tile from at most ``FAN`` nodes become one list."""
    queries = np.frombuffer(table.column("queries")[0].as_py(), np.int64)
    place = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in table.column("places")])
    ids = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("ids")])
    scores = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("scores")])
    order = np.lexsort((ids, -scores, place))
    place, ids, scores = place[order], ids[order], scores[order]
    nth = np.arange(len(place)) - np.searchsorted(place, place)
    keep = nth < k
    row = list_row(table.column("tile")[0].as_py(), table.column("node")[0].as_py() // FAN, queries, [place[keep]], [ids[keep]], [scores[keep]])
    return pa.Table.from_batches([row])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of every query, all where there are fewer.

    Components become floor(scale * x), the score is the integer inner product, ties go to the smaller vec_id. Rows
    with the query's id are not its candidates. Null vectors, vectors with null or non-finite components, empty ones
    and rows without id take no part; vectors of different lengths do not meet. A query that several rows hold is
    answered once per row. Scores beyond a long are cut to its range. Other columns are not read.
    """
    rows, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    n = rows.count()
    shards = max(1, -(-n // SHARD), min(12, n // 512))

    def shard_rows(batches):
        from pyspark import TaskContext

        for dim, ids, m in matrices(batches, scale, SHARD):
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([0], pa.int8()), pa.array([0], pa.int64()), pa.array([dim], pa.int32()),
                 pa.array([ids.tobytes()]), pa.array([m.tobytes()])], names=["shard", "kind", "tile", "dim", "ids", "data"])

    def tile_rows(batches):
        from pyspark import TaskContext

        tile = TaskContext.get().partitionId() << 32  # a tile is named by its partition and its number there
        for dim, ids, m in matrices(batches, scale, TILE):
            for at in range(0, len(ids), TILE):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0], pa.int32()), pa.array([1], pa.int8()), pa.array([tile], pa.int64()), pa.array([dim], pa.int32()),
                     pa.array([ids[at : at + TILE].tobytes()]), pa.array([m[at : at + TILE].tobytes()])], names=["shard", "kind", "tile", "dim", "ids", "data"])
                tile += 1

    dealt = rows.withColumn("to", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).repartitionById(shards, F.col("to")).drop("to")
    held = dealt.mapInArrow(shard_rows, SENT_SQL)
    tiles = asked.mapInArrow(tile_rows, SENT_SQL).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = held.unionByName(tiles).repartitionById(shards, F.col("shard")).sortWithinPartitions("kind")
    lists = met.mapInArrow(lambda it: visited(it, k), LISTS_SQL)
    nodes = shards
    while True:
        lists = lists.groupBy("tile", F.floor(F.col("node") / FAN).alias("up")).applyInArrow(lambda t: merged(t, k), LISTS_SQL)
        nodes = -(-nodes // FAN)
        if nodes == 1:
            break

    def spread(batches):
        for batch in batches:
            for q, p, i, s in zip(*(batch.column(c) for c in ("queries", "places", "ids", "scores"))):
                place = np.frombuffer(p.as_py(), np.int32)
                rank = np.arange(len(place)) - np.searchsorted(place, place) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(q.as_py(), np.int64)[place]), pa.array(rank.astype(np.int32)), pa.array(np.frombuffer(i.as_py(), np.int64)),
                     pa.array(np.frombuffer(s.as_py(), np.int64))], names=["query_id", "rank", "vec_id", "score"])

    return lists.mapInArrow(spread, "query_id long, rank int, vec_id long, score long")
