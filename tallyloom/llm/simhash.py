"""Near-duplicates by SimHash with a tiled exact comparison.

Equal fingerprints become one. The distinct ones are sorted by their bit counts (whole, then halves, then quarters)
and cut into tiles; a pair of tiles is compared by exclusive-or and bit counts in blocks. Two fingerprints within the
radius differ by no more than the radius in their bit counts, so pairs of tiles, and inside them pairs of blocks, whose
ranges of bit counts are further apart are skipped. A tile pair returns a spanning forest of its links, never all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import connected, forest

#: Fingerprints of a tile, and of a block inside it.
TILE = 1 << 14
BLOCK = 512
SHINGLES_AT_ONCE = 1 << 14


def fingerprint(text: bytes, words_per: int, seed: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < words_per:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = memoryview(b" ".join(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    starts, ends = (end - size)[: len(words) - words_per + 1], end[words_per - 1 :]
    set_ = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        s, e = starts[at : at + SHINGLES_AT_ONCE].tolist(), ends[at : at + SHINGLES_AT_ONCE].tolist()
        hashes = np.fromiter((digest(joined[i:j], seed) for i, j in zip(s, e)), np.dtype("<u8"), len(s))
        set_ += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * set_ > len(starts)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and the fingerprint as a long. Null and empty texts, or those of blanks only, have fingerprint zero."""

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                texts = some.column(1).cast(pa.binary()).to_pylist()
                values = np.array([fingerprint(t or b"", words_per, seed) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([some.column(0).cast(pa.int64()), pa.array(values)], names=["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, fingerprint long")


def bit_counts(values: np.ndarray) -> np.ndarray:
    """Bit counts of the four quarters of each fingerprint."""
    quarters = values.astype("<u8").view("<u2").reshape(-1, 4)
    return np.bitwise_count(quarters).astype(np.int16)


def tiles_of(batches: Iterator[pa.RecordBatch]):
    """One packed tile per partition, sorted by bit counts."""
    held = [np.asarray(b.column("fingerprint")) for b in batches if b.num_rows]
    if not held:
        return
    from pyspark import TaskContext

    values = np.concatenate(held).view(np.uint64)
    q = bit_counts(values)
    order = np.lexsort((q[:, 2], q[:, 0], q[:, 0] + q[:, 1], q.sum(axis=1)))
    values, total = values[order], q.sum(axis=1)[order]
    yield pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([int(total[0])], pa.int32()), pa.array([int(total[-1])], pa.int32()),
         pa.array([values.tobytes()], pa.binary())], names=["tile", "low", "high", "data"])


def links_between(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two tiles."""
    out_a, out_b = [], []

    def ranges(values):
        q = bit_counts(values)
        starts = np.arange(0, len(values), BLOCK)
        return np.minimum.reduceat(q, starts), np.maximum.reduceat(q, starts)

    (low_a, high_a), (low_b, high_b) = ranges(a), ranges(b)
    for i in range(len(low_a)):
        apart = np.maximum(0, np.maximum(low_b - high_a[i], low_a[i] - high_b)).sum(axis=1)
        for j in np.flatnonzero(apart <= radius).tolist():
            if same and j < i:
                continue
            x, y = a[i * BLOCK : (i + 1) * BLOCK], b[j * BLOCK : (j + 1) * BLOCK]
            near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
            if same and i == j:
                np.fill_diagonal(near, False)
            r, c = np.nonzero(near)
            if len(r):
                u, v = forest(x[r].view(np.int64), y[c].view(np.int64))
                out_a.append(u)
                out_b.append(v)
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(np.concatenate(out_a), np.concatenate(out_b))


def compared(batches: Iterator[pa.RecordBatch], radius: int):
    """Partitions hold whole tile pairs, sorted by (i, j, side)."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        columns = [batch.column(n) for n in ("i", "j", "side", "data")]
        for i, j, side, data in zip(*(c.to_pylist() for c in columns[:3]), columns[3]):
            values = np.frombuffer(data.as_py(), np.uint64)
            other = values if i == j else held.pop((i, j), None)
            if other is None:
                held = {(i, j): values}
                continue
            u, v = links_between(other, values, radius, i == j)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["a", "b"])


def near_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect all fingerprints within the radius; ``distinct`` is read twice."""
    n = distinct.count()
    count = max(1, -(-n // TILE), min(8, n // BLOCK))
    bits = F.bit_count("fingerprint")
    half = F.bit_count(F.col("fingerprint").bitwiseAND(F.lit(0xFFFFFFFF)))
    ranged = distinct.repartitionByRange(count, bits, half, F.col("fingerprint"))
    tiles = stored(ranged.mapInArrow(tiles_of, "tile int, low int, high int, data binary"), "tiles")
    near = tiles.select(F.col("tile").alias("i"), F.explode(F.sequence(F.col("low") - radius, F.col("high") + radius)).alias("p"))
    at = tiles.select(F.col("tile").alias("j"), F.explode(F.sequence("low", "high")).alias("q"))
    pairs = near.join(at, F.col("p") == F.col("q")).filter("i <= j").select("i", "j").distinct()
    first = pairs.join(tiles, F.col("i") == F.col("tile")).select("i", "j", F.lit(0).alias("side"), "data")
    second = pairs.filter("i < j").join(tiles, F.col("j") == F.col("tile")).select("i", "j", F.lit(1).alias("side"), "data")
    dealt = first.unionAll(second).repartition(max(12, 4 * count), "i", "j").sortWithinPartitions("i", "j", "side")
    return dealt.mapInArrow(lambda it: compared(it, radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per: int = 3, seed: int = 42, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (long) and component_id (smallest id reachable by links), a row per input row.

    Letters A-Z are lower-cased; words are split at the six ASCII white-space characters. Fewer words than a shingle
    takes count as one shingle; without words (null, empty, blanks) the fingerprint is zero and links like any other.
    Rows that repeat an id stay separate rows with equal ids. Rows without id take part in links; a component of such
    rows only has no id. An empty table gives an empty result. Other columns are not read.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words_per, seed), "fingerprints")
    classes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected(near_links(classes.select("fingerprint"), radius))
    placed = classes.join(roots, F.col("fingerprint") == F.col("node"), "left")
    placed = placed.select(F.col("fingerprint").alias("f"), "least", F.coalesce("root", "fingerprint").alias("root"))
    heads = placed.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "r")
    named = placed.join(heads, F.col("root") == F.col("r")).select("f", "component_id")
    return prints.join(named, F.col("fingerprint") == F.col("f")).select("doc_id", "fingerprint", "component_id")
