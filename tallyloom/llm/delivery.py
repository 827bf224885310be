"""Brings packed answers about places of documents back to the texts they belong to.

Texts and answers go through one exchange on the document key. Texts travel compressed, so a text crosses the network
at less than half its size. In each partition the answers come first, then the texts stream by.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_part, mixed, pack, unpack

SENT = pa.schema([("part", pa.int32()), ("kind", pa.int8()), ("key", pa.int64()), ("id", pa.int64()), ("data", pa.binary())])
SENT_SQL = "part int, kind byte, key long, id long, data binary"


def dealt_to(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(keys.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int32)


def compressed(rows: DataFrame, parts: int) -> DataFrame:
    """Each (key, id, text) as a row for its partition; null texts stay null."""

    def send(batches: Iterator[pa.RecordBatch]):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                keys = np.asarray(some.column("key"))
                data = [None if x is None else squeeze(x) for x in some.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(dealt_to(keys, parts)), pa.array(np.ones(len(keys), np.int8)), pa.array(keys), some.column("id").cast(pa.int64()),
                     pa.array(data, pa.binary())], schema=SENT)

    return rows.select("key", "id", "text").mapInArrow(send, SENT_SQL)


def answers(keys: np.ndarray, places: np.ndarray, parts: int, *others: tuple[np.ndarray, int | None]) -> pa.RecordBatch | None:
    """Packed answers per partition of the document key."""
    if len(keys) == 0:
        return None
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    others = tuple((c[order], w) for c, w in others)
    part, data = [], []
    for p, i in by_part(dealt_to(keys, parts), parts):
        part.append(p)
        data.append(pack(keys[i], places[i], *((c[i], w) for c, w in others)))
    n = len(part)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(np.zeros(n, np.int8)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(data, pa.binary())], schema=SENT)


def delivered(rows: DataFrame, answer_rows: DataFrame, parts: int, kinds: tuple, each: Callable, schema: str) -> DataFrame:
    """``each(key, id, text bytes or None, places and further columns)`` over all documents; it gives record batches.

    ``each`` gets an iterator of documents and yields record batches, so that it can gather documents into batches.
    """
    sent = compressed(rows, parts).unionByName(answer_rows.select("part", "kind", "key", "id", "data"))
    dealt = sent.repartitionById(parts, F.col("part")).sortWithinPartitions("kind", "key")

    def work(batches: Iterator[pa.RecordBatch]):
        def documents():
            held: list[list[np.ndarray]] = []
            table = None
            expand = zstandard.ZstdDecompressor().decompress
            for batch in batches:
                kind = np.asarray(batch.column("kind"))
                data = batch.column("data")
                cut = int((kind == 0).sum())
                for i in range(cut):
                    held.append(unpack(data[i].as_py(), *kinds))
                if cut == batch.num_rows:
                    continue
                if table is None:
                    table = gathered(held, kinds)
                    held = []
                keys, ids = np.asarray(batch.column("key").slice(cut)), batch.column("id").to_pylist()
                lo, hi = np.searchsorted(table[0], keys), np.searchsorted(table[0], keys, "right")
                for j, key in enumerate(keys.tolist()):
                    z = data[cut + j].as_py()
                    yield key, ids[cut + j], None if z is None else expand(z), [c[lo[j] : hi[j]] for c in table[1:]]

        yield from each(documents())

    return dealt.mapInArrow(work, schema)


def gathered(held: list[list[np.ndarray]], kinds: tuple) -> list[np.ndarray]:
    """All answers of a partition in the order of key and place."""
    if not held:
        return [np.zeros(0, np.int64), np.zeros(0, np.int64)] + [np.zeros(0, k) for k, _ in kinds]
    columns = [np.concatenate(c) for c in zip(*held)]
    order = np.lexsort((columns[1], columns[0]))
    return [c[order] for c in columns]
