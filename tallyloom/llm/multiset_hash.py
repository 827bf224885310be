"""Document fingerprints as homomorphic multiset hashes of paragraphs.

Every paragraph (the text between two line feeds) is hashed to a wide vector, and the fingerprint of a text is the sum of
the vectors of its paragraphs. So it does not depend on their order, and a paragraph is inserted or deleted by adding
or subtracting its vector. The vector has two sections:

* 8 lanes modulo 2^64, the BLAKE2b hash of the whole paragraph. They decide equality.
* 256 lanes modulo 2^32. Every gram of 8 bytes of the paragraph (4 bytes in paragraphs below 24) adds 1 or -1 to the lane
  that its hash names. Sums of such lanes keep lengths: the squared length of the difference of two fingerprints is, up to
  a relative error of some 1/sqrt(128), that of the difference of the multisets of grams. Likeness is
  1 - |a - b|^2 / (|a|^2 + |b|^2), the share of grams in common, cut to 0..1; equal fingerprints have likeness 1.

An edited text shares all paragraphs before the edit: its fingerprint comes from the old one by deleting the paragraphs
from the edit on and inserting the new ones.

Neighbouring documents meet by ranges of the ids. The borders of the ranges are ids of documents, so the first document of
every range is known before the exchange and is sent to the range before it as well.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import identified, parts_for

LANES = 256
GRAM, SHORT_GRAM, SHORT = 8, 4, 24
#: Texts that are hashed together hold at most so many bytes (one text may hold more) and are at most so many.
BYTES_TOGETHER, TEXTS_TOGETHER = 1 << 18, 64
#: Bytes whose grams are made at a time.
BYTES_AT_ONCE = 1 << 15
#: Most ranges of ids; their borders are constants of the plan.
MOST_RANGES = 1 << 16

_MASK = np.array([(1 << (8 * k)) - 1 for k in range(SHORT_GRAM + 1)], np.uint64)

#: 8 lanes modulo 2^64 and 256 lanes modulo 2^32.
Fingerprint = tuple[np.ndarray, np.ndarray]


def _buckets(words: np.ndarray) -> np.ndarray:
    """Lane and sign (lowest bit) of every gram; works in place."""
    words *= np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(32)
    words *= np.uint64(0xBF58476D1CE4E5B9)
    words >>= np.uint64(64 - 9)
    return words.view(np.int64)


def grams(texts: list[bytes]) -> np.ndarray:
    """Per text the sum of the signed lanes of all grams of all paragraphs."""
    joined = b"\n".join(texts) + b"\n"
    n = len(joined)
    raw = np.frombuffer(joined + bytes(8), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.flatnonzero(raw[:n] == 10)
    size = np.diff(ends, prepend=-1) - 1
    whole = np.ones(n, bool)  # places from which a gram lies in one long paragraph
    for k in range(SHORT):
        some = ends[(size >= k) & ((size < SHORT) | (k < GRAM))] - k
        whole[some] = False
    counts = np.zeros(len(texts) * 2 * LANES, np.int64)
    base = np.repeat(np.arange(len(texts)) * 2 * LANES, sizes) if len(texts) > 1 else None
    for at in range(0, n, BYTES_AT_ONCE):
        until = min(n, at + BYTES_AT_ONCE)
        words = np.lib.stride_tricks.as_strided(raw[at:], (until - at, 8), (1, 1)).copy().view("<u8")[:, 0]
        bucket = _buckets(words)
        if base is not None:
            bucket += base[at:until]
        counts += np.bincount(bucket[whole[at:until]], minlength=len(counts))
    short = np.flatnonzero(size < SHORT)
    if len(short):
        many = np.maximum(1, size[short] - SHORT_GRAM + 1)
        place = np.repeat(ends[short] - size[short], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        width = np.minimum(SHORT_GRAM, np.repeat(size[short], many))
        words = np.zeros(len(place), np.uint64)
        for k in range(SHORT_GRAM):
            words |= raw[place + k].astype(np.uint64) << np.uint64(8 * k)
        bucket = _buckets((words & _MASK[width]) + ((width + 1).astype(np.uint64) << np.uint64(40)))
        owner = np.searchsorted(np.cumsum(sizes), place, "right")
        counts += np.bincount(bucket + owner * 2 * LANES, minlength=len(counts))
    counts = counts.reshape(len(texts), LANES, 2)
    return (counts[:, :, 0] - counts[:, :, 1]).astype(np.int32)


def fingerprints_of(texts: list[bytes]) -> Fingerprint:
    """Fingerprints of many texts, a row for each; the empty text is one empty paragraph."""
    exact, alike = [], []
    for some in _together(texts):
        parts = [t.split(b"\n") for t in some]
        digests = np.frombuffer(b"".join(hashlib.blake2b(p).digest() for q in parts for p in q), "<u8").reshape(-1, 8)
        exact.append(np.add.reduceat(digests, np.cumsum([0] + [len(q) for q in parts[:-1]]), 0))
        alike.append(grams(some))
    return np.concatenate(exact), np.concatenate(alike)


def _together(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        if held and (size + len(t) > BYTES_TOGETHER or len(held) == TEXTS_TOGETHER):
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def fingerprint(text: bytes) -> Fingerprint:
    exact, alike = fingerprints_of([text])
    return exact[0], alike[0]


def plus(a: Fingerprint, b: Fingerprint) -> Fingerprint:
    """Insertion: the fingerprint of the paragraphs of both."""
    return a[0] + b[0], a[1] + b[1]


def minus(a: Fingerprint, b: Fingerprint) -> Fingerprint:
    """Deletion: the fingerprint of the paragraphs of ``a`` without those of ``b``."""
    return a[0] - b[0], a[1] - b[1]


def equal(a: Fingerprint, b: Fingerprint) -> np.ndarray:
    return (a[0] == b[0]).all(-1) & (a[1] == b[1]).all(-1)


def likeness(a: Fingerprint, b: Fingerprint) -> np.ndarray:
    """Share of grams in common, 0 to 1, from the fingerprints alone; row by row where they have rows."""
    x, y, d = (v.astype(np.float64) for v in (a[1], b[1], a[1] - b[1]))
    size = (x * x).sum(-1) + (y * y).sum(-1)
    return np.where(equal(a, b), 1.0, np.clip(1.0 - (d * d).sum(-1) / np.maximum(size, 1), 0.0, 1.0) * (size > 0))


def shown(a: Fingerprint) -> str:
    """Base64 of the lanes; the second section in the fewest bytes a lane (1, 2 or 4, told by the first byte)."""
    most = int(np.abs(a[1].astype(np.int64)).max())
    width = 1 if most < 1 << 7 else 2 if most < 1 << 15 else 4
    return base64.b64encode(bytes([width]) + a[0].astype("<u8").tobytes() + a[1].astype(f"<i{width}").tobytes()).decode()


def read(text: str) -> Fingerprint:
    """Inverse of ``shown``."""
    data = base64.b64decode(text)
    return np.frombuffer(data, "<u8", 8, 1), np.frombuffer(data, f"<i{data[0]}", LANES, 65).astype(np.int32)


def edited(texts: list[str], following: list[str], own: Fingerprint) -> tuple[list[bytes], Fingerprint]:
    """Texts whose last quarter gives way to the start of the following one, and their fingerprints from those of the texts."""
    changed, deleted, inserted = [], [], []
    for text, next_ in zip(texts, following):
        cut = len(text) // 4
        keep = text[: len(text) - cut]
        start = keep.rfind("\n") + 1  # paragraphs before it stay
        deleted.append(text[start:].encode())
        inserted.append((keep[start:] + next_[:cut]).encode())
        changed.append(keep[:start].encode() + inserted[-1])
    return changed, plus(minus(own, fingerprints_of(deleted)), fingerprints_of(inserted))


SENT = pa.schema([("part", pa.int32()), ("late", pa.bool_()), ("key", pa.int64()), ("id", pa.int64()), ("data", pa.binary())])
SENT_SQL = "part int, late boolean, key long, id long, data binary"
OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                 ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
OUT_SQL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def dealt(batches: Iterator[pa.RecordBatch], borders: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    """Texts to their range; the first of a range to the range before as well, the first of all to the last."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            some = batch.slice(at, 1000)
            keys = np.asarray(some.column("key"))
            data = [squeeze(x or b"") for x in some.column("text").cast(pa.binary()).to_pylist()]
            part = np.searchsorted(borders, keys, "right")
            first = np.flatnonzero((keys == least) | np.isin(keys, borders))
            row = np.concatenate([np.arange(len(keys)), first])
            part = np.concatenate([part, np.where(keys[first] == least, len(borders), part[first] - 1)])
            late = np.arange(len(row)) >= len(keys)
            ids = some.column("id")
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(late), pa.array(keys[row]), ids.take(pa.array(row)), pa.array([data[i] for i in row.tolist()], pa.binary())],
                schema=SENT)


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every text of a range with the one that follows; the last text of the input only follows."""
    expand = zstandard.ZstdDecompressor().decompress
    ids: list[int | None] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        data = batch.column("data")
        for i, doc_id in enumerate(batch.column("id").to_pylist()):
            ids.append(doc_id)
            texts.append(expand(data[i].as_py()))
            size += len(texts[-1])
            if len(texts) > 1 and (size > 4 * BYTES_TOGETHER or len(texts) == 1000):
                yield _compared(ids, texts)
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if len(texts) > 1:
        yield _compared(ids, texts)


def _compared(ids: list[int | None], raw: list[bytes]) -> pa.RecordBatch:
    exact, alike = fingerprints_of(raw)
    own, next_ = (exact[:-1], alike[:-1]), (exact[1:], alike[1:])
    texts = [t.decode("utf-8", "replace") for t in raw]
    changed, after = edited(texts[:-1], texts[1:], own)
    n = len(changed)
    columns = (ids[:-1], [len(t) for t in texts[:-1]], [hashlib.sha256(t).hexdigest() for t in changed],
               [shown((own[0][i], own[1][i])) for i in range(n)], [shown((after[0][i], after[1][i])) for i in range(n)],
               likeness(own, after), likeness(own, next_))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, OUT)], schema=OUT)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and how like the text is to that and to the next text.

    Edited form: the last quarter (rounded down) of the code points gives way to as many first code points of the next
    text, or all of them. Next: by ascending id, the first after the last; a single document follows itself.

    Result, a row per input row: doc_id, n_chars (code points), edited_sha256 (lowercase hex of the UTF-8 bytes),
    fingerprint, edited_fingerprint (Base64, see ``shown`` and ``read``), near_edited, near_next (0 to 1).
    A null text is empty; the empty text has the fingerprint of one empty paragraph. Rows that repeat an id are separate
    documents in the order of their texts; rows without id come last. An empty table gives an empty result. Grams of long
    texts are made in pieces. Other columns of the input are not read and may have any name.
    """
    rows, total = identified(docs, id_col, text_col)
    ranges = min(parts_for(total), MOST_RANGES)
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    least, borders = rows.agg(F.min("key"), F.percentile_approx("key", shares, 20 * ranges)).first()
    if least is None:
        return docs.sparkSession.createDataFrame([], OUT_SQL)
    borders = np.unique(np.array([b for b in borders if b > least], np.int64))
    sent = rows.mapInArrow(lambda it: dealt(it, borders, least), SENT_SQL)
    met = sent.repartitionById(len(borders) + 1, F.col("part")).sortWithinPartitions("late", "key")
    return met.mapInArrow(neighbours, OUT_SQL)
