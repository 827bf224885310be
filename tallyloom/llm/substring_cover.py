"""Substring dedup of word windows with difference-cover anchors.

The residues {0, 1, 3, 9} modulo 13 are a difference cover: for any two positions i and j there is a shift below 13
that moves both onto cover positions. Two equal windows of 20 words therefore hold equal 8-word windows that start at
cover positions of both documents. So:

1. hash the 8 words at cover positions only (4 of 13 positions) and find the hashes that occur more than once;
2. around every shared anchor, extend: take all 20-word windows that contain one, hash the whole window and find its
   earliest start. Windows without a shared anchor occur once and are never looked at again.

Every task sends one record per distinct hash of its batch, the others are decided on the spot. A passage that a third
of all documents hold costs one record per batch and not one per document.

Hashes of windows have 96 bits; anchors need 48, as a chance match only adds a window to the second step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_part, first_of_equal, folded, identified, in_key_order, mixed, pack, parts_for, unpack
from .delivery import SENT, SENT_SQL, answers, delivered

PERIOD = 13
COVER = (0, 1, 3, 9)
#: Words hashed and windows compared at a time.
WORDS_AT_ONCE = 1 << 18


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolled(codes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of every ``length`` consecutive codes."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Windows of the powers of two that make up the length, each from two of half its size.
    out, done, size, level = np.full(n, seed, np.uint64), 0, 1, mixed(codes + np.uint64(seed))
    while True:
        if length & size:
            out = mixed(out * np.uint64(0x94D049BB133111EB) + level[done : done + n])
            done += size
        if size * 2 > length:
            return out
        level = mixed(level[:-size] * np.uint64(0xD6E8FEB86659FD93) + level[size:])
        size *= 2


def anchors_of(batches: Iterator[pa.RecordBatch], length: int, parts: int, back: int):
    """Packed anchors per part (kind 1) and anchors known to be shared within the batch (kind 0, for delivery)."""
    for batch in batches:
        batch = in_key_order(batch)
        keys, places, codes = [], [], []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            words = (text or b"").split()
            if len(words) < length:
                continue
            code = word_codes(words)
            for at in range(0, len(words) - length + 1, WORDS_AT_ONCE):
                hashes = rolled(code[at : at + WORDS_AT_ONCE + length - 1], length, 7)
                place = np.arange(at, at + len(hashes))
                chosen = np.isin(place % PERIOD, COVER)
                places.append(place[chosen])
                codes.append(hashes[chosen] & np.uint64((1 << 48) - 1))
                keys.append(np.full(len(places[-1]), key, np.int64))
        if not keys:
            continue
        keys, places, codes = np.concatenate(keys), np.concatenate(places), np.concatenate(codes)
        group, first = first_of_equal(codes)
        shared = np.bincount(group)[group] > 1
        known = answers(keys[shared], places[shared], back)
        if known is not None:
            yield known
        keys, places, codes = keys[first], places[first], codes[first]
        part, data = [], []
        for p, i in by_part((mixed(codes) % np.uint64(parts)).astype(np.int64), parts):
            part.append(p)
            data.append(pack(keys[i], places[i], (codes[i], 6)))
        yield sent_blobs(part, data)


def sent_blobs(part: list[int], data: list[bytes]) -> pa.RecordBatch:
    n = len(part)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(np.ones(n, np.int8)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(data, pa.binary())], schema=SENT)


def matched(batches: Iterator[pa.RecordBatch], kinds: tuple, decide, back: int):
    """All records of a partition against each other; answers found before pass through."""
    held = []
    for batch in batches:
        kind, data = np.asarray(batch.column("kind")), batch.column("data")
        if (kind == 0).any():
            yield batch.filter(pa.array(kind == 0))
        held += [unpack(data[int(i)].as_py(), *kinds) for i in np.flatnonzero(kind == 1)]
    if held:
        columns = [np.concatenate(c) for c in zip(*held)]
        order = np.lexsort((columns[1], columns[0]))
        keys, places, *codes = [c[order] for c in columns]
        chosen = decide(*first_of_equal(*codes))
        found = answers(keys[chosen], places[chosen], back)
        if found is not None:
            yield found


def exchanged(records: DataFrame, parts: int, kinds: tuple, decide, back: int) -> DataFrame:
    """Packed records meet by part; answers come out packed by document. Answers enter it in any partition."""
    dealt = records.withColumn("to", F.when(F.col("kind") == 1, F.col("part")).otherwise(F.hash("data", "part")))
    dealt = dealt.repartitionById(parts, F.col("to")).drop("to")
    return dealt.mapInArrow(lambda batches: matched(batches, kinds, decide, back), SENT_SQL)


def not_first(group, first):
    return ~first


def shared_by_some(group, first):
    return np.bincount(group)[group] > 1


def windows_of(documents, window: int, length: int, parts: int, back: int):
    """Hashes of the windows that hold a shared anchor: the batch's earliest of each kind, and the later ones as found."""
    keys, places, a, b, size = [], [], [], [], 0
    for key, _, text, (anchor,) in documents:
        if text is None or len(anchor) == 0:
            continue
        words = text.split()
        n = len(words) - window + 1
        if n <= 0:
            continue
        marks = np.zeros(n + 1, np.int32)  # a window that starts at p holds the anchors from p to p + window - length
        np.add.at(marks, np.clip(anchor - (window - length), 0, n), 1)
        np.add.at(marks, np.clip(anchor + 1, 0, n), -1)
        wanted = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
        code = word_codes(words)
        for at in range(0, n, WORDS_AT_ONCE):
            here = wanted[np.searchsorted(wanted, at) : np.searchsorted(wanted, at + WORDS_AT_ONCE)]
            if len(here) == 0:
                continue
            part = code[at : at + WORDS_AT_ONCE + window - 1]
            places.append(here)
            a.append(rolled(part, window, 11)[here - at])
            b.append((rolled(part, window, 13)[here - at] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            keys.append(np.full(len(here), key, np.int64))
            size += len(here)
        if size > 4 * WORDS_AT_ONCE:
            yield from earliest(keys, places, a, b, parts, back)
            keys, places, a, b, size = [], [], [], [], 0
    yield from earliest(keys, places, a, b, parts, back)


def earliest(keys, places, a, b, parts: int, back: int):
    if not keys:
        return
    keys, places, a, b = map(np.concatenate, (keys, places, a, b))
    order = np.lexsort((places, keys))
    keys, places, a, b = keys[order], places[order], a[order], b[order]
    _, first = first_of_equal(a, b)
    found = answers(keys[~first], places[~first], back)
    if found is not None:
        yield found
    keys, places, a, b = keys[first], places[first], a[first], b[first]
    part, data = [], []
    for p, i in by_part((a % np.uint64(parts)).astype(np.int64), parts):
        part.append(p)
        data.append(pack(keys[i], places[i], (a[i], None), (b[i], None)))
    yield sent_blobs(part, data)


KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def kept_words(documents, window: int):
    rows: list[tuple] = []
    size = 0
    for _, doc_id, text, (starts,) in documents:
        words = (text or b"").split()
        removed = 0
        kept = words
        if len(starts):
            marks = np.zeros(len(words) + 1, np.int32)
            np.add.at(marks, starts, 1)
            np.add.at(marks, starts + window, -1)
            keep = np.cumsum(marks[:-1]) == 0
            removed = int((~keep).sum())
            kept = [words[i] for i in np.flatnonzero(keep).tolist()]
        rows.append((doc_id, len(words), removed, b" ".join(kept)))
        size += len(rows[-1][3])
        if size > 8 << 20 or len(rows) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), KEPT)], schema=KEPT)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), KEPT)], schema=KEPT)


def dedup_word_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Removes each word that a window of ``window`` words covers which also starts earlier.

    Words are the runs of other characters than space, tab, line feed, vertical tab, form feed and carriage return.
    Earlier: in a document with a smaller id, or in the same one before. Windows are judged on the input texts.
    Result: doc_id, n_words, n_removed, kept (binary; the words left, joined by one space), a row per input row.
    A null or empty text has no words. Texts below ``window`` words lose nothing. Rows that repeat an id are separate
    documents in the order of their texts; rows without id come last. An empty table gives an empty result. Texts of
    any length are hashed in pieces. Other columns of the input are not read and may have any name.
    """
    length = window - PERIOD + 1
    if length < 1:
        raise ValueError(f"window must be at least {PERIOD} words")
    rows, total = identified(docs, id_col, text_col)
    parts = parts_for(total)
    anchors = rows.select("key", "text").mapInArrow(lambda it: anchors_of(it, length, parts, parts), SENT_SQL)
    shared = exchanged(anchors, parts, (("<u8", 6),), shared_by_some, parts)
    windows = delivered(rows, shared, parts, (), lambda d: windows_of(d, window, length, parts, parts), SENT_SQL)
    removed = exchanged(windows, parts, (("<u8", None), ("<u4", None)), not_first, parts)
    schema = "doc_id long, n_words long, n_removed long, kept binary"
    return delivered(rows, removed, parts, (), lambda d: kept_words(d, window), schema)
