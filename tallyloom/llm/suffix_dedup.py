"""Byte-level substring dedup with a distributed suffix sort.

Suffixes are ranges of the bytes of the corpus. Sorting all of them would ship 100 bytes per byte of text, so suffixes
that cannot have an equal are set aside first, without loss:

1. Every window of ``length`` bytes names an anchor: the place of its smallest 8-byte hash. The choice depends on the
   bytes of the window alone, so equal windows name the same place. Consecutive windows with one anchor form a run.
2. A run whose 32 bytes from the anchor (its leading token) occur at no other anchor has no equal window and is done.
   This is all that hashes of tokens decide: a run that is alone is left out, equality is left to the sort.
3. The windows of the remaining runs are the suffixes to sort. Sampled splitters deal the runs to ranges of their
   leading tokens (equal windows share them); document and place follow as further sort keys, so a leading token that
   many documents hold is spread over several ranges.
4. Each range sorts by multikey quicksort, twice. First the ends of every run: runs that agree in
   both are equal byte by byte, and all but the earliest go as a whole. Then all suffixes of the runs that are left,
   but for runs that are now alone with their token; of equal suffixes the earliest stays. So a range with a thousand
   copies sorts their suffixes once or not at all.
5. Only the first and last leading token of a range can go on in another range. Where one does, the earliest of its
   suffixes of every kind are compared across the borders by the hash (128 bits) of their bytes. They leave a range
   packed, one record per leading token; the others of a border are never sent.

A batch sends one record per distinct leading token. Runs whose token repeats in the batch are known to need the sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_part, first_of_equal, folded, identified, in_key_order, mixed, pack, parts_for, stored, texts_of, unpack
from .delivery import SENT, SENT_SQL, answers, delivered
from .multikey import multikey_quicksort, words_of

TOKEN = 32
#: Window starts examined at a time.
PLACES_AT_ONCE = 1 << 18
#: Runs per range of the suffix sort.
RUNS_PER_RANGE = 1 << 15
#: Leading token (48 bits), windows in the run, place of the anchor in it, known to repeat.
RUN = (("<u8", 6), ("u1", None), ("u1", None), ("u1", None))


def runs_in(raw: np.ndarray, borders: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, windows, anchor within, leading token) of all runs of windows that lie in one document."""
    span = length - TOKEN + 1
    out = []
    # Window starts from which a window would leave its document.
    ends = borders[1:]
    from_ = np.maximum(borders[:-1], ends - length + 1)
    for at in range(0, max(0, len(raw) - length + 1), PLACES_AT_ONCE):
        piece = raw[at : at + PLACES_AT_ONCE + length - 1]
        n = len(piece) - length + 1
        padded = np.concatenate([piece, np.zeros(8, np.uint8)])
        words = np.lib.stride_tricks.as_strided(padded, (len(piece), 8), (1, 1)).copy().view("<u8")[:, 0]
        key = words[: len(piece) - TOKEN + 1] * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
        key &= ~np.uint64((1 << 20) - 1)
        key |= np.arange(len(key), dtype=np.uint64)
        size = 1
        while size * 2 <= span:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < span:
            key = np.minimum(key[: size - span], key[span - size :])
        anchor = (key & np.uint64((1 << 20) - 1)).astype(np.int64)
        some = slice(np.searchsorted(ends, at, "right"), np.searchsorted(from_, at + n))
        marks = np.zeros(n + 1, np.int32)
        np.add.at(marks, np.clip(from_[some] - at, 0, n), 1)
        np.add.at(marks, np.clip(ends[some] - at, 0, n), -1)
        inside = np.cumsum(marks[:-1]) == 0
        new = np.ones(n, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, n))
        good = inside[start]
        start, count = start[good], count[good]
        place = anchor[start]
        token = folded(*(words[place + j] for j in range(0, TOKEN, 8)), seed=3)
        document = np.searchsorted(borders, start + at, "right") - 1
        out.append((document, start + at, count, place - start, token))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(c) for c in zip(*out))


def runs_of(batches: Iterator[pa.RecordBatch], length: int, parts: int):
    """Packed runs per part (kind 1), one per leading token of the batch; runs whose token repeats in it (kind 2)."""
    for batch in batches:
        batch = in_key_order(batch)
        raw, borders = texts_of(batch.column("text"))
        document, start, count, anchor, token = runs_in(raw, borders, length)
        if len(start) == 0:
            continue
        keys = np.asarray(batch.column("key"))[document]
        places = start - borders[document]
        token &= np.uint64((1 << 48) - 1)
        group, first = first_of_equal(token)
        many = np.bincount(group)[group] > 1
        yield from to_sort(keys[many], places[many], count[many], anchor[many], parts)
        keys, places, token, count, anchor, many = (c[first] for c in (keys, places, token, count, anchor, many))
        part, data = [], []
        for p, i in by_part((mixed(token) % np.uint64(parts)).astype(np.int64), parts):
            part.append(p)
            data.append(pack(keys[i], places[i], (token[i], 6), (count[i].astype(np.uint8), None), (anchor[i].astype(np.uint8), None),
                             (many[i].astype(np.uint8), None)))
        yield sent(part, data, 1)


def to_sort(keys: np.ndarray, places: np.ndarray, count: np.ndarray, anchor: np.ndarray, parts: int):
    """Runs whose windows have to be sorted (kind 2), packed by document."""
    found = answers(keys, places, parts, (count.astype(np.uint8), None), (anchor.astype(np.uint8), None))
    if found is not None:
        yield found.set_column(1, SENT.field("kind"), pa.array(np.full(found.num_rows, 2, np.int8)))


def sent(part: list[int], data: list[bytes], kind: int) -> pa.RecordBatch:
    n = len(part)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(np.full(n, kind, np.int8)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(data, pa.binary())], schema=SENT)


def known(keys: np.ndarray, places: np.ndarray, windows: np.ndarray, parts: int):
    """Removed windows; neighbours in a document become one record."""
    if len(keys) == 0:
        return
    order = np.lexsort((places, keys))
    keys, places, windows = keys[order], places[order], windows[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (places[1:] > places[:-1] + windows[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(keys)) - 1
    length = places[last] + windows[last] - places[first]
    yield answers(keys[first], places[first], parts, (length.astype(np.uint32), None))


def resolved(batches: Iterator[pa.RecordBatch], parts: int):
    """Runs whose leading token occurs elsewhere (kind 2)."""
    held = []
    for batch in batches:
        kind, data = np.asarray(batch.column("kind")), batch.column("data")
        if (kind == 2).any():
            yield batch.filter(pa.array(kind == 2))
        held += [unpack(data[int(i)].as_py(), *RUN) for i in np.flatnonzero(kind == 1)]
    if not held:
        return
    keys, places, token, count, anchor, many = (np.concatenate(c) for c in zip(*held))
    group, _ = first_of_equal(token)
    repeats = (np.bincount(group)[group] > 1) | (many > 0)
    open_ = repeats & (many == 0)  # the others are on their way
    yield from to_sort(keys[open_], places[open_], count[open_], anchor[open_], parts)


BLOCK = pa.schema([("anchor", pa.int32()), ("key", pa.int64()), ("place", pa.int64()), ("windows", pa.int32()), ("block", pa.binary())])
BLOCK_SQL = "anchor int, key long, place long, windows int, block binary"


def blocks_of(documents, length: int):
    """The bytes of the runs to sort."""
    rows: list[tuple] = []
    for key, _, text, (places, count, anchor) in documents:
        for p, c, a in zip(places.tolist(), count.tolist(), anchor.tolist()):
            rows.append((a, key, p, c, text[p : p + c + length - 1]))
        if len(rows) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), BLOCK)], schema=BLOCK)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), BLOCK)], schema=BLOCK)


SORTED = pa.schema([*SENT, ("lead", pa.binary()), ("range", pa.int32())])
SORTED_SQL = SENT_SQL + ", lead binary, range int"
#: Suffixes at borders: hash of the bytes.
EDGE = (("<u8", None), ("<u8", None))


def widened(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, pa.binary()), pa.nulls(batch.num_rows, pa.int32())], schema=SORTED)


def earliest_runs(words: np.ndarray, begin: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """Whether each run, in the order of their age, is the earliest of its equal ones.

    The first window of a run and the suffix of its last bytes cover it (a run has at most ``length - TOKEN + 1``
    windows), so runs with as many windows that agree in both are equal.
    """
    rest = max(8, length - TOKEN)
    kinds = []
    for starts, depth in ((begin, length), (begin + windows + length - 1 - rest, rest)):
        order, run = multikey_quicksort(words, starts, depth)
        kind = np.empty(len(order), np.int64)
        kind[order] = run
        kinds.append(kind)
    return first_of_equal(*kinds, windows)[1]


def sort_range(batches: Iterator[pa.RecordBatch], length: int, parts: int):
    """Sorts the suffixes of one range; gives removed windows (kind 0) and, packed, the earliest of each kind of its
    first and last leading token (kind 3)."""
    table = pa.Table.from_batches(list(batches), schema=BLOCK)  # a range holds a bounded number of runs
    if table.num_rows == 0:
        return
    table = table.sort_by([("key", "ascending"), ("place", "ascending")]).combine_chunks()
    raw, borders = texts_of(table.column("block").chunk(0))
    anchor, keys, places, windows = (np.asarray(table.column(c).chunk(0)).astype(np.int64) for c in ("anchor", "key", "place", "windows"))
    words, view = words_of(raw), memoryview(raw)
    begin = borders[:-1]
    own = earliest_runs(words, begin, windows, length)
    for found in known(keys[~own], places[~own], windows[~own], parts):
        yield widened(found)
    begin, anchor, keys, places, windows = (c[own] for c in (begin, anchor, keys, places, windows))
    group, _ = first_of_equal(*(words[begin + anchor + j] for j in range(TOKEN - 8, -1, -8)))  # numbered in the order of the tokens
    side = np.where(group == 0, 1, np.where(group == group.max(), 2, 0))
    low, high = (bytes(view[s : s + TOKEN]) for s in (begin + anchor)[[group.argmin(), group.argmax()]].tolist())
    # Equal suffixes share their leading token: a run that is left alone with it has no equal in this range.
    met = (np.bincount(group)[group] > 1) | (side > 0)
    begin, keys, places, windows, side = (c[met] for c in (begin, keys, places, windows, side))
    of = np.repeat(np.arange(len(windows)), windows)
    step = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = begin[of] + step
    key, place, side = keys[of], places[of] + step, side[of]
    order, run = multikey_quicksort(words, starts, length)
    by_age = order[np.lexsort((place[order], key[order], run))]
    first = np.ones(len(order), bool)
    first[1:] = run[1:] != run[:-1]  # runs keep their places of the order
    later = by_age[~first]
    for found in known(key[later], place[later], np.ones(len(later), np.int64), parts):
        yield widened(found)
    kept = by_age[first]
    number = TaskContext.get().partitionId()
    for which, token in ((1, low), (2, high)):
        some = kept[side[kept] == which]
        if len(some) == 0:
            continue
        some = some[np.lexsort((place[some], key[some]))]
        codes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[s : s + length]) for s in starts[some].tolist()), np.uint64).reshape(-1, 2)
        data = pack(key[some], place[some], (np.ascontiguousarray(codes[:, 0]), None), (np.ascontiguousarray(codes[:, 1]), None))
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int32()), pa.array([3], pa.int8()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([data], pa.binary()),
             pa.array([token], pa.binary()), pa.array([number], pa.int32())], schema=SORTED)


def by_code(batches: Iterator[pa.RecordBatch], parts: int):
    """Packed suffixes, dealt by the hash of their bytes."""
    for batch in batches:
        data = batch.column("data")
        for i in range(batch.num_rows):
            keys, places, a, b = unpack(data[i].as_py(), *EDGE)
            part, out = [], []
            for p, some in by_part((a % np.uint64(parts)).astype(np.int64), parts):
                part.append(p)
                out.append(pack(keys[some], places[some], (a[some], None), (b[some], None)))
            yield sent(part, out, 1)


def decided(batches: Iterator[pa.RecordBatch], parts: int):
    """Of equal suffixes of several ranges all but the earliest are removed."""
    held = [unpack(d.as_py(), *EDGE) for batch in batches for d in batch.column("data")]
    if not held:
        return
    keys, places, a, b = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((places, keys))
    keys, places, a, b = keys[order], places[order], a[order], b[order]
    _, first = first_of_equal(a, b)
    yield from known(keys[~first], places[~first], np.ones(int((~first).sum()), np.int64), parts)


def across_borders(edge: DataFrame, parts: int) -> DataFrame:
    """Removed windows among the suffixes of leading tokens that lie in several ranges."""
    narrow = edge.select("lead", F.col("range").alias("__range"))
    spread = narrow.groupBy("lead").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("lead").alias("__lead"))
    wanted = narrow.join(spread, F.col("lead") == F.col("__lead")).select(F.col("lead").alias("__lead"), "__range")
    met = edge.join(wanted, (F.col("range") == F.col("__range")) & (F.col("lead") == F.col("__lead")), "left_semi")
    dealt = met.select("data").mapInArrow(lambda it: by_code(it, parts), SENT_SQL).repartitionById(parts, F.col("part"))
    return dealt.mapInArrow(lambda it: decided(it, parts), SENT_SQL)


KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def kept_bytes(documents, length: int, with_key: bool):
    rows: list[tuple] = []
    size = 0
    for key, doc_id, text, (places, windows) in documents:
        text = text or b""
        removed = spans = 0
        kept = text
        if len(places):
            marks = np.zeros(len(text) + 1, np.int32)
            np.add.at(marks, places, 1)
            np.add.at(marks, places + windows.astype(np.int64) + length - 1, -1)
            gone = np.cumsum(marks[:-1]) > 0
            removed = int(gone.sum())
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            if with_key:
                kept = kept.decode("utf-8", "ignore").encode()
        rows.append((key if with_key else doc_id, len(text), removed, spans, kept))
        size += len(kept)
        if size > 8 << 20 or len(rows) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), KEPT)], schema=KEPT)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), KEPT)], schema=KEPT)


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """Removes each byte that a string of ``length`` bytes covers which also starts earlier.

    Earlier: in a document with a smaller id, or in the same one before. Strings never cross documents, overlaps
    count, and all strings are judged on the input texts (UTF-8).
    Result: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary), a row per input row.
    A null text is empty. Texts below ``length`` bytes lose nothing. Rows that repeat an id are separate documents in
    the order of their texts; rows without id come last. An empty table gives an empty result. Texts of any length
    are examined in pieces. Other columns of the input are not read and may have any name.
    """
    rows, total = identified(docs, id_col, text_col)
    return dedup_keyed(rows, total, length, False)


def dedup_keyed(rows: DataFrame, total: int, length: int, with_key: bool) -> DataFrame:
    """``dedup_bytes`` over rows (key, id, text) with unique keys.

    With ``with_key`` doc_id of the result is the key, and characters of which a part is removed go altogether, so
    that what is left is text.
    """
    if not TOKEN < length <= 255:
        raise ValueError(f"length must be above {TOKEN} and below 256")
    parts = parts_for(total)
    runs = rows.select("key", "text").mapInArrow(lambda it: runs_of(it, length, parts), SENT_SQL)
    dealt = runs.withColumn("to", F.when(F.col("kind") == 1, F.col("part")).otherwise(F.hash("data", "part")))
    dealt = dealt.repartitionById(parts, F.col("to")).drop("to")
    met = stored(dealt.mapInArrow(lambda it: resolved(it, parts), SENT_SQL), "runs")
    kinds = (("u1", None), ("u1", None))
    todo = met.withColumn("kind", F.lit(0).cast("byte"))
    blocks = delivered(rows, todo, parts, kinds, lambda d: blocks_of(d, length), BLOCK_SQL)
    blocks = stored(blocks, "blocks")
    ranges = max(1, -(-blocks.count() // RUNS_PER_RANGE))
    lead = F.substring("block", F.col("anchor") + 1, F.lit(TOKEN))
    dealt = blocks.repartitionByRange(ranges, lead, "key", "place")
    sorted_ = stored(dealt.mapInArrow(lambda it: sort_range(it, length, parts), SORTED_SQL), "sorted")
    removed = sorted_.filter("kind = 0").select(*SENT.names).unionByName(across_borders(sorted_.filter("kind = 3"), parts))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return delivered(rows, removed, parts, (("<u4", None),), lambda d: kept_bytes(d, length, with_key), schema)
