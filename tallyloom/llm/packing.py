"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Lengths are whole numbers up to the capacity, so an instance is a table of counts per length, of bounded size whatever
the number of documents. The plan is made on that table: dominance reduction fixes sets of up to three lengths that no
other choice can beat, the rest is placed by best fit, longest first. The plan is a list of patterns with their
number of sequences. Pieces then find their place by their rank among the pieces of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, sizes_of, stored

END = 2
# Fixed values of the byte-level vocabulary: its pre-tokenizer, and what is not ordinary text in it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>"}
CAPACITY = 1024
#: Blanks in a row beyond which a text goes to the tokenizer library.
BLANKS = 4096
#: Distinct words whose ids a task remembers; then it starts anew.
WORDS_KEPT = 400_000


class Encoder:
    """Ids of a byte-level BPE vocabulary, word by word.

    Where a single space stands between two other characters, the pre-tokenizer always begins a token at that space.
    Such a text is cut there, and words met before are looked up. Texts with very long runs of blanks, which overflow the
    stack of the fast encoder, go to the tokenizer library itself. New words of a batch are encoded in one call; the
    place where each begins is seen from its first token, the only one that starts with a space.

    With ``added`` the added tokens of the file are found in the text first and get their own id, as the tokenizer does
    by itself; what stands between them is encoded apart. Without, they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        import json
        import re

        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary = file["model"]["vocab"]
        tokens = {t["content"]: t for t in file.get("added_tokens") or []} if added else {}
        if any(t[k] for t in tokens.values() for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that look at their neighbours are not supported")
        self.added = {content: np.array([t["id"]], "<u4").tobytes() for content, t in tokens.items()}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(tokens, key=len, reverse=True))) + ")").split if tokens else None
        # The file writes each byte as a printable character: itself, or the next free one from 256 on.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in vocabulary.items() if token not in SPECIAL}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        self.odd = re.compile(r" (?!\S)|(?<!\S) ").search
        self.kept: dict[str, bytes] = {}
        self.path, self.slow = path, None
        self.blank = re.compile(r"\s{%d}" % BLANKS).search

    def whole(self, text: str) -> bytes:
        if len(text) >= BLANKS and self.blank(text):
            return self.by_library(text)
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def by_library(self, text: str) -> bytes:
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
            self.slow.encode_special_tokens = True  # added tokens were taken out before, or are ordinary text
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.parts is None:
            return self.ordinary(texts)
        parts = [self.parts(t) for t in texts]  # added tokens stand at odd places
        data = iter(self.ordinary([p for own in parts for p in own[::2]]))
        return [b"".join(self.added[p] if k % 2 else next(data) for k, p in enumerate(own)) for own in parts]

    def ordinary(self, texts: list[str]) -> list[bytes]:
        cut = [None if self.odd(t) else t.split(" ") for t in texts]
        if len(self.kept) > WORDS_KEPT:
            self.kept.clear()
        new: set[str] = set()
        for words in cut:
            if words:
                new.update(words[1:])
        new = [w for w in new if w not in self.kept]
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            ids = np.array(self.encoding.encode_ordinary(" " + " ".join(some)), "<u4")
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) != len(some):
                raise ValueError("a word does not begin with exactly one spaced token")
            data, ends = ids.tobytes(), np.append(starts[1:], len(ids))
            self.kept.update(zip(some, (data[4 * s : 4 * e] for s, e in zip(starts.tolist(), ends.tolist()))))
        find = self.kept.__getitem__
        return [self.whole(t) if words is None else self.whole(words[0]) + b"".join(map(find, words[1:])) for t, words in zip(texts, cut)]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; a first piece that is shorter takes what is over."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, capacity: int, with_ids: bool) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]):
        encode = Encoder(vocabulary, added=True)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            groups = np.cumsum(sizes_of(texts)) // (4 << 20)  # some 4 MB of text at a time
            for g in np.unique(groups).tolist():
                lo, hi = np.searchsorted(groups, [g, g + 1])
                rows = []
                for doc_id, data in zip(ids[lo:hi], encode([t or "" for t in texts[lo:hi].to_pylist()])):
                    data += end
                    for k, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                        own = data[4 * start : 4 * (start + length)]
                        rows.append((doc_id, k, start, length, zlib.crc32(own), own if with_ids else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECE)], schema=PIECE)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns that some best packing holds; ``counts`` per length loses what they use.

    From the longest length w down, with r = capacity - w:
    * nothing left fits into r: w stands alone;
    * a length of exactly r exists, or no two lengths together fit into r: {w, longest that fits} dominates, for
      whatever else stands with w can change places with it;
    * no three lengths fit into r, and the longest that fits is at least the largest sum of a pair: it dominates too;
    * no three lengths fit into r, and the pair with the largest sum is the longest that fits and some q, where no two
      lengths above q fit: {w, longest, q} dominates, as of any other pair one changes places with each of them.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []

    def take(*lengths: int) -> None:
        need = {x: lengths.count(x) for x in lengths}
        times = min(int(counts[x]) // k for x, k in need.items())
        for x, k in need.items():
            counts[x] -= times * k
        fixed.append((lengths, times))

    for w in range(capacity, 0, -1):
        while counts[w]:
            counts[w] -= 1
            left = np.flatnonzero(counts[: capacity - w + 1])
            spare = counts.copy()
            counts[w] += 1
            room = capacity - w
            if len(left) == 0:
                take(w)
                continue
            longest = int(left[-1])
            pair = best_pair(spare, left, room)
            if longest == room or pair is None:
                take(w, longest)
                continue
            if least_sum(spare, left, 3) > room:
                if longest >= sum(pair):
                    take(w, longest)
                    continue
                if pair[0] == longest and least_sum(spare, left[left > pair[1]], 2) > room:
                    take(w, *pair)
                    continue
            break
    return fixed


def least_sum(counts: np.ndarray, lengths: np.ndarray, k: int) -> int:
    """Sum of the k shortest pieces of the given lengths; beyond any capacity where there are fewer."""
    total = 0
    for x in lengths.tolist():
        n = min(k, int(counts[x]))
        total, k = total + n * x, k - n
        if k == 0:
            return total
    return 1 << 62


def best_pair(counts: np.ndarray, lengths: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two lengths with the largest sum within ``room``, the larger first; of equal sums the one with the least part."""
    i, j, best = 0, len(lengths) - 1, None
    while i <= j:
        a, b = int(lengths[i]), int(lengths[j])
        if a + b > room or (i == j and counts[a] < 2):
            j -= 1
            continue
        if best is None or a + b > sum(best):
            best = (b, a)
        i += 1
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the sequence with the least room that takes it; equal sequences are handled together."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}  # room left: pattern: number
    rooms = np.zeros(capacity + 1, np.int64)
    for w in range(capacity, 0, -1):
        n = int(counts[w])
        while n:
            fits = np.flatnonzero(rooms[w:])
            if len(fits):
                room = int(fits[0]) + w
                pattern, there = next(iter(open_[room].items()))
                moved = min(n, there)
                if moved == there:
                    del open_[room][pattern]
                else:
                    open_[room][pattern] = there - moved
                rooms[room] -= moved
                grown = [(pattern + (w,), moved)]
            else:
                each = capacity // w  # new sequences take as many of this length as fit
                grown = [((w,) * each, n // each)] if n >= each else []
                if n % each:
                    grown.append(((w,) * (n % each), 1))
            for pattern, times in grown:
                room = capacity - sum(pattern)
                at = open_.setdefault(room, {})
                at[pattern] = at.get(pattern, 0) + times
                rooms[room] += times
                n -= times * (pattern.count(w) if not len(fits) else 1)
        counts[w] = 0
    return [(pattern, times) for at in open_.values() for pattern, times in at.items()]


def plan(counts: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Slots by (length, first rank): sequence and offset of the pieces of that rank and on.

    A pattern with k pieces of a length uses ranks in runs of ``times``: run i takes offset i of every sequence.
    """
    left = counts.astype(np.int64).copy()
    patterns = reduce_by_dominance(left, capacity)
    patterns += best_fit(left, capacity)
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for w in pattern:
            rows.append((w, used[w], sequence, offset))
            used[w] += times
            offset += w
        sequence += times
    if (used != counts).any():
        raise AssertionError("a piece has no place")
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3], "sequences": sequence}


def packed(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (binary, on request), sequence_id, offset: a row per piece.

    A document is the ids of its text and the end id. Added tokens of the file count as such where a text holds them. Only documents above ``capacity`` are cut, into pieces of that
    length of which the first may be shorter. A null or empty text is the end id alone. Rows that repeat an id are
    packed like any other; their pieces share ids. A null id stays null. An empty table gives an empty result. Other
    columns are not read. ``vocabulary`` is the path of a byte-level BPE tokenizer file (JSON) that every executor has.
    """
    made = stored(pieces(docs, id_col, text_col, vocabulary, capacity, with_ids), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in made.groupBy("length").count().collect():  # a row per length, so at most the capacity
        counts[r[0]] = r[1]
    slots = plan(counts, capacity)
    hashed = made.withColumn("__md5", F.md5(F.concat_ws("/", "doc_id", "piece", "ids_crc32").cast("binary"))).withColumn("__one", F.lit(1).cast("long"))
    numbered = ranked(hashed.select("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "__md5", "__one"),
                      ["length"], ["__md5"], "__one", "rank")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]):
        wide = int(slots["rank"].max(initial=0)) + int(counts.max(initial=0)) + 1
        begin = slots["length"] * wide + slots["rank"]
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            at = np.searchsorted(begin, length * wide + rank, "right") - 1
            sequence = slots["sequence"][at] + rank - slots["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")] + [pa.array(sequence), pa.array(slots["offset"][at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"])

    ready = numbered if with_ids else numbered.withColumn("ids", F.lit(None).cast("binary"))
    return ready.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "rank").mapInArrow(place, schema)
