"""Periodic runs of words by longest common extensions over a difference cover.

The residues {0, 1, 3, 8, 12, 18} modulo 31 are a difference cover: for any two places i and j there is exactly one shift
below 31 that moves both onto sampled places (i and j of one residue need at most 17 words to the next sample).

1. Only the suffixes that start at sampled places (6 of 31) are sorted: by their first 31 words, then by doubling, as the
   sample 31 * 2^k words further on is 6 * 2^k samples further on. The ranks of the rounds give the common lengths of
   neighbours, a sparse table gives their minimum over any stretch.
2. The common extension of two places compares words until both are at samples, at most 30, and then asks the table.
   Extensions to the left are those of the reversed sequence.
3. Harmonic grid: for every period q the places 0, q, 2q, ... are looked at; that are n ln n places. A run of three
   periods holds three neighbouring grid places with equal words, and the first of them starts at least nine words that
   repeat q words further on. Places that pass these comparisons are extended to both sides. A stretch found with several
   periods keeps the smallest.

A document is the unit of work: documents stay where they are read, nothing is shuffled. Sorting is left out where no
grid place passes, which is so for nearly all prose.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
#: Fewest words and periods of a run.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words after the first grid place of a run that repeat one period further on (25 - 2q up to q = 8, q + 1 from there).
SURE = 9
#: Grid places are made for so many last places at a time.
TOPS_AT_ONCE = 1 << 16

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: Number of the sample within its block of 31 words.
_NUMBER = np.cumsum(_IN_COVER) - 1
_SHIFT = np.array([[next(t for t in range(PERIOD) if _IN_COVER[(a + t) % PERIOD] and _IN_COVER[(b + t) % PERIOD]) for b in range(PERIOD)]
                   for a in range(PERIOD)])


class CommonExtensions:
    """Number of equal words from two places on, for many pairs of places at a time."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.codes = np.concatenate([codes, -1 - np.arange(PERIOD + 1)])  # no two places behind the end are equal
        self.rank = None

    def _sorted(self) -> None:
        """Ranks of the sampled suffixes and the table of the least common lengths."""
        places = np.arange(self.n)[_IN_COVER[np.arange(self.n) % PERIOD]]
        m, size = len(places), len(COVER)
        columns = tuple(self.codes[places + t] for t in range(PERIOD - 1, -1, -1))
        order = np.lexsort(columns)
        new = np.zeros(m, bool)
        for c in columns:
            new[1:] |= c[order][1:] != c[order][:-1]
        del columns
        ranks = [_numbered(order, new)]
        step = size
        while m and ranks[-1].max() < m - 1:
            rank, after = ranks[-1], np.full(m, -1)
            after[: max(0, m - step)] = rank[step:]
            order = np.lexsort((after, rank))
            new = np.zeros(m, bool)
            new[1:] = (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])
            ranks.append(_numbered(order, new))
            step *= 2
        x, y = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(0, m - 1), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            same = (x < m) & (y < m)
            same &= ranks[k][np.minimum(x, m - 1)] == ranks[k][np.minimum(y, m - 1)]
            common += same * (PERIOD << k)
            x, y = x + same * (size << k), y + same * (size << k)
        cover = np.array(COVER)
        x, y = x // size * PERIOD + cover[x % size], y // size * PERIOD + cover[y % size]
        common += self._compared(x, y, np.full(len(x), PERIOD))
        self.rank, levels = ranks[-1], [common]
        while len(levels[-1]) > 1 << (len(levels) - 1):
            half = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
        self.table = np.concatenate(levels)
        self.begin = np.cumsum([0] + [len(v) for v in levels[:-1]])

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, up to ``most``."""
        out = np.zeros(len(i), np.int64)
        open_ = np.flatnonzero(most > 0)
        last = len(self.codes) - 1
        for t in range(int(most.max(initial=0))):
            open_ = open_[most[open_] > t]
            open_ = open_[self.codes[np.minimum(i[open_] + t, last)] == self.codes[np.minimum(j[open_] + t, last)]]
            if len(open_) == 0:
                break
            out[open_] = t + 1
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places i < j <= n."""
        shift = _SHIFT[i % PERIOD, j % PERIOD]
        out = self._compared(i, j, shift)
        met = np.flatnonzero((out == shift) & (j + shift < self.n))
        if len(met):
            if self.rank is None:
                self._sorted()
            x, y = ((p[met] + shift[met]) for p in (i, j))
            x, y = (self.rank[p // PERIOD * len(COVER) + _NUMBER[p % PERIOD]] for p in (x, y))
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            k = np.frexp((hi - lo).astype(float))[1] - 1
            at = self.begin[k]
            out[met] += np.minimum(self.table[at + lo], self.table[at + hi - (1 << k)])
        return out


def _numbered(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def grid(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(last place, period) of all triples of neighbouring grid places whose last place is in [low, high)."""
    period = np.arange(1, max(1, (high + 1) // 2))
    first = np.maximum(2, -(-low // period))
    count = np.maximum(0, (high - 1) // period - first + 1)
    total = int(count.sum())
    q = np.repeat(period, count)
    step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    top = (np.repeat(first, count) + step) * q
    order = np.argsort(top, kind="stable")
    return top[order].astype(np.int32), q[order].astype(np.int32)


class Grid:
    """The grid of short sequences; that of a shorter sequence is the head of that of a longer one."""

    def __init__(self, words: int = 1 << 14):
        self.top, self.period = grid(0, words)
        self.until = np.searchsorted(self.top, np.arange(words + 1))
        self.words = words

    def blocks(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        short = self.until[min(n, self.words)]
        yield self.top[:short], self.period[:short]
        for low in range(self.words, n, TOPS_AT_ONCE):
            yield grid(low, min(n, low + TOPS_AT_ONCE))


def runs_in(codes: np.ndarray, places: Grid) -> np.ndarray:
    """Rows (start, length, smallest period) of all runs, by start, then period."""
    n = len(codes)
    found = []
    right = left = None
    for top, period in places.blocks(n):
        word = codes[top]
        some = np.flatnonzero(word == codes[top - period])
        some = some[word[some] == codes[top[some] - 2 * period[some]]]
        q = period[some].astype(np.int64)
        i = top[some] - 2 * q
        for t in range(1, SURE):
            if len(i) == 0:
                break
            good = np.flatnonzero(i + q + t < n)
            good = good[codes[i[good] + t] == codes[i[good] + q[good] + t]]
            i, q = i[good], q[good]
        if len(i) == 0:
            continue
        if right is None:
            right, left = CommonExtensions(codes), CommonExtensions(codes[::-1])
        start = i - left(n - i - q, n - i)
        length = i + q + right(i, i + q) - start
        long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found.append(_smallest_period(np.stack([start[long], length[long], q[long]], 1)))
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = _smallest_period(np.concatenate(found))
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _smallest_period(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[new]


def coded(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))


def planted(words: list[bytes], doc_id: int) -> np.ndarray | None:
    """Which word stands at every place after the edit of one document in ten; None where nothing changes."""
    n, h = len(words), zlib.crc32(b"%d" % doc_id)
    if h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % (1 + (n - a) // (3 + g % 8)))


OUT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
                 ("exponent_milli", pa.int64()), ("runs", pa.list_(pa.list_(pa.int64()))), ("collapsed", pa.binary())])
OUT_SQL = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs array<array<long>>, collapsed binary")


def searched(batches: Iterator[pa.RecordBatch], edited: bool) -> Iterator[pa.RecordBatch]:
    places = Grid()
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            words = (text or b"").split()
            moved = planted(words, doc_id) if edited and doc_id is not None else None
            if moved is not None:
                words = [words[i] for i in moved.tolist()]
            runs = runs_in(coded(words), places)
            best = (None,) * 4
            if len(runs):
                s, n, q = min(runs.tolist(), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
                best = (s, n, q, 1000 * n // q)
                marks = np.zeros(len(words) + 1, np.int64)
                np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
                np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(marks[:-1]) == 0).tolist()]
            rows.append((doc_id, len(runs), *best, runs.tolist(), b" ".join(words)))
            size += len(rows[-1][-1])
            if size > 8 << 20 or len(rows) >= 2000:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), OUT)], schema=OUT)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edited: bool = False) -> DataFrame:
    """All periodic runs of the words of every text, and the text with every run cut to its first period.

    Words are the runs of other characters than space, tab, line feed, vertical tab, form feed and carriage return. A run
    is a stretch of words with smallest period q, of at least 24 words and three periods, that no neighbouring word
    extends. With ``edited`` one document in ten, told by the checksum of its id, first repeats a stretch of its words.

    Result, a row per input row: doc_id, n_runs; start, length, period, exponent_milli of the run with the greatest
    length / period (ties: smallest start, then period; null without a run); runs (array of [start, length, period] by
    start, then period); collapsed (binary: the words that no run drops, joined by one space). A null or empty text has
    no words. Rows that repeat an id are searched each on its own; a row without id is searched and never edited. An
    empty table gives an empty result. A text of any length is searched as a whole, its grid in blocks. Other columns
    of the input are not read and may have any name.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(lambda it: searched(it, edited), OUT_SQL)


def digest_of(runs: F.Column) -> F.Column:
    """SHA-256 of ``start,length,period`` and a line feed for every run."""
    lines = F.transform(runs, lambda r: F.concat(F.array_join(F.transform(r, lambda x: x.cast("string")), ","), F.lit("\n")))
    return F.sha2(F.array_join(lines, "").cast("binary"), 256)
