"""Spelling variants by a trie of letter-group counts.

Letters are dealt to 24 groups by their code. A word is the vector of its counts per group. Two words that differ by one
inserted, deleted or replaced letter have vectors that differ by at most one surplus and one deficit. So:

1. Words are arranged in a trie by the counts of successive groups, groups of widely spread counts first.
2. The upper part of the trie, made from a bounded sample of the words, cuts the vocabulary into subtrees of a bounded
   number of words. Every word walks it depth first with a budget of one surplus and one deficit and is sent to its own
   subtree and to all later ones that it can reach; so each pair of words meets once.
3. In a subtree all visiting words go down together, depth first; at every count they branch into those that spend
   nothing, a surplus or a deficit. A node of few words is a leaf. Leaf words are verified by their common head and tail.
4. A word's form is its near word of largest count; roots follow the forms by doubling the steps.

The sample decides how evenly words are dealt, never what is found. A subtree of one single vector with more words than
a task should hold is dealt into chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

GROUPS = 24
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Words of the sample that shapes the upper part of the trie.
SAMPLE = 1 << 16
#: Words of a subtree, and of a leaf in it.
SUBTREE, LEAF = 1 << 15, 32
#: Longest word that is verified in arrays; longer ones one by one.
WIDE = 32
#: Pairs verified at a time.
PAIRS_AT_ONCE = 1 << 19


def vectors_of(words: list[bytes]) -> np.ndarray:
    """Counts per letter group, up to 255; cutting keeps differences within the budget."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8)
    out = np.zeros((len(words), GROUPS), np.uint8)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(words):  # pieces of bounded size; one very long word is a piece
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + (1 << 20), "right")))
        piece = letters[ends[lo] - sizes[lo] : ends[hi - 1]] % GROUPS
        own = np.repeat(np.arange(hi - lo) * GROUPS, sizes[lo:hi])
        counts = np.bincount(own + piece, minlength=(hi - lo) * GROUPS)
        out[lo:hi] = np.minimum(counts, 255).reshape(-1, GROUPS)
        lo = hi
    return out


class UpperTrie:
    """Inner nodes as (group, children by count); the last child takes all greater counts. Leaves are numbers."""

    def __init__(self, sample: np.ndarray, share: float):
        self.order = np.argsort(-sample.std(0), kind="stable") if len(sample) else np.arange(GROUPS)
        self.chunks: list[int] = []
        self.root = self._built(sample[:, self.order], 0, max(1.0, SUBTREE * share), share)
        self.first = np.cumsum([0] + self.chunks)

    def _built(self, rows: np.ndarray, level: int, most: float, share: float):
        if len(rows) <= most or level == GROUPS:
            self.chunks.append(max(1, -(-int(len(rows) / share) // SUBTREE)) if level == GROUPS else 1)
            return len(self.chunks) - 1
        column = rows[:, level]
        return [self._built(rows[column == c], level + 1, most, share) for c in range(int(column.max()) + 2)]

    def reached(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, words that reach it, whether it is their own) for all leaves."""
        vectors = vectors[:, self.order].astype(np.int16)
        n = len(vectors)
        stack = [(self.root, 0, np.arange(n), np.zeros(n, np.int8), np.zeros(n, np.int8), np.ones(n, bool))]
        while stack:
            node, level, who, surplus, deficit, own = stack.pop()
            if len(who) == 0:
                continue
            if isinstance(node, int):
                yield node, who, own
                continue
            count = vectors[who, level]
            for c, child in enumerate(node):
                last = c == len(node) - 1
                step = np.maximum(c - count, 0) if last else c - count
                more, less = surplus + (step > 0), deficit + (step < 0)
                good = np.flatnonzero((np.abs(step) <= 1) & (more <= 1) & (less <= 1))
                stack.append((child, level + 1, who[good], more[good], less[good], own[good] & (step[good] == 0)))


SENT = pa.schema([("target", pa.int32()), ("data", pa.binary())])
SENT_SQL = "target int, data binary"
STORED, OWN = 1, 2


def routed(batches: Iterator[pa.RecordBatch], trie: UpperTrie) -> Iterator[pa.RecordBatch]:
    """Words, packed by the subtrees where they are stored or looked for."""
    for batch in batches:
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        if not words:
            continue
        n = np.asarray(batch.column("n"))
        vectors = vectors_of(words)
        reached = list(trie.reached(vectors))
        home = np.zeros(len(words), np.int64)
        for leaf, who, own in reached:
            home[who[own]] = leaf
        chunk = vectors_chunk(words) if max(trie.chunks) > 1 else np.zeros(len(words), np.int64)
        target, data = [], []
        for leaf, who, own in reached:
            later = home[who] <= leaf
            who, own = who[later], own[later]
            if len(who) == 0:
                continue
            for c in range(trie.chunks[leaf]):
                flag = own * OWN + (own & (chunk[who] % trie.chunks[leaf] == c)) * STORED
                target.append(int(trie.first[leaf]) + c)
                data.append(packed(words, n, who, flag.astype(np.uint8)))
        yield pa.RecordBatch.from_arrays([pa.array(target, pa.int32()), pa.array(data, pa.binary())], schema=SENT)


def vectors_chunk(words: list[bytes]) -> np.ndarray:
    return np.array([sum(w) * 31 + w[0] * 7 + w[-1] * 13 + w[len(w) // 2] for w in words], np.int64)


def packed(words: list[bytes], n: np.ndarray, who: np.ndarray, flag: np.ndarray) -> bytes:
    some = [words[i] for i in who.tolist()]
    return np.array([len(some)], np.int64).tobytes() + flag.tobytes() + n[who].astype(np.int64).tobytes() + b" ".join(some)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    size = int(np.frombuffer(data, np.int64, 1)[0])
    return np.frombuffer(data, np.uint8, size, 8), np.frombuffer(data, np.int64, size, 8 + size), data[8 + 9 * size :].split(b" ")


class Verifier:
    """Tells which pairs of words differ by exactly one inserted, deleted or replaced letter."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        fitted = [w[:WIDE] for w in words]
        self.head = np.array(fitted, f"S{WIDE}").view(np.uint8).reshape(-1, WIDE)
        self.tail = np.array([w[: -WIDE - 1 : -1] for w in words], f"S{WIDE}").view(np.uint8).reshape(-1, WIDE)
        self.head8, self.tail8 = (np.ascontiguousarray(m[:, :8]).view("<u8")[:, 0] for m in (self.head, self.tail))
        self.mask = np.array([(1 << (8 * min(k, 8))) - 1 for k in range(9)], np.uint64)

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.size[i], self.size[j]
        longer = np.maximum(a, b)
        # The common head or the common tail has half of the equal letters.
        half = self.mask[np.minimum(longer // 2, 8)]
        good = ((self.head8[i] ^ self.head8[j]) & half) == 0
        good |= ((self.tail8[i] ^ self.tail8[j]) & half) == 0
        good &= np.abs(a - b) <= 1
        some = np.flatnonzero(good)
        i, j, longer = i[some], j[some], longer[some]
        common = np.zeros(len(i), np.int64)
        for m in (self.head, self.tail):
            other = m[i] != m[j]
            common += np.where(other.any(1), other.argmax(1), WIDE)
        near = common >= longer - 1
        for k in np.flatnonzero(longer > WIDE).tolist():
            near[k] = _one_apart(self.words[i[k]], self.words[j[k]])
        near &= common < 2 * longer  # a word is not near itself
        return i[near], j[near]


def _one_apart(a: bytes, b: bytes) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    other = np.flatnonzero(x[:n] != y[:n])
    head = int(other[0]) if len(other) else n
    other = np.flatnonzero(x[::-1][:n] != y[::-1][:n])
    tail = int(other[0]) if len(other) else n
    return head + tail >= max(len(a), len(b)) - 1


def signatures(vectors: np.ndarray) -> np.ndarray:
    """One bit for every count reached, up to three in the first 16 groups of the order and two in the others.

    The number of bits in which two words differ is at most the sum of the differences of their counts.
    """
    out = np.zeros(len(vectors), np.uint64)
    bit = 0
    for group in range(GROUPS):
        for reached in range(1, 4 if group < 16 else 3):
            out |= (vectors[:, group] >= reached).astype(np.uint64) << np.uint64(bit)
            bit += 1
    return out


def met(vectors: np.ndarray, kept: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(visiting word, stored word) of all leaves that a visitor reaches; ``kept`` in the order of their vectors.

    A leaf holds stored words whose last groups may differ, so their budget is checked on signatures.
    """
    rows, signs = vectors[kept], signatures(vectors)
    kept_signs = signs[kept]
    n = len(vectors)
    stack = [(0, len(rows), 0, np.arange(n), np.zeros(n, np.int8), np.zeros(n, np.int8))]
    while stack:
        lo, hi, level, who, surplus, deficit = stack.pop()
        if hi - lo <= LEAF or level == GROUPS:
            step = max(1, PAIRS_AT_ONCE // (hi - lo))
            for at in range(0, len(who), step):
                some = who[at : at + step]
                i, j = np.nonzero(np.bitwise_count(signs[some][:, None] ^ kept_signs[None, lo:hi]) <= 2)
                yield some[i], kept[lo:hi][j]
            continue
        column = rows[lo:hi, level]
        borders = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), hi - lo]
        count = vectors[who, level]
        for x, y in zip(borders[:-1], borders[1:]):
            step = column[x] - count
            more, less = surplus + (step > 0), deficit + (step < 0)
            good = np.flatnonzero((np.abs(step) <= 1) & (more <= 1) & (less <= 1))
            if len(good):
                stack.append((lo + x, lo + y, level + 1, who[good], more[good], less[good]))


FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
FOUND_SQL = "word string, n_near long, best_n long, best string"


def searched(batches: Iterator[pa.RecordBatch], order: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Near words of the subtrees of a task, one after the other: per word their number and the most frequent one."""
    target, held = None, []
    for batch in batches:
        data = batch.column("data")
        for i, t in enumerate(batch.column("target").to_pylist()):
            if t != target:
                yield from subtree(held, order)
                target, held = t, []
            held.append(data[i].as_py())
    yield from subtree(held, order)


def subtree(held: list[bytes], order: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts = [unpacked(d) for d in held]
    words = [w for _, _, some in parts for w in some]
    if not words:
        return
    flag, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    # Numbers in the order of the words: equal counts are won by the smaller number.
    by_word = np.array(sorted(range(len(words)), key=words.__getitem__))
    words, flag, n = [words[i] for i in by_word.tolist()], flag[by_word], n[by_word]
    vectors = vectors_of(words)[:, order].astype(np.int16)
    kept = np.flatnonzero(flag & STORED)
    kept = kept[np.lexsort(vectors[kept].T[::-1])]
    verifier = Verifier(words)
    own = (flag & OWN) > 0
    number = np.zeros(len(words), np.int64)
    best = np.full(len(words), -1)

    def take(i: np.ndarray, j: np.ndarray) -> None:
        rule = ~own[i] | (i < j)  # two words of one subtree meet both ways
        i, j = verifier.near(i[rule], j[rule])
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        number[:] += np.bincount(a, minlength=len(words))
        win = np.lexsort((-b, n[b], a))  # per word the last is its most frequent near word
        a, b = a[win], b[win]
        last = np.flatnonzero(np.append(a[1:] != a[:-1], True)) if len(a) else np.zeros(0, np.int64)
        a, b = a[last], b[last]
        old = best[a]
        better = (old < 0) | (n[b] > n[old]) | ((n[b] == n[old]) & (b < old))
        best[a[better]] = b[better]

    if len(kept):
        waiting, size = [], 0
        for pair in met(vectors, kept):
            waiting.append(pair)
            size += len(pair[0])
            if size >= PAIRS_AT_ONCE:
                take(*map(np.concatenate, zip(*waiting)))
                waiting, size = [], 0
        if waiting:
            take(*map(np.concatenate, zip(*waiting)))
    some = np.flatnonzero(number)
    for at in range(0, len(some), 10_000):
        part = some[at : at + 10_000].tolist()
        rows = [(words[i].decode("latin-1"), int(number[i]), int(n[best[i]]), words[best[i]].decode("latin-1")) for i in part]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), FOUND)], schema=FOUND)


def vocabulary(docs: DataFrame, id_col: str, text_col: str, letters: int, least: int, divisor: int) -> DataFrame:
    """(word, n): words of all texts, one in ``divisor`` without one of its letters, by the checksum of id and word."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text, name = F.col(text_col).cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    found = docs.select(name.alias("id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("found"))
    runs = found.select("id", F.when(F.col("found").rlike("[A-Z]"), F.translate("found", upper, upper.lower())).otherwise(F.col("found")).alias("run"))
    # A word of too few letters stays so without one of them.
    runs = runs.filter(F.char_length("run") >= letters).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    place = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("h") % divisor == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.char_length("word") >= letters).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of all words that have a near word, from stored rows (word, n) of distinct words."""
    total = words.count()
    share = min(1.0, SAMPLE / max(total, 1))
    cut = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)) if share < 1 else F.lit(True)

    def vectors(batches):
        for batch in batches:
            some = vectors_of([w.encode("latin-1") for w in batch.column("word").to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in some], pa.binary())], ["v"])

    sample = words.filter(cut).select("word").mapInArrow(vectors, "v binary").collect()
    trie = UpperTrie(np.array([np.frombuffer(r.v, np.uint8) for r in sample], np.uint8).reshape(-1, GROUPS), share)
    sent = words.select("word", "n").mapInArrow(lambda it: routed(it, trie), SENT_SQL)
    targets, order = int(trie.first[-1]), trie.order
    dealt = sent.repartitionById(targets, F.col("target")).sortWithinPartitions("target")
    found = dealt.mapInArrow(lambda it: searched(it, order), FOUND_SQL)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): forms followed to the last, twice as far in every round.

    Forms have at least twice the count of their words, so that a chain is short. Words whose last form is reached take
    no further part, so a form that very many words lead to is no join key.
    """
    has = links.select(F.col("word").alias("__w"))
    jump = links.join(has, F.col("form") == F.col("__w"), "left").select("word", F.col("form").alias("to"), F.col("__w").isNotNull().alias("open"))
    jump = stored(jump, "forms")
    while not jump.filter("open").isEmpty():
        far = jump.select(F.col("word").alias("__w"), F.col("to").alias("__to"), F.col("open").alias("__open"))
        further = jump.filter("open").join(far, F.col("to") == F.col("__w")).select("word", F.col("__to").alias("to"), F.col("__open").alias("open"))
        jump = stored(jump.filter("not open").unionByName(further), "forms")
    return jump.select("word", F.col("to").alias("root"))


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = 5, least: int = 3, divisor: int = 97) -> DataFrame:
    """Spelling variants among the words of all texts, each with the word it is a variant of.

    A word is a longest run of A-Z, a-z and U+00C0 to U+00FF, with only A-Z lower-cased; where ``divisor`` divides the
    crc32 of ``<id>:<run>`` it lacks the letter at that number modulo its length. Words have at least ``letters`` letters
    and ``least`` occurrences. Two words are near if they differ by exactly one inserted, deleted or replaced letter.

    Result, a row per word: word, form (near word of largest count, ties to the smaller in code-point order, if that
    count is at least twice the word's; else null), root (the last form reached, the word itself without form), n,
    n_near, form_n (null without form). A null or empty text has no words, a missing id counts as the empty text, and
    rows that repeat an id all count. An empty table gives an empty result. Words of any length are compared in full.
    Other columns of the input are not read and may have any name.
    """
    words = stored(vocabulary(docs, id_col, text_col, letters, least, divisor), "words")
    near = near_words(words).withColumnRenamed("word", "__w")
    joined = words.join(near, F.col("word") == F.col("__w"), "left")
    far = F.col("best_n") >= 2 * F.col("n")
    formed = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(far, F.col("best")).alias("form"),
                                  F.when(far, F.col("best_n")).alias("form_n")), "formed")
    ends = roots(formed.filter("form is not null").select("word", "form")).withColumnRenamed("word", "__w")
    return formed.join(ends, F.col("word") == F.col("__w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
