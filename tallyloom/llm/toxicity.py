"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, trained in numpy.

Input of a word: an embedding of the hashed word plus the mean embedding of its hashed character trigrams. A network
of gated units reads a window of words in both directions, attention pools the states, a logistic unit scores the
window. Overlapping windows of 24 words, one from every ``STRIDE`` words on, cover the text; the largest score counts,
turned into a probability by a logistic curve that is fitted on the same learning rows. A passage of up to
WINDOW - STRIDE + 1 words lies whole in a scored window wherever it stands.

The part of the work that depends on a word alone (its projection on the gates) is done once per distinct word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sizes_of
from .language import FOLD, held_out

#: Learning rows at most, of each label.
ROWS = {1: 1500, 0: 2500}
#: Bytes of learning texts at most, of each label, and what a row counts beside its text.
BYTES, ROW_BYTES = {1: 24 << 20, 0: 40 << 20}, 64
WINDOW, STRIDE = 24, 6
WORDS, CHARS, EMBED, HIDDEN = 1 << 16, 1 << 13, 6, 6
#: Distinct words a task remembers, windows scored at a time.
WORDS_KEPT, WINDOWS_AT_ONCE = 200_000, 4096


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def word_parts(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash bucket of each word; buckets of its character trigrams and where each word's begin."""
    whole = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    text = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))  # a word of n bytes has n trigrams with its marks
    begin = np.cumsum(size) - size
    at = np.repeat(np.cumsum(size + 2) - size - 2 - begin, size) + np.arange(int(size.sum()))
    codes = (text[at] << np.uint32(16)) | (text[at + 1] << np.uint32(8)) | text[at + 2]
    return (whole % np.uint64(WORDS)).astype(np.int64), ((codes * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64), begin


class Network:
    """Parameters by name; a word number 0 is padding and leaves the state as it is."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        small = lambda *s: (draw.standard_normal(s) * 0.3).astype(np.float32)
        self.p = {"word": np.zeros((WORDS, EMBED), np.float32), "char": small(CHARS, EMBED) * 0.1}
        for d in ("f", "b"):
            self.p |= {f"in_{d}": small(EMBED, 3 * HIDDEN), f"bias_{d}": np.zeros(3 * HIDDEN, np.float32), f"gate_{d}": small(HIDDEN, 2 * HIDDEN), f"new_{d}": small(HIDDEN, HIDDEN)}
        self.p |= {"attend": small(2 * HIDDEN), "out": small(2 * HIDDEN), "out_bias": np.zeros(1, np.float32)}
        self.curve = (1.0, 0.0)

    def embed(self, buckets: np.ndarray, chars: np.ndarray, begin: np.ndarray) -> np.ndarray:
        size = np.diff(np.append(begin, len(chars)))
        return self.p["word"][buckets] + np.add.reduceat(self.p["char"][chars], begin, axis=0) / size[:, None]

    def projected(self, embedded: np.ndarray) -> np.ndarray:
        """Input part of the gates of both directions; row 0 is padding."""
        both = np.concatenate([embedded @ self.p["in_f"] + self.p["bias_f"], embedded @ self.p["in_b"] + self.p["bias_b"]], axis=1)
        return np.concatenate([np.zeros((1, both.shape[1]), np.float32), both.astype(np.float32)])

    def run(self, table: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Logits of windows (n x WINDOW word numbers); with ``keep`` also what the gradient needs."""
        n, steps = windows.shape
        real = windows > 0
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        trace = {}
        for d, lo, order in (("f", 0, range(steps)), ("b", HIDDEN, range(steps - 1, -1, -1))):
            h = np.zeros((n, HIDDEN), np.float32)
            gate, new = self.p[f"gate_{d}"], self.p[f"new_{d}"]
            for t in order:
                x = table[windows[:, t], 3 * lo : 3 * lo + 3 * HIDDEN]
                g = sigmoid(x[:, : 2 * HIDDEN] + h @ gate)
                z, r = g[:, :HIDDEN] * real[:, t, None], g[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ new)
                if keep:
                    trace[d, t] = (h, z, r, c)
                h = h + z * (c - h)
                states[t, :, lo : lo + HIDDEN] = h
        raw = states @ self.p["attend"]
        raw = np.where(real.T, raw, -1e9)
        weight = np.exp(raw - raw.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logits = pooled @ self.p["out"] + self.p["out_bias"]
        return (logits, states, weight, pooled, trace) if keep else logits

    def gradient(self, table, windows, target, importance):
        logits, states, weight, pooled, trace = self.run(table, windows, keep=True)
        n, steps = windows.shape
        real = windows > 0
        g: dict[str, np.ndarray] = {}
        d_logit = ((sigmoid(logits) - target) * importance / n).astype(np.float32)
        g["out"], g["out_bias"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * self.p["out"]
        along = np.einsum("tnh,nh->tn", states, d_pooled)
        d_raw = weight * (along - (weight * along).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", d_raw, states)
        d_states = weight[:, :, None] * d_pooled + d_raw[:, :, None] * self.p["attend"]
        d_table = np.zeros_like(table)
        for d, lo, order in (("f", 0, range(steps - 1, -1, -1)), ("b", HIDDEN, range(steps))):
            gate, new = self.p[f"gate_{d}"], self.p[f"new_{d}"]
            g_gate, g_new = np.zeros_like(gate), np.zeros_like(new)
            d_h = np.zeros((n, HIDDEN), np.float32)
            for t in order:
                h, z, r, c = trace[d, t]
                d_h = d_h + d_states[t, :, lo : lo + HIDDEN]
                d_c = d_h * z * (1 - c * c)
                on = real[:, t, None]
                d_z = d_h * (c - h) * z * (1 - z) * on
                back = d_c @ new.T
                d_r = back * h * r * (1 - r)
                g_new += (r * h).T @ d_c
                d_g = np.concatenate([d_z, d_r], axis=1)
                g_gate += h.T @ d_g
                np.add.at(d_table, (windows[:, t], slice(3 * lo, 3 * lo + 3 * HIDDEN)), np.concatenate([d_g, d_c], axis=1) * on)
                d_h = d_h * (1 - z) + back * r + d_g @ gate.T
            g[f"gate_{d}"], g[f"new_{d}"] = g_gate, g_new
        return g, d_table[1:]


def windows_of(numbers: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the documents, whose words stand one after another: (windows, document of each)."""
    count = np.bincount(owners, minlength=n)
    begin = np.cumsum(count) - count
    per = np.where(count > 0, np.maximum(1, -(-(count - WINDOW) // STRIDE) + 1), 0)
    owner = np.repeat(np.arange(n), per)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    start = begin[owner] + nth * STRIDE
    end = (begin + count)[owner]
    out = np.zeros((len(owner), WINDOW), np.int32)
    for t in range(WINDOW):
        inside = np.flatnonzero(start + t < end)
        out[inside, t] = numbers[start[inside] + t]
    return out, owner


def folded_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def train(texts: list[bytes], labels: np.ndarray, rounds: int = 6, seed: int = 5) -> Network:
    """Each round takes the highest windows of every document and random ones of clean documents (a document is toxic
    for one window). Word embeddings begin with the log odds of the word's document frequency."""
    net, draw = Network(seed), np.random.default_rng(seed)
    vocabulary: dict[bytes, int] = {}
    lists = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in folded_words(t)], np.int32) for t in texts]
    if not vocabulary or len(set(labels.tolist())) < 2:
        net.curve = (0.0, float(np.log((labels.mean() + 1e-3) / (1 - labels.mean() + 1e-3))) if len(labels) else -5.0)
        return net
    buckets, chars, begin = word_parts(list(vocabulary))
    numbers = np.concatenate(lists)
    owners = np.repeat(np.arange(len(lists)), [len(w) for w in lists])
    seen = np.unique(owners * (WORDS + 1) + buckets[numbers - 1])
    doc, bucket = seen // (WORDS + 1), seen % (WORDS + 1)
    share = [(np.bincount(bucket[labels[doc] == k], minlength=WORDS) + 3.0) / ((labels == k).sum() + 6.0) for k in (0, 1)]
    odds = np.log(share[1] / share[0])
    many = np.bincount(bucket, minlength=WORDS)
    net.p["word"][:, 0] = np.where(many > 4, np.clip(odds, -4, 4), 0)
    for d in ("f", "b"):  # the first unit of either direction starts by listening to the odds
        net.p[f"in_{d}"][0, 2 * HIDDEN] = 1.0
        net.p[f"in_{d}"][0, 0] = 1.0
    net.p["attend"][[0, HIDDEN]] = 1.0
    net.p["out"][[0, HIDDEN]] = 2.0
    windows, owner = windows_of(numbers, owners, len(lists))
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    step, size = 0, np.diff(np.append(begin, len(chars)))
    share_1 = max(1e-3, labels.mean())
    for _ in range(rounds):
        embedded = net.embed(buckets, chars, begin)
        logits = scored(net, net.projected(embedded), windows)
        order = np.lexsort((-logits, owner))
        nth = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        top = order[nth < 2]
        top = top[(labels[owner[top]] == 0) | np.isin(top, order[nth < 1])]
        extra = np.flatnonzero(labels[owner] == 0)
        chosen = np.concatenate([top, draw.choice(extra, min(len(extra), 4000), replace=False)])
        chosen = draw.permutation(chosen)
        for at in range(0, len(chosen), 512):
            some = chosen[at : at + 512]
            used, local = np.unique(windows[some], return_inverse=True)
            used, local = (used, local + 0) if used[0] == 0 else (np.concatenate([[0], used]), local + 1)
            local = local.reshape(len(some), WINDOW)
            w = used[1:] - 1
            part_chars = np.concatenate([chars[begin[i] : begin[i] + size[i]] for i in w.tolist()])
            part_begin = np.cumsum(size[w]) - size[w]
            embedded = net.embed(buckets[w], part_chars, part_begin)
            target = labels[owner[some]].astype(np.float32)
            g, d_rows = net.gradient(net.projected(embedded), local, target, np.where(target == 1, 0.5 / share_1, 1.0))
            d_embed = np.zeros_like(embedded)
            for k, d in enumerate(("f", "b")):
                part = d_rows[:, 3 * HIDDEN * k : 3 * HIDDEN * (k + 1)]
                g[f"in_{d}"], g[f"bias_{d}"] = embedded.T @ part, part.sum(axis=0)
                d_embed += part @ net.p[f"in_{d}"].T
            g["word"], g["char"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["char"])
            np.add.at(g["word"], buckets[w], d_embed)
            np.add.at(g["char"], part_chars, np.repeat(d_embed / size[w][:, None], size[w], axis=0))
            step += 1
            for k, v in g.items():
                m, s = moments[k]
                m *= 0.9
                m += 0.1 * v
                s *= 0.99
                s += 0.01 * v * v
                net.p[k] -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    logits = scored(net, net.projected(net.embed(buckets, chars, begin)), windows)
    highest = np.full(len(lists), logits.min())
    np.maximum.at(highest, owner, logits)
    net.curve = logistic_curve(highest, labels)
    return net


def logistic_curve(x: np.ndarray, labels: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of P(label | x) by Newton's method, with a slightly softened target."""
    target = labels * 0.98 + 0.01
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * x + b)
        v = p * (1 - p) + 1e-9
        g = np.array([((p - target) * x).sum() + ridge * a, (p - target).sum() + ridge * b])
        h = np.array([[(v * x * x).sum() + ridge, (v * x).sum()], [(v * x).sum(), v.sum() + ridge]])
        change = np.linalg.solve(h, g)
        a, b = a - change[0], b - change[1]
        if np.abs(change).max() < 1e-9:
            break
    return (float(a), float(b)) if np.isfinite(a) and np.isfinite(b) and a > 0 else (1.0, 0.0)


def scored(net: Network, table: np.ndarray, windows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(windows), np.float32)
    for at in range(0, len(windows), WINDOWS_AT_ONCE):
        out[at : at + WINDOWS_AT_ONCE] = net.run(table, windows[at : at + WINDOWS_AT_ONCE])
    return out


class Scorer:
    def __init__(self, net: Network):
        self.net = net
        self.number: dict[bytes, int] = {}
        self.table = net.projected(np.zeros((0, EMBED), np.float32))
        self.none = float(sigmoid(net.curve[1] - 5.0 * net.curve[0]))

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        if len(self.number) > WORDS_KEPT:
            self.number.clear()
            self.table = self.table[:1]
        lists = [folded_words(t) for t in texts]
        new = [w for w in set().union(*lists) if w not in self.number]
        if new:
            first = len(self.table)
            self.table = np.concatenate([self.table, self.net.projected(self.net.embed(*word_parts(new)))[1:]])
            self.number.update(zip(new, range(first, first + len(new))))
        find = self.number.__getitem__
        owners = np.repeat(np.arange(len(lists)), [len(w) for w in lists])
        numbers = np.fromiter((find(w) for words in lists for w in words), np.int32, len(owners))
        highest = np.full(len(lists), -np.inf)
        if len(numbers):
            windows, owner = windows_of(numbers, owners, len(lists))
            np.maximum.at(highest, owner, scored(self.net, self.table, windows))
        a, b = self.net.curve
        return np.where(np.isfinite(highest), sigmoid(a * np.where(np.isfinite(highest), highest, 0.0) + b), self.none).astype(np.float64)


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, out) -> Network:
    """Trains on the driver, on a sample in hash order that is bounded in rows and in bytes.

    The texts of the chosen ids, as many at most, are measured on the executors. In hash order, ids whose texts would
    go beyond ``BYTES`` are passed over; the texts of the others are fetched. All texts are scored, whatever their size.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("__y"))
    rows = docs.filter(F.col(id_col).isNotNull() & ~out).select(F.col(id_col).alias("__doc")).distinct().join(known, F.col("__doc") == F.col("__id")).select("__id", "__y")
    rows = rows.withColumn("__hash", F.xxhash64("__id"))
    chosen = None
    for label, most in ROWS.items():
        some = rows.filter(F.col("__y") == label).orderBy("__hash", "__id").limit(most)
        chosen = some if chosen is None else chosen.unionAll(some)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    picked = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__id")).select("__hash", "__id", "__y", text.alias("t"))
    sizes = picked.groupBy("__hash", "__id", "__y").agg(F.sum(F.octet_length("t") + ROW_BYTES).alias("n"))
    left, ids = dict(BYTES), []
    for _, i, y, n in sorted(tuple(r) for r in sizes.collect()):
        if n <= left[y]:
            left[y] -= n
            ids.append((i,))
    fit = docs.sparkSession.createDataFrame(ids, picked.select("__id").schema).toDF("__fit")
    got = picked.join(F.broadcast(fit), F.col("__id") == F.col("__fit"), "left_semi").collect()
    got = sorted((h, y, bytes(t)) for h, _, y, t in got)
    return train([t for _, _, t in got], np.array([y for _, y, _ in got], int))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", parts: int = 3, part: int = 1,
          threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per input row.

    Learns from labels 0 and 1 of rows that are not held out (crc32 of the id as text modulo ``parts`` is ``part``),
    from at most ``ROWS`` and ``BYTES`` of each label, chosen by a hash of the id; where labels of an id differ, the larger counts.
    Whole texts are scored. Null and empty texts, and texts without letters, get the low score of a text without
    words. Without labels of both kinds all scores are the share of label 1. Rows without id are neither held out nor
    learned from. Rows that repeat an id are scored one by one. An empty table gives an empty result. Other columns
    are not read.
    """
    out = held_out(id_col, parts, part)
    net = learn(docs, labels, id_col, text_col, label_col, out)

    def work(batches: Iterator[pa.RecordBatch]):
        scorer = Scorer(net)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            groups = np.cumsum(sizes_of(texts)) // (2 << 20)
            values = np.zeros(batch.num_rows)
            for g in np.unique(groups).tolist():
                lo, hi = np.searchsorted(groups, [g, g + 1])
                values[lo:hi] = scorer(texts[lo:hi].to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(values), pa.array((values >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")
