"""Language identification with error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit, over hashed byte n-grams, predicts the bit of a
text; decoding picks the language whose codeword has the least loss, each bit weighted by how well its classifier did
on rows left out. A small lead over the second language flags the text as ambiguous.

Codes always name a learned language. Whether the text is written in any of them at all is told apart: ``unfamiliar``
marks a text whose n-grams are far less likely than those of the learning rows, whatever language they are of, so a text
of several learned languages is familiar. Texts of symbols with hardly a letter are unfamiliar too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Learning rows: at most this many of a language, and this many in all.
ROWS_PER_LANGUAGE, ROWS = 600, 6000
#: Rows ranked for one that is taken.
SPARE = 4
#: Languages up to which the table of their row counts is broadcast; beyond it is joined.
KINDS_SENT = 100_000
BUCKETS = 2048
LETTERS_AT_ONCE = 1 << 18
UNKNOWN = "und"
#: A text is unfamiliar if its n-grams are, in the mean of the logarithm, this much less likely than those of all but one in
#: a thousand learning rows; short texts get more room, the second figure by the root of their letters.
STRANGE, STRANGE_SHORT = 1.0, 8.0
#: Least share of letters in the bytes that are no blanks.
LETTERS_SHARE = 0.05

# Letters A-Z in lower case, other ASCII characters as blanks; bytes of other characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def ngrams(text: bytes) -> np.ndarray:
    """Root of the relative frequency of hashed 2-grams and 3-grams of the folded bytes, as float32."""
    text = b" " + b" ".join(text.translate(FOLD).split()) + b" "
    counts = np.zeros(2 * BUCKETS, np.int64)
    for at in range(0, len(text), LETTERS_AT_ONCE):
        b = np.frombuffer(text, np.uint8)[at : at + LETTERS_AT_ONCE + 2].astype(np.uint32)
        two = (b[:-1] << np.uint32(8)) | b[1:]
        three = (two[:-1] << np.uint32(8)) | b[2:]
        for k, codes in enumerate((two, three)):
            hashed = (codes * np.uint32(2654435761)) >> np.uint32(21)
            counts[k * BUCKETS : (k + 1) * BUCKETS] += np.bincount(hashed, minlength=BUCKETS)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def codebook(n: int) -> np.ndarray:
    """Codewords (n x bits, entries +1 and -1): all distinct splits for few languages, else the best of random draws."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        bits = 2 ** (n - 1) - 1
        return np.array([[1.0 if row == 0 or (column >> (n - 1 - row)) & 1 else -1.0 for column in range(bits)] for row in range(n)])
    bits = 4 * int(np.ceil(np.log2(n))) + 7
    best, best_distance = None, -1
    draw = np.random.default_rng(7)
    for _ in range(200):
        book = np.where(draw.random((n, bits)) < 0.5, 1.0, -1.0)
        distance = int(((bits - book @ book.T) / 2 + bits * np.eye(n)).min())
        mixed = (np.abs(book.sum(axis=0)) < n).all()
        if mixed and distance > best_distance:
            best, best_distance = book, distance
    return best if best is not None else np.where(draw.random((n, bits)) < 0.5, 1.0, -1.0)


@dataclass
class Model:
    languages: list[str]
    book: np.ndarray
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    bit_weight: np.ndarray
    lead: float
    surprise: np.ndarray  # of every feature: minus the logarithm of its mean share over the languages
    familiar: float

    def unfamiliar(self, features: np.ndarray, letters: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Whether rows are of no learned language; with their numbers of letter bytes and of other bytes but blanks."""
        allowed = self.familiar + STRANGE + STRANGE_SHORT / np.sqrt(np.maximum(letters, 1))
        return (np.square(features) @ self.surprise > allowed) | (letters < LETTERS_SHARE * (letters + others))

    def predict(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score in [0, 1] and ambiguity of every row."""
        margins = features @ self.weights + self.bias
        loss = np.stack([(np.maximum(0.0, 1.0 - margins * code) * self.bit_weight).sum(axis=1) for code in self.book], axis=1)
        power = np.exp(-4.0 * (loss - loss.min(axis=1, keepdims=True)))
        best = loss.argmin(axis=1)
        score = 1.0 / power.sum(axis=1)
        if loss.shape[1] == 1:
            return best, np.ones(len(best)), np.zeros(len(best), bool)
        ordered = np.sort(loss, axis=1)
        return best, score, ordered[:, 1] - ordered[:, 0] < self.lead


def fit(features: np.ndarray, languages: list[str], ridge: float = 0.01, lead: float = 0.1) -> Model:
    """Least-squares classifiers of all bits at once; left-out margins come in closed form.

    Solved by rows or by features, whichever are fewer, so no matrix has more than ``2 * BUCKETS`` rows and columns.
    """
    names = sorted(set(languages))
    book = codebook(len(names))
    place = {name: i for i, name in enumerate(names)}
    y = book[[place[x] for x in languages]]
    middle, centre = features.mean(axis=0), y.mean(axis=0)
    if len(features) > features.shape[1]:
        weights, left_out = by_features(features, middle, y, y - centre, ridge)
    else:
        inverse = inverted(centred_products(features, middle, ridge))
        dual = inverse @ (y - centre)
        weights = -np.outer(middle, dual.sum(axis=0))
        for at in range(0, len(features), 512):
            weights += features[at : at + 512].T.astype(np.float64) @ dual[at : at + 512]
        left_out = y - dual / np.diag(inverse)[:, None]
    right = (np.sign(left_out) == y).mean(axis=0)
    bit_weight = np.maximum(2 * right - 1, 1e-3)
    share = np.zeros(features.shape[1])
    for name in names:
        own = np.flatnonzero(np.array(languages) == name)
        share += np.einsum("ij,ij->j", features[own], features[own]) / len(own) / len(names)
    surprise = -np.log(share + 1e-6)
    familiar = float(np.quantile(np.concatenate([np.square(features[at : at + 512]) @ surprise for at in range(0, len(features), 512)]), 0.999))
    return Model(names, book, weights.astype(np.float32), (centre - middle @ weights).astype(np.float32), bit_weight / bit_weight.sum(), lead,
                 surprise.astype(np.float32), familiar)


def centred_products(features: np.ndarray, middle: np.ndarray, ridge: float, step: int = 512) -> np.ndarray:
    """Inner products of the centred rows, with the ridge on the diagonal, without a centred copy of the rows."""
    kernel = np.empty((len(features), len(features)))
    pieces = [slice(at, at + step) for at in range(0, len(features), step)]
    for i, p in enumerate(pieces):
        x = (features[p] - middle).astype(np.float64)
        for q in pieces[: i + 1]:
            kernel[p, q] = x @ (features[q] - middle).astype(np.float64).T
            kernel[q, p] = kernel[p, q].T
    kernel[np.diag_indices(len(kernel))] += ridge
    return kernel


def inverted(a: np.ndarray, step: int = 256) -> np.ndarray:
    """Inverse of a symmetric positive definite matrix in its own memory, some rows and columns at a time."""
    for at in range(0, len(a), step):
        own = slice(at, min(at + step, len(a)))
        pivot = np.linalg.inv(a[own, own])
        across, down = pivot @ a[own], a[:, own].copy()
        across[:, own] = pivot
        down[own] = 0
        a[:, own] = 0
        for row in range(0, len(a), step):
            a[row : row + step] -= down[row : row + step] @ across
        a[own] = across
    return a


def by_features(features: np.ndarray, middle: np.ndarray, y: np.ndarray, centred: np.ndarray, ridge: float, step: int = 512):
    """Weights and left-out margins from the normal equations, some rows at a time."""
    d = features.shape[1]
    gram, moment = np.zeros((d, d)), np.zeros((d, y.shape[1]))
    pieces = [slice(at, at + step) for at in range(0, len(features), step)]
    for p in pieces:
        x = (features[p] - middle).astype(np.float64)
        for at in range(0, d, step):
            gram[at : at + step] += x[:, at : at + step].T @ x
        moment += x.T @ centred[p]
    gram[np.diag_indices(d)] += ridge
    inverse = inverted(gram)
    weights = inverse @ moment
    left_out = np.empty_like(y)
    for p in pieces:
        x = (features[p] - middle).astype(np.float64)
        own = np.einsum("ij,ij->i", x @ inverse, x)
        left_out[p] = y[p] - (centred[p] - x @ weights) / (1 - own)[:, None]
    return weights, left_out


def held_out(id_col: str, parts: int, part: int):
    """Whether crc32 of the id as text falls on the remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def learning_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, out) -> DataFrame:
    """text and lang of a bounded sample in hash order, as many of each language.

    Rows of a language are counted first; only those whose hash lies in the lowest part of the range, which holds some
    ``SPARE`` times the rows wanted, are ranked, so no task ranks more than that however many rows a language has.
    The chosen ids are broadcast: there are ``ROWS`` of them at most, or one per language where there are more.
    """
    known = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~out)
    counts = known.groupBy(F.col(lang_col).alias("__of")).agg(F.count("*").alias("__rows"))
    kinds = counts.count()
    counts = F.broadcast(counts) if kinds <= KINDS_SENT else counts
    most = max(1, min(ROWS_PER_LANGUAGE, ROWS // max(1, kinds)))
    narrow = known.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"), F.xxhash64(id_col).alias("__hash"))
    border = F.lit(-(2.0**63)) + F.lit(2.0**64 * SPARE * (most + 8)) / F.col("__rows")
    low = narrow.join(counts, F.col("__lang") == F.col("__of")).filter(F.col("__hash").cast("double") <= border)
    nth = Window.partitionBy("__lang").orderBy("__hash", "__id")
    chosen = low.withColumn("__n", F.row_number().over(nth)).filter(F.col("__n") <= most).select("__id").distinct()
    picked = known.join(F.broadcast(chosen), F.col(id_col) == F.col("__id"), "left_semi")
    return picked.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).limit(2 * ROWS)


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, out) -> Model | None:
    """Features are made on the executors; the driver gets the non-zero ones of at most ``2 * ROWS`` rows."""

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
                f = ngrams(text)
                at = np.flatnonzero(f)
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([at.astype(np.uint16).tobytes()]), pa.array([f[at].tobytes()])], names=["lang", "at", "value"])

    rows = learning_rows(docs, id_col, text_col, lang_col, out).mapInArrow(work, "lang string, at binary, value binary").collect()
    rows = sorted(rows, key=lambda r: (r[0], bytes(r[1]), bytes(r[2])))
    if not rows:
        return None
    features = np.zeros((len(rows), 2 * BUCKETS), np.float32)
    for i, r in enumerate(rows):
        features[i, np.frombuffer(r[1], np.uint16)] = np.frombuffer(r[2], np.float32)
    languages = [r[0] for r in rows]
    del rows
    return fit(features, languages)


def letters_of(text: bytes) -> tuple[int, int]:
    """Bytes of letters, and other bytes that are no blanks."""
    blanks = len(text) - len(b"".join(text.split()))
    letters = len(text) - text.translate(FOLD).count(b" ")
    return letters, len(text) - blanks - letters


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text[:200])) or any(map(str.isalpha, text))


PREDICTED_SQL = "lang_pred string, score double, ambiguous boolean, unfamiliar boolean"


def predicted(docs: DataFrame, model: Model | None, text_col: str, keep: list[str]) -> DataFrame:
    """The kept columns of ``docs`` with lang_pred, score, ambiguous and unfamiliar from the text alone."""
    given = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text_col).cast("string").alias("__text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[:-1])

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                texts = some.column(len(keep))
                known = np.array([t is not None and has_letter(t) for t in texts.to_pylist()], bool)
                lang, score, unclear, strange = [UNKNOWN] * len(known), np.zeros(len(known)), np.ones(len(known), bool), np.ones(len(known), bool)
                if model is not None and known.any():
                    own = [t for t, k in zip(texts.cast(pa.binary()).to_pylist(), known) if k]
                    features = np.stack([ngrams(t) for t in own])
                    best, sure, close = model.predict(features)
                    strange[known] = model.unfamiliar(features, *np.array([letters_of(t) for t in own]).T)
                    for i, b in zip(np.flatnonzero(known).tolist(), best.tolist()):
                        lang[i] = model.languages[b]
                    score[known], unclear[known] = sure, close
                yield pa.RecordBatch.from_arrays([*(some.column(i) for i in range(len(keep))), pa.array(lang), pa.array(score), pa.array(unclear), pa.array(strange)],
                                                 names=[*(f"k{i}" for i in range(len(keep))), "lang_pred", "score", "ambiguous", "unfamiliar"])

    return given.mapInArrow(work, (kinds + ", " if kinds else "") + PREDICTED_SQL).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score", "ambiguous", "unfamiliar")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 4, part: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous, unfamiliar: a row per input row.

    Learns from text and non-null language of rows that are not held out (crc32 of the id as text modulo ``parts`` is
    ``part``), from at most ``ROWS`` rows, ``ROWS_PER_LANGUAGE`` of a language, chosen by a hash of the id. Whole
    texts are scored. A text that is null or has no letter gets ``und`` with score 0, and so does every text where
    nothing could be learned. Rows without id are neither held out nor learned from. Rows that repeat an id are
    predicted one by one. An empty table gives an empty result. Other columns are not read.
    """
    out = held_out(id_col, parts, part)
    model = learn(docs, id_col, text_col, lang_col, out)
    marked = docs.select(F.col(id_col).cast("long").alias("doc_id"), out.alias("held_out"), F.col(text_col).alias("text"))
    return predicted(marked, model, "text", ["doc_id", "held_out"])
