"""Multiset fingerprints, spelling variants and periodic runs next to plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import multiset_hash as prints
from tallyloom.llm import periodic_runs as runs
from tallyloom.llm import queries, variants

from . import plain
from .test_operators import SCHEMA, SF, awkward, got

ROWS = awkward() + [(70, "abab cdcd " * 40), (80, " ".join(["one", "two", "three"] * 30) + " tail"), (91, "\n".join(["same line"] * 30)),
                    (60, " ".join(["hello", "hallo", "hllo", "helloo", "HELLO"] * 4)), (61, "x" * 300_000), (62, "x" * 299_999 + " ")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None, k, "k", "k", "p", "t") for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- fingerprints ---------------------------------------------------------------------------------------------------


def edited_rows(rows):
    rows = plain.in_order(rows)
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        t, u = t or "", u or ""
        q = len(t) // 4
        out.append((i, len(t), t, t[: len(t) - q] + u[:q], u))
    return out


def test_fingerprints(docs, small, none):
    for df in (docs, small):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        want = []
        for i, n, text, changed, next_ in edited_rows(rows):
            a, b, c = (prints.fingerprint(t.encode()) for t in (text, changed, next_))
            want.append((i, n, plain.sha(changed.encode()), prints.shown(a), prints.shown(b), float(prints.likeness(a, b)), float(prints.likeness(a, c))))
        assert got(prints.fingerprints(df)) == sorted(want, key=repr)
    assert prints.fingerprints(none).collect() == []


def test_fingerprints_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(prints, "parts_for", lambda total: 40)
    rows = [(i * i, f"text {i}\nof some lines\n{i * 7919}") for i in range(-30, 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").dropDuplicates(["doc_id"]).repartition(7)
    rows = [tuple(r) for r in df.collect()]
    out = {r.doc_id: r for r in prints.fingerprints(df).collect()}
    assert len(out) == len(rows)
    for i, n, _, changed, _ in edited_rows(rows):
        assert (out[i].n_chars, out[i].edited_sha256) == (n, plain.sha(changed.encode()))


def test_a_single_document_follows_itself(spark):
    (row,) = prints.fingerprints(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).collect()
    assert row.edited_sha256 == plain.sha(b"abcdefab") and row.near_next == 1.0


def test_fingerprints_are_homomorphic():
    draw = random.Random(1)
    lines = ["".join(draw.choice("abc de") for _ in range(draw.choice([0, 2, 5, 23, 24, 90]))).encode() for _ in range(40)]
    whole = prints.fingerprint(b"\n".join(lines))
    shuffled = draw.sample(lines, len(lines))
    assert prints.equal(whole, prints.fingerprint(b"\n".join(shuffled)))
    parts = prints.plus(prints.fingerprint(b"\n".join(lines[:13])), prints.fingerprint(b"\n".join(lines[13:])))
    assert prints.equal(whole, parts)
    assert prints.equal(prints.minus(whole, prints.fingerprint(lines[7])), prints.fingerprint(b"\n".join(lines[:7] + lines[8:])))
    assert not prints.equal(prints.fingerprint(b""), prints.fingerprint(b"\n"))
    assert prints.equal(prints.read(prints.shown(whole)), whole)


def test_grams_next_to_single_ones(monkeypatch):
    def slow(text):
        out = np.zeros(prints.LANES, np.int64)
        for p in text.split(b"\n"):
            width = 4 if len(p) < 24 else 8
            for g in [p[i : i + width] for i in range(len(p) - width + 1)] if len(p) >= 4 else [p]:
                bucket = int(prints._buckets(np.array([int.from_bytes(g, "little") + ((len(g) + 1) << 40 if width == 4 else 0)], np.uint64))[0])
                out[bucket >> 1] += -1 if bucket & 1 else 1
        return out

    texts = [b"", b"\n", b"abc", b"ab\n\ncd", b"x" * 23, b"y" * 24 + b"\n" + b"z" * 100, b"a\n" * 50]
    want = np.array([slow(t) for t in texts])
    for size in (1 << 15, 37):
        monkeypatch.setattr(prints, "BYTES_AT_ONCE", size)
        assert (prints.grams(texts) == want).all()
        assert all((prints.grams([t])[0] == w).all() for t, w in zip(texts, want))


def test_likeness_tells_edited_texts_from_other_ones(spark):
    rows = prints.fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    large = [r for r in rows if r.n_chars > 400]
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.97
    assert 0.65 < np.median([r.near_edited for r in large]) < 0.85
    assert np.quantile([r.near_next for r in large], 0.9) < 0.2


# --- spelling variants ----------------------------------------------------------------------------------------------


def near_pairs(words):
    known, same, out = set(words), defaultdict(set), set()
    for w in words:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            same[i, rest].add(w)
            if rest in known:
                out |= {(w, rest), (rest, w)}
    for group in same.values():
        out |= {(a, b) for a in group for b in group if a != b}
    return out


def plain_variants(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    near = defaultdict(list)
    for a, b in near_pairs(n):
        near[a].append(b)
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-n[v], v))
        if n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def test_variants(docs, small, none):
    for df in (docs, small):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        assert got(variants.grouped(df)) == plain_variants(rows)
    assert variants.grouped(none).collect() == []


def test_variants_over_many_subtrees(spark, monkeypatch):
    # Small subtrees, a small sample (so that counts occur that it lacks) and words that share one vector of counts.
    draw = random.Random(4)
    words = {"".join(draw.choice("abcdeéz") for _ in range(draw.randint(5, 8))) for _ in range(900)}
    words |= {"".join(draw.sample("abcde", 5)) for _ in range(100)} | {"a" * 600, "a" * 601, "a" * 300 + "b" + "a" * 299, "b" * 33, "b" * 32, "c" * 31 + "bb"}
    count = {w: draw.randint(3, 30) for w in words}
    df = spark.createDataFrame(list(count.items()), "word string, n long").repartition(3)
    pairs = defaultdict(list)
    for a, b in near_pairs(words):
        pairs[a].append(b)
    want = sorted((w, len(some), *max((count[v], [-ord(c) for c in v], v) for v in some)[::2]) for w, some in pairs.items())
    want = sorted((w, n, count[b], b) for w, n, b in ((w, len(some), min(some, key=lambda v: (-count[v], v))) for w, some in pairs.items()))
    for subtree, leaf, sample in ((1 << 15, 32, 1 << 16), (20, 1, 1 << 16), (20, 2, 150)):
        for name, value in (("SUBTREE", subtree), ("LEAF", leaf), ("SAMPLE", sample)):
            monkeypatch.setattr(variants, name, value)
        assert sorted(tuple(r) for r in variants.near_words(df).collect()) == want


def test_roots_follow_long_chains(spark):
    links = [(f"w{i:02}", f"w{i + 1:02}") for i in range(21)] + [("x", "w05"), ("y", "z")]
    out = {r.word: r.root for r in variants.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert out == {w: "z" if w == "y" else "w21" for w, _ in links}


# --- periodic runs --------------------------------------------------------------------------------------------------


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_periodic(rows):
    out = []
    for i, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        found = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {k for s, length, q in found for k in range(s + q, s + length)}
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        out.append((i, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
                    plain.sha(b" ".join(w for k, w in enumerate(words) if k not in gone))))
    return sorted(out, key=repr)


def test_periodic_runs(spark, small, none, docs):
    short = docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 20_000)
    for df in (short, small):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        assert got(queries.op13_periodic_runs(lambda _: df)) == plain_periodic(rows)  # noqa: B023
    assert runs.periodic_runs(none).collect() == []
    assert runs.periodic_runs(docs).count() == docs.count()


def test_runs_of_random_sequences(monkeypatch):
    monkeypatch.setattr(runs, "TOPS_AT_ONCE", 50)
    places, draw = runs.Grid(64), random.Random(1)
    for _ in range(400):
        kinds, n = draw.choice([1, 2, 2, 3, 5, 50]), draw.choice([0, 1, 5, 24, 30, 60, 100, 300])
        words = [draw.randrange(kinds) for _ in range(n)]
        for _ in range(draw.randrange(3)):
            if n > 30:
                a = draw.randrange(n)
                q = 1 + draw.randrange(1 + (n - a) // 3)
                for x in range(a, min(n, a + q * draw.randrange(1, 9))):
                    words[x] = words[a + (x - a) % q]
        found = [tuple(r) for r in runs.runs_in(np.array(words, np.int64), places).tolist()]
        assert sorted(found) == plain_runs(words)


def test_extensions_next_to_plain_ones():
    draw = np.random.default_rng(2)
    for n, kinds in ((200, 2), (500, 1), (400, 3), (31, 1), (5, 1)):
        codes = draw.integers(0, kinds, n)
        common = runs.CommonExtensions(codes)
        i, j = np.triu_indices(n + 1, 1)
        want = np.zeros((n + 2, n + 2), np.int64)
        for a in range(n - 1, -1, -1):
            want[a, :n] = np.where(codes[a] == codes, want[a + 1, 1 : n + 1] + 1, 0)
        assert (common(i, j) == want[i, j]).all()


def test_long_repetitions():
    places = runs.Grid()
    assert runs.runs_in(np.zeros(100_000, np.int64), places).tolist() == [[0, 100_000, 1]]
    assert runs.runs_in(np.arange(300_000) % 70_001, places).tolist() == [[0, 300_000, 70_001]]


def test_cover_moves_every_pair_to_samples():
    for a in range(runs.PERIOD):
        for b in range(runs.PERIOD):
            t = runs._SHIFT[a, b]
            assert (a + t) % runs.PERIOD in runs.COVER and (b + t) % runs.PERIOD in runs.COVER
