"""Cases that once went wrong: long blanks, repeated rows, one reading task, texts of no learned language."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import language, mixing, packing, suffix_dedup, topk, toxicity, warc
import corpus_pipeline as pipeline

from . import plain
from .test_operators import VOCABULARY, got

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("text", [" " * 2_000_000 + "x", "\n" * 1_000_000, "x" * 2_000_000, "a  b" + "\t" * 5000 + " <|endoftext|> c", " " * 4096], ids=range(5))
def test_packing_of_long_blanks_and_words(text):
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids
    (ids,) = packing.Encoder(VOCABULARY, added=True)([text])
    assert np.frombuffer(ids, "<u4").tolist() == want


def test_top_k_of_repeated_rows(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(draw.standard_normal(4), 1)]) for i in range(0, 500)]
    once = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1).withColumn("score", F.lit("clash"))
    df = once.unionAll(once)
    out = topk.top_k(df, df.filter("vec_id % 100 = 0"), k=10)
    scaled = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows] * 2
    want = []
    for q, x in scaled:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in scaled if i != q)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])]
    assert got(out) == sorted(want, key=repr)


def test_bundles_are_read_by_as_many_tasks_as_payloads_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "parts_for", lambda total: 3 if total and total > 0 else 1)
    rows = [(i, f"http://a/{i}", "<p>" + "payload " * 20 + ("" if i % 3 else str(i))) for i in range(90)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(9)
    folder = f"file://{tmp_path}/bundles"
    read = warc.read_bundles(warc.write_bundles(df, folder), folder)
    assert "REPARTITION_BY_NUM" in read._jdf.queryExecution().toString()
    first = {}
    for i, _, html in sorted(rows):
        first.setdefault(html, i)
    assert {(r.page_id, r.refers_to) for r in read.collect()} == {(i, first[h] if first[h] != i else None) for i, _, h in rows}


def test_borders_of_a_hot_token_leave_packed(spark, monkeypatch):
    # A passage with other surroundings everywhere fills many ranges; what leaves them is a record or two each.
    monkeypatch.setattr(suffix_dedup, "RUNS_PER_RANGE", 20)
    seen = []
    through = suffix_dedup.across_borders
    monkeypatch.setattr(suffix_dedup, "across_borders", lambda edge, parts: seen.append(edge) or through(edge, parts))
    passage = "a common passage that very many documents hold, in surroundings of their own, and more of it to the end " * 2
    rows = [(i, f"{i * 7919} some text {passage}{i * 104729} other text") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = suffix_dedup.dedup_bytes(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert got(out) == sorted(plain.byte_strings(rows, 100), key=repr)
    ranges = seen[0].select("range").distinct().count()
    assert ranges > 5 and seen[0].count() <= 2 * ranges


def test_mixing_with_other_schedules_and_carried_texts(spark):
    rows = [(i // 2, f"{i % 7} " * (i % 11), None, "abc"[i % 3], i) for i in range(300)] + [(None, None, None, None, 0), (5, "x y", None, "a", 1)]
    df = spark.createDataFrame(rows, DOCS)
    flat = mixing.mixed_documents(df, slopes=(0.0, 0.0, 0.0), carry=("text", "lang"))
    assert Counter((r.doc_id, r.c0) for r in flat.collect()) == Counter((r[0], r[1]) for r in rows)
    bent = mixing.mixed_documents(df, slopes=(1.0, 0.0, -1.0))
    total = lambda mix: {r.source: r.t for r in mix.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert total(flat) == total(bent)
    early = lambda mix, s: mix.filter((F.col("source") == s) & (F.col("taken") > 0)).agg(F.avg("position")).first()[0]
    assert early(bent, "c") < early(flat, "c") and early(bent, "a") > early(flat, "a")


def test_language_stage_keeps_learned_languages_and_drops_others(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*pipeline.COLUMNS)
    by = {}
    for r in given.filter("lang is not null and n_chars > 600").limit(400).collect():
        by.setdefault(r.lang, []).append(r.text)
    languages = sorted(by)
    mixed = [by[a][0][:400] + "\n" + by[b][0][:400] for a in languages for b in languages if a < b]
    draw = random.Random(5)
    noise = lambda letters: " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 9))) for _ in range(90))
    other = [noise("абвгдежзиклмнопрст"), noise("bcdfghjklmnpqrstvwxz"), noise("αβγδεζηθικλμν"),
             "wszystkie dzieci rodzą się wolne i równe pod względem swej godności i swych praw są obdarzone rozumem i sumieniem " * 3,
             "".join(draw.choice("!@#$%^&*()_+-=[]{}<>?/|0123456789 ") for _ in range(400)) + "a", "12 34 !!", "", None]
    extra = [(10**6 + i, t, None, "s", 0) for i, t in enumerate(mixed)] + [(2 * 10**6 + i, t, None, "s", 0) for i, t in enumerate(other)]
    docs = given.unionByName(spark.createDataFrame(extra, DOCS)).withColumn("score", F.lit("clash"))
    kept = {r.doc_id for r in pipeline.identify_language(spark, docs, None).select("doc_id").collect()}
    assert kept == {r.doc_id for r in given.collect()} | {10**6 + i for i in range(len(mixed))}


def test_stages_on_awkward_rows(spark):
    line = "the same words stand in this line and in that line as well, so that it is long enough to be cut out of others "
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, line * 3, "en", "a", 1), (3, line * 3, "en", "a", 1), (None, "x " + line * 2, None, None, 2),
            (4, "word " * 3000, "fr", "b", 3), (5, " \n ", "fr", "b", 3)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("key", F.lit(1)).withColumn("kind", F.lit("x")).withColumn("component_id", F.lit(7))
    for df in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES:
            out = stage(spark, df, None)
            n = out.count()
            if name != "packing":
                assert out.columns == list(pipeline.COLUMNS)
            assert n == 0 if df is not docs else n > 0 or name in ("language",)


def test_toxicity_learns_from_bounded_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: seen.append((texts, labels)) or toxicity.Network())
    monkeypatch.setattr(toxicity, "BYTES", {1: 5_000, 0: 8_000})
    rows = [(i, "word " * (20_000 if i % 40 == 0 else i % 50)) for i in range(400)] + [(7, "again " * 3), (None, "x"), (9, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit("clash")).withColumn("t", F.lit(1))
    out = toxicity.score(docs, labels)
    assert out.count() == len(rows)
    (texts, learned), = seen
    for label, most in toxicity.BYTES.items():
        size = sum(len(t) + toxicity.ROW_BYTES for t, y in zip(texts, learned) if y == label)
        assert most / 2 < size <= most
    toxicity.score(docs.repartition(7), labels)
    assert seen[1][0] == texts


def test_runs_with_equal_ends_but_other_middles_are_not_equal(spark):
    # Equal tokens, equal lengths; copies decide by their bytes, not by a hash of the run.
    head, tail = "the head of the passage that all of them share, word for word, up to here and then ", " from here on the passage goes on as in the others, word for word, to its very end"
    rows = [(i, f"{head}{'abc'[i % 3] * (1 + i % 2)}{tail} {head}") for i in range(24)]
    for length in (100, 40, 33, 160):
        out = suffix_dedup.dedup_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), length=length)
        assert got(out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))) == sorted(plain.byte_strings(rows, length), key=repr)


def test_matrices_are_inverted_in_place():
    draw = np.random.default_rng(4)
    for n in (1, 7, 300, 700):
        f = draw.standard_normal((n, 40)).astype(np.float32)
        kernel = language.centred_products(f, f.mean(axis=0), 0.01)
        x = (f - f.mean(axis=0)).astype(np.float64)
        plain_kernel = x @ x.T + 0.01 * np.eye(n)
        assert np.allclose(kernel, plain_kernel, atol=1e-3)
        assert np.allclose(language.inverted(plain_kernel.copy()) @ plain_kernel, np.eye(n), atol=1e-6)
