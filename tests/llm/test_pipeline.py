"""Every stage of the pipeline against a plain version, on its own input."""

import numpy as np
import pytest

import corpus_pipeline as pipeline
from tallyloom.llm.packing import Encoder
from tallyloom.llm.queries import QUERIES

from . import plain

SF = "/root/testdata/sf0.001"
NAMES = [name for name, _ in pipeline.STAGES]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Input and output of every stage."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        out[name] = (docs, spark.read.parquet(f"{folder}/{name}"))
        docs = out[name][1]
    return out


def test_columns(tables):
    for name in NAMES[:-1]:
        assert tables[name][1].columns == list(pipeline.COLUMNS)


def test_language_keeps_clean_documents(tables):
    before, after = tables["language"]
    assert after.count() == before.count()


def test_near_duplicates(tables):
    before, after = tables["near duplicates"]
    prints = {r.doc_id: plain.fingerprint(r.text) for r in before.collect()}
    root = plain.components(set(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert {r.doc_id for r in after.collect()} == {i for i, r in root.items() if i == r}


def test_repeated_passages(tables):
    before, after = tables["repeated passages"]
    seen, want = set(), {}
    for r in sorted(before.collect()):
        data = r.text.encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            gone[p : p + 100] |= data[p : p + 100] in seen
            seen.add(data[p : p + 100])
        want[r.doc_id] = np.frombuffer(data, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
    assert {r.doc_id: (r.text, r.n_chars) for r in after.collect()} == {i: (t, len(t)) for i, t in want.items()}


def test_mix(tables):
    before, after = tables["mixing"]
    mix = {r.doc_id: r for r in pipeline.mixing.mixed_documents(before).collect()}
    words, whole = {}, {r.doc_id: r.text.encode().split() for r in before.collect()}
    for r in after.collect():
        own = r.text.encode().split()
        assert own == whole[r.doc_id][: len(own)]
        words[r.doc_id] = words.get(r.doc_id, 0) + len(own)
    assert words == {i: r.taken for i, r in mix.items() if r.taken}


def test_packing(tables):
    before, after = tables["packing"]
    encode = Encoder(pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(encode([r.text])[0]) // 4 + 1 for r in before.collect())
    rows = after.collect()
    assert sum(r.length for r in rows) == tokens
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[0][0] == 0 and sum(own[-1]) <= 1024
    assert len(by) <= 1.01 * -(-tokens // 1024) + 1


def test_run_and_queries(spark, tables):
    assert pipeline.run(spark, SF).count() == tables["packing"][1].count()
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
