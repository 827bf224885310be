"""Corpus operators next to plain versions, on the smallest tables and on awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import common, components, embed_grid, language, mixing, multikey, packing, simhash, substring_cover, suffix_dedup, topk, toxicity, warc

from . import plain

SF = "/root/testdata/sf0.001"
VOCABULARY = __import__("public_tokenizers").path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `key` string, kind string, part string, __text string"


def awkward():
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 5)))
    passage = " ".join(word() for _ in range(60))
    long = " ".join(word() for _ in range(30_000))
    texts = [None, "", " \n\t", "one two", passage, passage, "x " + passage, passage[3:] + " tail", long, long + " more", "a" * 2000, "ab" * 1500,
             "  " + passage.upper(), "no\x1cbreak " + passage, "12 34 !!", "é" * 300, " ".join(["same"] * 400)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(4, passage), (4, "other text of document four " + passage), (None, passage), (None, None), (90, passage), (90, passage)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "en", "de"][k % 3], [None, "s1", "s2"][k % 3], k, "k", "k", "p", "t") for k, (i, t) in enumerate(awkward())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_word_windows(docs, small, none):
    for df in (docs, small):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        out = substring_cover.dedup_word_windows(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
        assert got(out) == sorted(plain.word_windows(rows, 20), key=repr)
    assert substring_cover.dedup_word_windows(none).collect() == []


def test_cover_moves_every_pair_onto_cover_positions():
    period, cover = substring_cover.PERIOD, set(substring_cover.COVER)
    for i in range(period):
        for j in range(period):
            assert any((i + s) % period in cover and (j + s) % period in cover for s in range(period))


def test_byte_strings(docs, small, none, monkeypatch):
    for df in (docs, small):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        out = suffix_dedup.dedup_bytes(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
        assert got(out) == sorted(plain.byte_strings(rows, 100), key=repr)
    assert suffix_dedup.dedup_bytes(none).collect() == []


def test_byte_strings_over_many_ranges(small, spark, monkeypatch):
    # Few runs per range: leading tokens go over the borders of ranges.
    monkeypatch.setattr(suffix_dedup, "RUNS_PER_RANGE", 4)
    passage = "a common passage that very many documents hold, in surroundings of their own, " * 2
    rows = [(i, f"{i * 7919} {passage}{i * 104729}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = suffix_dedup.dedup_bytes(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert got(out) == sorted(plain.byte_strings(rows, 100), key=repr)


def test_multikey_quicksort():
    draw = np.random.default_rng(2)
    buffer = draw.integers(97, 99, 5000).astype(np.uint8)
    buffer[1000:1300] = buffer[:300]
    starts = draw.permutation(4900)
    order, run = multikey.multikey_quicksort(multikey.words_of(buffer), starts, 100)
    data = buffer.tobytes()
    suffixes = [data[starts[i] : starts[i] + 100] for i in order]
    assert suffixes == sorted(suffixes)
    assert all((suffixes[i] == suffixes[i - 1]) == (run[i] == run[i - 1]) for i in range(1, len(run)))


def test_simhash(docs, small, none):
    for df in (docs, small):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        prints = [plain.fingerprint(t) for _, t in rows]
        root = plain.components(set(prints), lambda a, b: (a ^ b).bit_count() <= 3)
        least = {}
        for (i, _), p in zip(rows, prints):
            if i is not None:
                least[root[p]] = min(i, least.get(root[p], i))
        out = simhash.near_duplicates(df).select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")), "component_id")
        assert got(out) == sorted(((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints)), key=repr)
    assert simhash.near_duplicates(none).collect() == []


def test_simhash_tiles_find_all_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    draw = np.random.default_rng(4)
    values = draw.integers(0, 1 << 62, 300, dtype=np.int64)
    near = values[:100] ^ (np.int64(1) << draw.integers(0, 60, 100)) ^ (np.int64(1) << draw.integers(0, 60, 100))
    every = np.unique(np.concatenate([values, near]))
    links = simhash.near_links(spark.createDataFrame([(int(v),) for v in every], "fingerprint long"), 3)
    found = {r.node: r.root for r in components.connected(links).collect()}
    want = plain.components([int(v) for v in every], lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3)
    assert {v: found.get(v, v) for v in want} == want


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 240)] + [(7, 7), (240, 5), (160, 3)]
    found = {r.node: r.root for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 3 for i in range(100, 161)) and all(found[i] == 5 for i in range(200, 241)) and 7 not in found


def test_near_vectors(spark):
    draw = np.random.default_rng(1)
    base = draw.standard_normal((40, 8))
    rows = []
    for i in range(160):
        v = base[i % 40] + 0.12 * draw.standard_normal(8) * (i % 5)
        rows.append((i, [float(x) for x in v], i % 40 % 3 if i % 17 else None, "extra"))
    rows += [(200, rows[1][1], rows[1][2], None), (201, rows[1][1], rows[1][2], None), (202, None, 1, None), (203, [0.0] * 8, 1, None),
             (204, [float("nan")] * 8, 1, None), (205, [], 1, None), (206, [1.0, None], 1, None), (207, [1.0, 2.0], 1, None), (208, [2.0, 4.0], 1, None)]
    out = embed_grid.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string"))
    good = {i: (lab, np.array(v)) for i, v, lab, _ in rows if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}

    def linked(a, b):
        (la, x), (lb, y) = good[a], good[b]
        return la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93

    root = {i: i for i, *_ in rows} | plain.components(set(good), linked)
    want = [(i, sum(linked(i, j) for j in good if j != i) if i in good else 0, root[i], root[i] == i) for i, *_ in rows]
    assert got(out) == sorted(want, key=repr)
    assert embed_grid.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_top_k(spark):
    draw = np.random.default_rng(6)
    rows = [(i, [float(x) for x in np.round(draw.standard_normal(4), 1)]) for i in range(300)]
    rows += [(300, None), (400, [1.0, float("inf"), 0.0, 0.0]), (500, [1.0, 2.0]), (501, [3.0, 4.0]), (None, [1.0] * 4), (600, [1e300, 0.0, 0.0, 0.0]), (200, rows[200][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = topk.top_k(df, df.filter("vec_id % 100 = 0"), k=10)
    good = [(i, [int(np.floor(1024 * x)) if abs(x) < 1e100 else int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v and np.isfinite(v).all()]
    want = []
    for q, x in good:
        if q % 100 == 0:
            scores = sorted((-max(-topk.LONG, min(topk.LONG, sum(a * b for a, b in zip(x, y)))), i) for i, y in good if i != q and len(x) == len(y))
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])]
    assert got(out) == sorted(want, key=repr)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, empty).collect() == []


def test_warc_round_trip_and_seek(spark, tmp_path):
    page = "<html>" + "p" * 200 + "é</html>"
    rows = [(3, "http://a/1", page, "x"), (1, "http://a/2\r\nX: y", page, "x"), (2, None, "small", "x"), (4, "http://b", "small", "x"), (5, "http://b", None, "x"),
            (6, "http://c", "q" * 600_000, "x"), (None, "http://d", page, "x"), (7, "http://e", "\r\n\r\n" * 40, "x"), (7, "http://e", "\r\n\r\n" * 40, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    folder = f"file://{tmp_path}/bundles"
    manifest = warc.write_bundles(df, folder)
    read = warc.read_bundles(manifest, folder)
    want = []
    for i, url, html, _ in rows:
        data = (html or "").encode()
        first = min((j for j, _, h, _ in rows if h == html and j is not None), default=None) if len(data) >= 100 else None
        revisit = first is not None and first != i
        want.append((i, len(data), plain.sha(data), "revisit" if revisit else "response", first if revisit else None))
    assert got(read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == sorted(want, key=repr)
    assert {r.payload.decode() for r in read.filter("record_type = 'response'").collect()} == {h or "" for _, _, h, _ in rows}
    one = manifest.filter("page_id = 6").first()
    reader = warc.Reader(folder, one.bundle)
    assert warc.parsed(reader.frame(one.frame)[one.place : one.place + one.size])["payload"] == b"q" * 600_000
    empty = df.filter("page_id < 0")
    assert warc.round_trip(empty).collect() == []


def test_mixing(docs, none):
    rows = mixing.mixed_documents(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r.size and 0 <= r.position <= 1
    for own in by.values():
        assert sum(r["size"] for r in own) == own[0].source_size and abs(sum(r.taken for r in own) - own[0].target) <= 0.5
    assert abs(sum(own[0].target for own in by.values()) - 1.5 * sum(r["size"] for r in rows)) < 1e-6
    assert got(mixing.mixed_documents(docs)) == got(mixing.mixed_documents(docs.repartition(7)))
    assert mixing.mixed_documents(none).collect() == []
    ordered = [r.position for r in mixing.in_training_order(mixing.mixed_documents(docs), 2).collect()]
    assert ordered == sorted(ordered)


def due(share, slope):
    """Time at which a source has given out the share, by halving."""
    lo, hi = 0.0, 1.0
    for _ in range(60):
        t = (lo + hi) / 2
        lo, hi = (t, hi) if (1 - slope) * t + slope * t * t < share else (lo, t)
    return hi


def test_mixing_query_comes_in_the_order_of_inverted_schedules(spark):
    import hashlib

    from tallyloom.llm.queries import QUERIES

    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    mix = {r.doc_id: r for r in mixing.mixed_documents(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    slope = {s: mixing.SLOPES[i % 3] for i, s in enumerate(sorted({r.source for r in rows}, key=lambda s: (s is None, s or "")))}
    assert len(slope) > 1
    want, begun = {}, dict.fromkeys(slope, 0)
    for r in sorted(rows, key=lambda r: md5(f"{'' if r.doc_id is None else r.doc_id}/{md5(r.text or '')}")):
        m = mix[r.doc_id]
        want[r.doc_id] = due(min(1.0, begun[r.source] / m.target), slope[r.source]) if m.taken else 1.0
        begun[r.source] += m["size"]
    assert {i: r.position for i, r in mix.items()} == {i: pytest.approx(t, abs=1e-9) for i, t in want.items()}
    query = QUERIES["op8_mixing"](spark, SF)
    assert "rangepartitioning(position" in query._jdf.queryExecution().toString()
    order = [want[r.doc_id] for r in query.collect()]
    assert len(order) == len(rows) and all(a <= b + 1e-9 for a, b in zip(order, order[1:]))


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 10}, {"a": 0, "b": 0}, {None: 5, "b": 50}])
def test_targets_are_the_fixed_point_of_resharing(spark, sizes):
    out = {r.source: r for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), set()
    while True:
        rest = sum(weight[s] for s in names if s not in fixed)
        target = {s: 2 * sizes[s] if s in fixed else (total - sum(2 * sizes[f] for f in fixed)) * weight[s] / rest for s in names}
        above = {s for s in names if target[s] > 2 * sizes[s] + 1e-9}
        if not above:
            break
        fixed |= above
    assert {s: pytest.approx(target[s]) for s in names} == {s: out[s].target for s in names}


def test_packing(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    odd = docs.filter("doc_id < 90").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in odd.collect()}
    pieces = [r.asDict() for r in packing.packed(odd, VOCABULARY).collect()]
    assert plain.packing_faults(pieces, texts, encode) == []
    assert packing.packed(docs, VOCABULARY).count() >= docs.count()  # repeated and null ids
    assert packing.packed(none, VOCABULARY).collect() == []


@pytest.mark.parametrize("text", ["", " ", "a  b", "two  spaces \n x", "it's we'll", " lead", "trail ", " x y z", "<|endoftext|> a <|endoftext|>", "x\ty z\n\nw", "é\U0001f600 ß\x00 1234 ??!"])
def test_word_by_word_ids_are_those_of_the_tokenizer(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    data = packing.Encoder(VOCABULARY)([text, "some words " + text])
    for t, d in zip([text, "some words " + text], data):
        assert np.frombuffer(d, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


ADDED = ["a <|endoftext|> b", "<|endoftext|>", " <|endoftext|><|endoftext|> x  <|endoftext|>  y", "it<|endoftext|>'s <|endoftext|", "no token  here ", ""]


def test_added_tokens_get_their_own_id(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    assert encode(ADDED[0]) == [64, 220, 50256, 275]
    assert [np.frombuffer(d, "<u4").tolist() for d in packing.Encoder(VOCABULARY, added=True)(ADDED)] == [encode(t) for t in ADDED]
    df = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    rows = [r.asDict() for r in packing.packed(df, VOCABULARY).collect()]
    assert plain.packing_faults(rows, dict(enumerate(ADDED)), encode) == []


def optimum(lengths, capacity):
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                rooms[k] -= lengths[i]
                place(i + 1, rooms)
                rooms[k] += lengths[i]
        rooms.append(capacity - lengths[i])
        place(i + 1, rooms)
        rooms.pop()

    place(0, [])
    return best[0]


def test_dominance_keeps_an_optimum():
    draw = np.random.default_rng(8)
    for _ in range(200):
        capacity = int(draw.integers(8, 24))
        lengths = draw.integers(1, capacity + 1, int(draw.integers(3, 9))).tolist()
        left = np.bincount(lengths, minlength=capacity + 1)
        fixed = packing.reduce_by_dominance(left, capacity)
        rest = [w for w in range(capacity + 1) for _ in range(left[w])]
        assert sum(n for _, n in fixed) + (optimum(rest, capacity) if rest else 0) == optimum(lengths, capacity)


def test_language(spark, docs, none):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(df).join(df.select(F.col("doc_id").alias("i"), "lang"), F.col("i") == F.col("doc_id"))
    left = out.filter("held_out")
    assert left.count() > 100 and left.filter("lang = lang_pred").count() >= 0.97 * left.count()
    assert out.filter("score < 0 or score > 1").count() == 0
    seen = {(r.doc_id, r.lang_pred) for r in language.identify(docs).collect()}
    assert {(0, "und"), (1, "und"), (2, "und"), (14, "und")} <= seen and (4, "und") not in seen
    assert language.identify(none).collect() == []
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_learns_from_600_rows_each(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("lang"))
    found = language.learning_rows(rows, "doc_id", "text", "lang", F.lit(False)).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in found} == {"a": 600, "b": 600} and language.ROWS == 6000


def test_language_by_features_is_by_rows(monkeypatch):
    draw = np.random.default_rng(4)
    features = draw.random((90, 40)).astype(np.float32)
    names = [("de", "en", "fr")[i] for i in draw.integers(0, 3, 90)]
    model = language.fit(features, names)
    wide = np.concatenate([features, np.zeros((90, 60), np.float32)], axis=1)  # more features than rows, none that says more
    other = language.fit(wide, names)
    assert np.allclose(model.weights, other.weights[:40], atol=1e-3) and np.allclose(model.bit_weight, other.bit_weight)


@pytest.mark.parametrize("n", [2, 4, 7, 12, 40])
def test_codewords_differ(n):
    book = language.codebook(n)
    assert book.shape[0] == n and set(np.unique(book)) == {-1.0, 1.0}
    distance = [(book[i] != book[j]).sum() for i in range(n) for j in range(i)]
    assert min(distance) >= (1 if n == 2 else 2)


def test_toxicity(spark, docs, none):
    df, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = toxicity.score(df, labels).join(labels.select(F.col("doc_id").alias("i"), "toxic"), F.col("i") == F.col("doc_id")).filter("held_out").collect()
    caught = sum(r.predicted and r.toxic for r in out)
    assert caught >= 0.8 * sum(r.toxic for r in out) and caught >= 0.85 * sum(r.predicted for r in out)
    seen = toxicity.score(docs, labels).collect()
    assert len(seen) == docs.count() and all(0 <= r.score <= 1 for r in seen) and all(r.predicted == (r.score >= 0.7) for r in seen)
    assert {r.predicted for r in seen if r.doc_id in (0, 1, 2)} == {0}
    assert toxicity.score(none, labels).collect() == []
    assert toxicity.score(docs, labels.filter("false")).count() == docs.count()


def test_gradient_of_the_network():
    net = toxicity.Network(3)
    draw = np.random.default_rng(0)
    table = net.projected(draw.standard_normal((9, toxicity.EMBED)).astype(np.float32)).astype(np.float64)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    windows = draw.integers(0, 10, (6, 5))
    windows[:, 0] = 1
    target, weight = np.array([0, 1, 0, 1, 1, 0.0]), np.ones(6)

    def loss():
        x = net.run(table, windows)
        return float(np.mean(np.log1p(np.exp(x)) - target * x))

    g, d_rows = net.gradient(table, windows, target, weight)
    for name, at in (("gate_f", (1, 2)), ("new_b", (0, 3)), ("attend", (2,)), ("out", (7,))):
        step = 2e-3
        net.p[name][at] += step
        up = loss()
        net.p[name][at] -= 2 * step
        down = loss()
        net.p[name][at] += step
        assert g[name][at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-4)


def test_packed_records_come_back():
    keys = np.array([-5, -5, 0, 7, 7, 7], np.int64)
    places = np.array([0, 9, 3, 1, 1, 1 << 40], np.int64)
    codes = np.array([1, 2, 3, 4, 5, (1 << 48) - 1], np.uint64)
    back = common.unpack(common.pack(keys, places, (codes, 6)), ("<u8", 6))
    assert all((a == b).all() for a, b in zip(back, (keys, places, codes)))


def test_ranks_of_a_hot_group(spark):
    rows = spark.range(500).select(F.lit("hot").alias("g"), F.md5(F.col("id").cast("string").cast("binary")).alias("h"), (F.col("id") % 5).alias("v"))
    out = sorted((r.h, r.v, r.before) for r in common.ranked(rows, ["g"], ["h"], "v", "before").collect())
    total = 0
    for _, v, before in out:
        assert before == total
        total += v
