"""Named queries over the corpus tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embed_grid, language, mixing, multiset_hash, packing, periodic_runs, simhash, substring_cover, suffix_dedup, topk, toxicity, variants, warc
from .sql import CRC_TABLE, crc32

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = lambda spark, folder: fn(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


@query(
    """
    WITH RECURSIVE v AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
             WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
    low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
    SELECT e.vec_id, coalesce(n.n, 0) AS n_links, low.component_id, e.vec_id = low.component_id AS kept
    FROM embeddings e JOIN low ON low.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
    """
)
def op1_near_vectors(table):
    """Near-duplicate vectors of equal label."""
    return embed_grid.near_vectors(table("embeddings"))


@query(
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
    s AS (SELECT doc_id, pos, string_agg(word, ' ') OVER f AS s, count(*) OVER f AS n FROM w
          WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
    later AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY sha256(s) ORDER BY doc_id, pos) AS k FROM s WHERE n = 20) WHERE k > 1),
    gone AS (SELECT DISTINCT doc_id, pos + i AS pos FROM later, range(20) AS r(i)),
    kept AS (SELECT w.doc_id, count(*) AS n, string_agg(w.word, ' ' ORDER BY w.pos) AS t FROM w ANTI JOIN gone USING (doc_id, pos) GROUP BY w.doc_id)
    SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)
    """
)
def op2_word_windows(table):
    """Repeated windows of 20 words removed."""
    out = substring_cover.dedup_word_windows(table("documents"), window=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op3_language(table):
    """Language of every text."""
    return language.identify(table("documents"))


@query(
    """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    m AS (SELECT doc_id, list_transform(range(0, greatest(0, len(x) // 2 - 99)), lambda p: md5_number(substr(x, 2 * p + 1, 200))) AS m FROM d),
    w AS (SELECT doc_id, unnest(m) AS m, generate_subscripts(m, 1) - 1 AS p FROM m),
    h AS (SELECT doc_id, p, row_number() OVER (PARTITION BY m ORDER BY doc_id, p) AS nth FROM w),
    l AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM h WHERE nth > 1),
    i AS (SELECT doc_id, p, sum(CASE WHEN p - before <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM l),
    s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY doc_id, island),
    n AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM s GROUP BY doc_id),
    k AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM s
          UNION ALL SELECT doc_id, max(b), NULL FROM s GROUP BY doc_id),
    y AS (SELECT d.doc_id, string_agg(substr(x, 2 * f + 1, 2 * (coalesce(t, len(x) // 2) - f)), '' ORDER BY f) AS y FROM d JOIN k USING (doc_id) GROUP BY d.doc_id)
    SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(y, x))) AS kept_sha256
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN y USING (doc_id)
    """
)
def op4_suffix_dedup(table):
    """Repeated strings of 100 bytes removed."""
    out = suffix_dedup.dedup_bytes(table("documents"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op5_simhash(table):
    """Near-duplicate documents by fingerprints."""
    out = simhash.near_duplicates(table("documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest FROM pages),
    f AS (SELECT digest, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY digest)
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN first IS NOT NULL AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to
    FROM p LEFT JOIN f USING (digest)
    """
)
def op6_warc(table):
    """Pages written to seekable WARC bundles and read back."""
    return warc.round_trip(table("pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 100 = 0)
    SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s) WHERE k <= 10
    """
)
def op7_top_k(table):
    """The ten best of all vectors for every hundredth."""
    vectors = table("embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


@query(
    r"""
    WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                      md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))) AS h FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM d GROUP BY source),
    w AS (SELECT *, CASE n % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, 2.0::DOUBLE * source_size AS most FROM s),
    r AS (SELECT *, most / weight AS ratio FROM w),
    l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
                     - coalesce(sum(most) OVER (ORDER BY ratio, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (ORDER BY ratio, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
    f AS (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, n LIMIT 1),
    t AS (SELECT source, source_size, coalesce(least(most, (SELECT level FROM f) * weight), most) AS target,
                 CASE n % 3 WHEN 0 THEN -0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS g FROM r),
    q AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS whole, CAST(floor(target + 0.5) AS BIGINT) // greatest(source_size, 1) AS passes FROM t),
    b AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun FROM d),
    m AS (SELECT b.doc_id, b.size, q.source_size, q.target, q.g,
                 CAST(q.passes * b.size + greatest(0, least(b.size, q.whole - q.passes * q.source_size - b.begun)) AS BIGINT) AS taken,
                 least(1.0::DOUBLE, coalesce(CAST(b.begun AS DOUBLE) / nullif(q.target, 0), 1.0::DOUBLE)) AS due
          FROM b JOIN q ON b.source IS NOT DISTINCT FROM q.source)
    SELECT doc_id, size, source_size, target, taken,
           CASE WHEN taken = 0 THEN 1.0::DOUBLE WHEN g = 0 THEN due ELSE (sqrt((1 - g) * (1 - g) + 4 * g * due) - (1 - g)) / (2 * g) END AS position
    FROM m
    """
)
def op8_mixing(table):
    """Documents mixed to target weights of their sources, range-sorted by their place in the training order."""
    mix = mixing.in_training_order(mixing.mixed_documents(table("documents")))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "position")


@query()
def op9_packing(table):
    """Documents packed into sequences of 1024 tokens."""
    return packing.packed(table("documents"), public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


@query()
def op10_toxicity(table):
    """Toxicity of every text."""
    return toxicity.score(table("documents"), table("labels"))


@query()
def op11_multiset_hash(table):
    """Multiset-hash fingerprints of all texts, their edited forms and their neighbours."""
    return multiset_hash.fingerprints(table("documents"))


@query(
    f"""
    WITH RECURSIVE {CRC_TABLE},
    f AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
    g AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM f WHERE length(run) >= 5 GROUP BY ALL),
    h AS (SELECT run, n, {crc32("id || ':' || run")} AS h FROM g, crc),
    c AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM h),
    w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM c WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
    p AS (SELECT a.word AS a, b.word AS b FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT d.word, w.word FROM d JOIN w ON d.rest = w.word UNION SELECT w.word, d.word FROM d JOIN w ON d.rest = w.word),
    m AS (SELECT p.a, count(*) AS n_near, max(w.n) AS best_n, min_by(p.b, (-w.n, p.b)) AS best FROM p JOIN w ON w.word = p.b GROUP BY p.a),
    v AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
          FROM w LEFT JOIN m ON m.a = w.word),
    r AS (SELECT word, word AS root FROM v UNION ALL SELECT r.word, v.form FROM r JOIN v ON v.word = r.root WHERE v.form IS NOT NULL),
    e AS (SELECT r.word, r.root FROM r JOIN v ON v.word = r.root WHERE v.form IS NULL)
    SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM v JOIN e USING (word)
    """
)
def op12_variants(table):
    """Words of all texts with the more frequent word that each is a spelling variant of."""
    return variants.grouped(table("documents"))


@query(
    rf"""
    WITH {CRC_TABLE},
    d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc),
    e AS (SELECT doc_id, ws, len(ws) AS n, h, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) ELSE len(ws) END AS a FROM d),
    k AS (SELECT doc_id, n, CASE WHEN a = n THEN ws ELSE list_transform(range(n), lambda i: ws[CAST(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END AS BIGINT) + 1]) END AS ws FROM e),
    w AS (SELECT doc_id, n, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM k),
    s AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id IS NOT DISTINCT FROM y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
    b AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM s),
    u AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM b GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
    r AS (SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(min(q) AS BIGINT) AS period FROM u GROUP BY ALL),
    best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / CAST(period AS DOUBLE) DESC, start, period) = 1),
    t AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
    c AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY w.doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM d LEFT JOIN t USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN c USING (doc_id)
    """
)
def op13_periodic_runs(table):
    """Periodic runs of words, after one document in ten was made to repeat a stretch."""
    out = periodic_runs.periodic_runs(table("documents"), edited=True)
    return out.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", periodic_runs.digest_of(F.col("runs")).alias("runs_sha256"),
                      F.sha2("collapsed", 256).alias("collapsed_sha256"))
