"""From documents to packed training sequences: language, near-duplicates, repeated passages, mix, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tallyloom.llm import language, mixing, packing, simhash, suffix_dedup
from tallyloom.llm.common import keyed, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

def identify_language(spark, docs, sf_dir):
    """Keeps documents of a learned language. Rejected: no letter, hardly any, or n-grams that no learned language has.

    Texts of two learned languages and very short ones are ambiguous, but clean; they stay.
    """
    out = language.held_out("doc_id", 4, 2)
    model = language.learn(docs, "doc_id", "text", "lang", out)
    seen = language.predicted(docs, model, "text", list(COLUMNS))
    kept = seen.filter((F.col("lang_pred") != language.UNKNOWN) & ~F.col("unfamiliar"))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark, docs, sf_dir):
    """Keeps the first document of every group of near-duplicates."""
    rows, _ = keyed(docs, "doc_id", "text")
    groups = simhash.near_duplicates(rows, id_col="__key")
    first = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("__first"))
    return rows.join(first, F.col("__key") == F.col("__first"), "left_semi").select(*COLUMNS)


def drop_repeated_passages(spark, docs, sf_dir):
    """Removes every string of 100 bytes that also starts earlier; characters that lose a byte go altogether."""
    rows, total = keyed(docs, "doc_id", "text")
    texts = rows.select(F.col("__key").alias("key"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    cut = suffix_dedup.dedup_keyed(texts, total, 100, True).select(F.col("doc_id").alias("__cut"), F.col("kept").cast("string").alias("__text"))
    joined = rows.drop("text").join(cut, F.col("__key") == F.col("__cut"))
    return joined.withColumn("text", F.col("__text")).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark, docs, sf_dir):
    """Every document as often as the mix takes it, in training order; what is taken in part ends after so many words."""
    mix = mixing.mixed_documents(docs, carry=COLUMNS).filter("taken > 0")
    copies = mix.withColumn("copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    words = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size")).cast("int")
    text = F.col(f"c{COLUMNS.index('text')}")
    part = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(mixing.WORD), F.lit(0)), F.lit(1), words), " ")
    shown = copies.withColumn("__text", F.when(words < F.col("size"), part).otherwise(text)).withColumn("position", F.col("copy") - 1 + F.col("position"))
    named = {c: F.col(f"c{i}") for i, c in enumerate(COLUMNS)} | {"text": F.col("__text"), "n_chars": F.char_length("__text").cast("long")}
    return mixing.in_training_order(shown).select(*[v.alias(c) for c, v in named.items()])


def pack_sequences(spark, docs, sf_dir):
    """Sequences of 1024 tokens, by piece of a document."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Hashes, learned languages and token ids are beyond SQL; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
