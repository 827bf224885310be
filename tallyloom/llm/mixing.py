"""Mixing sources to target weights as a time-varying curriculum, with DataFrame functions only.

The weight of a source changes in the course of training: at time t in [0, 1] source s asks for tokens at the rate
w_s * (1 + g_s * (2 t - 1)) with a slope g_s in [-1, 1]. Its integral over the whole run is w_s, so the schedule moves tokens in time and leaves
the totals alone. By time t a source has given out the share (1 - g) t + g t^2 of its target. A document that begins
after c tokens of its source is due when that share equals c / target; inverting the square gives its position.
Positions of all documents of all sources make one order, by which the documents are range-sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, ranked, stored

WEIGHTS = (5, 2, 1)
#: Slope of the schedule by place in the cycle of weights: heavy sources early, light ones late.
SLOPES = (-0.5, 0.0, 0.5)
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, cap: float = 2.0, slopes: tuple = SLOPES) -> DataFrame:
    """(source, source_size) with weight, slope and target.

    Targets share ``share`` times all sizes by weight. None exceeds ``cap`` times its size; what is above goes to the
    others by weight until none is above. That is one level L with target = least(cap * size, L * weight): in the
    order of cap * size / weight the sources up to some place are at their cap, the others get L * weight.
    The table has one row per source; its windows see sums, not documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    placed = sizes.withColumn("__n", F.row_number().over(by_name) - 1)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("__n") % len(values) + 1).cast("int"))
    rated = placed.withColumn("weight", pick([float(w) for w in weights])).withColumn("slope", pick([float(g) for g in slopes]))
    full = rated.withColumn("__cap", F.lit(cap) * F.col("source_size")).withColumn("__ratio", F.col("__cap") / F.col("weight"))
    order = Window.orderBy("__ratio", "__n")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = full.withColumn("__total", F.lit(share) * F.sum("source_size").over(whole)).withColumn(
        "__level", (F.col("__total") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # The first source that does not reach its cap sets the level; where all reach theirs there is none.
    found = level.withColumn("__l", F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "__n", "__level"))).over(whole)["__level"])
    target = F.coalesce(F.least("__cap", F.col("__l") * F.col("weight")), F.col("__cap"))
    return found.select("source", "source_size", "weight", "slope", target.alias("target"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple = WEIGHTS, share: float = 1.5, cap: float = 2.0, carry: tuple = (), slopes: tuple = SLOPES) -> DataFrame:
    """A row per input row: doc_id, source, size, source_size, target, taken and position, then the carried columns.

    taken: words the mix takes of the document, repeats counted. Documents of a source come in the order of a hash of
    id and text, as often as its target needs them; the last pass ends inside a document. So the words taken of a
    source sum to its target rounded to a whole number, and no document exceeds ``cap`` times its size rounded up.
    position: time in [0, 1] at which the first pass reaches the document (1 where nothing is taken of it).
    A null source is a source of its own, last in order. Null or empty texts have size 0 and nothing taken. Rows that
    repeat an id are told apart by text; rows alike in both are interchangeable. A null id counts as an empty one.
    An empty table gives an empty result. Other columns may have any name; carried ones are named ``c0``, ``c1``, ...
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("/"), F.md5(text.cast("binary")))
    # Texts are read once: what follows works on narrow rows. Carried columns come back by a key in the end.
    rows = keyed(docs, id_col, text_col)[0] if carry else docs.withColumn("__key", F.lit(0))
    sized = stored(rows.select(
        "__key", F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.md5(named.cast("binary")).alias("__md5"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    ), "sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = targets(per_source, weights, share, cap, slopes).withColumnRenamed("source", "__source")
    begun = ranked(sized, ["source"], ["__md5"], "size", "__begin")
    met = begun.join(wanted, F.col("source").eqNullSafe(F.col("__source")))
    whole = F.floor(F.col("target") + 0.5)
    passes = F.floor(whole / F.greatest("source_size", F.lit(1)))
    last = F.greatest(F.lit(0), F.least(F.col("size"), whole - passes * F.col("source_size") - F.col("__begin")))
    taken = (passes * F.col("size") + last).cast("long")
    reached = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("__begin"), F.col("target")), F.lit(1.0)))
    g = F.col("slope")
    # (1 - g) t + g t^2 = reached, for g = 0 the share itself
    curve = (F.sqrt((1 - g) * (1 - g) + 4 * g * reached) - (1 - g)) / (2 * F.when(g == 0, F.lit(1.0)).otherwise(g))
    out = met.withColumn("taken", taken)
    if carry:
        own = rows.select(F.col("__key").alias("__k"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
        out = out.join(own, F.col("__key") == F.col("__k"))
    return out.withColumn("position", F.when(F.col("taken") == 0, F.lit(1.0)).when(g == 0, reached).otherwise(curve)).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "position", *[f"c{i}" for i in range(len(carry))])


def in_training_order(mix: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-sorts the mix by position."""
    keys = [F.col("position"), F.col("doc_id")]
    return (mix.repartitionByRange(partitions, *keys) if partitions else mix.repartitionByRange(*keys)).sortWithinPartitions(*keys)
