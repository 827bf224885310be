"""Exact quantiles with linear interpolation, without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import attach
from .ordering import ROWS_PER_TASK, running
from .partials import reduced
from .rows import values_long

#: Bits by which a bracket is narrowed in a round, and values that are few enough to fetch.
DIGIT, FETCHED = 11, 20_000


def long_numbers(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form ``(by..., key, value)`` of numeric columns, missing cells left out."""
    if not by:
        return values_long(df, names, "double").filter(F.col("value").isNotNull())
    cells = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).cast("double").alias("value")) for n in names])
    return df.select(*by, F.inline(cells)).filter(F.col("value").isNotNull())


def quantiles(
    df: DataFrame,
    names: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows ``(by..., key, prob, value)``: quantiles of every column, per group.

    Of a whole table the wanted places are found by narrowing brackets of
    values. Of groups, which may be many, distinct values are counted, put in
    order in slices, and the two neighbours of each wanted place are read off.
    Both ways are the same at every size and interpolate alike.
    """
    by, probs = list(by), [float(p) for p in probs]
    return _by_position(df, names, probs, by, rows_per_task) if by else _by_brackets(df, names, probs)


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; both zeros are one, no numbers come last."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 0, bits | np.uint64(1 << 63), ~bits)


def doubles_of(bits: np.ndarray) -> np.ndarray:
    return np.where(bits >> np.uint64(63) == 1, bits & np.uint64((1 << 63) - 1), ~bits).view(np.float64)


def _numbers(batches, names: Sequence[str]):
    """Ordered bits of the present values of every column."""
    for batch in batches:
        for i in range(len(names)):
            column = batch.column(i).drop_null()
            if len(column):
                yield i, ordered_bits(np.asarray(column, np.float64))


def _by_brackets(df, names, probs) -> DataFrame:
    """All columns and probabilities at a time: brackets of values that hold the wanted places, narrowed in rounds.

    A round counts the values of every open bracket by their next 11 bits, so its memory does not depend on the rows.
    Once the brackets hold few values, these are fetched.
    """
    names = list(names)
    frame = df.select(*[F.col(f"`{n}`").cast("double").alias(f"c{i}") for i, n in enumerate(names)])
    # A bracket is (column, its leading bits, how many), with the number of values below it.
    counts = _digits(frame, names, [(i, 0, 0) for i in range(len(names))])
    total = counts.sum(1)
    wanted = {}
    for i in range(len(names)):
        for p in probs:
            at = (total[i] - 1) * p
            wanted.update({(i, int(np.floor(at))): None, (i, int(np.ceil(at))): None} if total[i] else {})
    state = {w: ((w[0], 0, 0), 0) for w in wanted}
    brackets = [(i, 0, 0) for i in range(len(names))]
    while True:
        size = {}
        for w, (bracket, below) in state.items():
            if bracket[2] >= 64:
                continue
            row = counts[brackets.index(bracket)]
            upto = below + np.cumsum(row)
            digit = int(np.searchsorted(upto, w[1], "right"))
            width = min(DIGIT, 64 - bracket[2])
            new = (bracket[0], bracket[1] << width | digit, bracket[2] + width)
            size[new] = int(row[digit])
            state[w] = (new, int(upto[digit] - row[digit]))
        brackets = [b for b in size if b[2] < 64]
        if not brackets:
            break
        if sum(size[b] for b in brackets) <= FETCHED:
            _fetched(frame, names, brackets, state)
            break
        counts = _digits(frame, names, brackets)
    value = {w: doubles_of(np.array([b[1]], np.uint64))[0] for w, (b, _) in state.items()}
    rows = []
    for i, n in enumerate(names):
        for p in probs if total[i] else ():
            at = (total[i] - 1) * p
            low, high = value[i, int(np.floor(at))], value[i, int(np.ceil(at))]
            rows.append((n, p, float(low if low == high else low + (high - low) * (at - np.floor(at)))))
    return df.sparkSession.createDataFrame(rows, "key string, prob double, value double")


def _inside(bits: np.ndarray, bracket: tuple[int, int, int]) -> np.ndarray:
    _, lead, known = bracket
    return bits[bits >> np.uint64(64 - known) == np.uint64(lead)] if known else bits


def _digits(frame: DataFrame, names: Sequence[str], brackets: list) -> np.ndarray:
    """Values of every bracket by their next bits."""
    def work(batches):
        total = np.zeros((len(brackets), 1 << DIGIT))
        for i, bits in _numbers(batches, names):
            for k, b in enumerate(brackets):
                if b[0] == i:
                    width = min(DIGIT, 64 - b[2])
                    digit = (_inside(bits, b) >> np.uint64(64 - b[2] - width)) & np.uint64((1 << width) - 1)
                    total[k] += np.bincount(digit.astype(np.int64), minlength=1 << DIGIT)
        return total

    found = reduced(frame, len(brackets) << DIGIT, work)
    return (found if len(found) else np.zeros(len(brackets) << DIGIT)).reshape(len(brackets), 1 << DIGIT).astype(np.int64)


def _fetched(frame: DataFrame, names: Sequence[str], brackets: list, state: dict) -> None:
    """Settles all open places from the values of their brackets."""
    def work(batches):
        for i, bits in _numbers(batches, names):
            for k, b in enumerate(brackets):
                if b[0] == i:
                    values, n = np.unique(_inside(bits, b), return_counts=True)
                    if len(values):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(values), k, np.int32)), pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["k", "bits", "n"])

    rows = frame.mapInArrow(work, "k int, bits long, n long").groupBy("k", "bits").agg(F.sum("n").alias("n")).collect()
    held: dict[int, list[tuple[int, int]]] = {}
    for r in rows:
        held.setdefault(r["k"], []).append((r["bits"] % (1 << 64), r["n"]))
    for w, (b, below) in list(state.items()):
        if b in brackets:
            own = sorted(held[brackets.index(b)])
            upto = below + np.cumsum([n for _, n in own])
            state[w] = ((b[0], own[int(np.searchsorted(upto, w[1], "right"))][0], 64), 0)


def _by_position(df, names, probs, by, rows_per_task) -> DataFrame:
    group = [*by, "key"]
    counts = long_numbers(df, names, by).groupBy(*group, "value").agg(F.count(F.lit(1)).alias("__n"))
    placed = running(counts, group, ["value"], cumsum={"__upto": "__n"}, rows_per_task=rows_per_task)
    totals = counts.groupBy(*group).agg(F.sum("__n").alias("__total"))
    spots = F.array(
        *[
            F.struct(F.lit(p).alias("prob"), ((F.col("__total") - 1) * F.lit(p)).alias("at"))
            for p in probs
        ]
    )
    here = attach(placed, totals.withColumn("__spots", spots), group)
    start = F.col("__upto") - F.col("__n")

    def covers(position):
        return (position >= start) & (position < F.col("__upto"))

    hits = F.filter(F.col("__spots"), lambda s: covers(F.floor(s["at"])) | covers(F.ceil(s["at"])))
    near = here.filter(F.size(hits) > 0).select(*group, "value", "__n", "__upto", F.explode(hits).alias("s"))
    low = F.max(F.when(covers(F.floor("s.at")), F.col("value")))
    high = F.max(F.when(covers(F.ceil("s.at")), F.col("value")))
    part = F.max(F.col("s.at") - F.floor("s.at"))
    return (
        near.groupBy(*group, F.col("s.prob").alias("prob"))
        .agg(low.alias("__low"), high.alias("__high"), part.alias("__part"))
        .select(*group, "prob", F.when(F.col("__low") == F.col("__high"), F.col("__low")).otherwise(F.col("__low") + (F.col("__high") - F.col("__low")) * F.col("__part")).alias("value"))
    )


def quantiles_wide(
    df: DataFrame, name: str, probs: dict[str, float], by: Sequence[str] = (), rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """One row per group with one named column per quantile."""
    found = quantiles(df, [name], list(probs.values()), by, rows_per_task)
    picks = [F.max(F.when(F.col("prob") == F.lit(p), F.col("value"))).alias(n) for n, p in probs.items()]
    return found.groupBy(*by).agg(*picks)


def cut_points(df: DataFrame, name: str, probs: Sequence[float]) -> list[float]:
    """Quantiles of one column as numbers for the driver (one number per probability)."""
    found = {r["prob"]: r["value"] for r in quantiles(df, [name], probs).collect()}
    return [found[float(p)] for p in probs]
