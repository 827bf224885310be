"""Running calculations in a stated order that survive very large or very uneven groups.

A window function sorts each group in one task. That is right while every group
is small, and wrong for a global order or for a group that holds a third of all
rows. ``running`` therefore checks the largest group first:

* small groups: an ordinary window per group;
* otherwise: rows are cut into slices of the sorted order (all groups one after
  another). Slice borders come from a small sample and are put into the plan as
  constants, so the slice of a row is a pure function of the row and a task that
  is run again gives the same answer. Each slice is sorted alone and then
  corrected by what lies in earlier slices of its group. At most one correction
  row exists per slice border, whatever the number of groups, so that table has
  a proven bound and is broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import attach

ROWS_PER_TASK = 4_000_000
_SAMPLES_PER_SLICE = 32
_SLICE = "__slice"


@dataclass(frozen=True)
class Size:
    """Row counts found by the size check."""

    rows: int
    largest_group: int
    groups: int | None = field(default=None, compare=False)


@dataclass(frozen=True)
class Order:
    """A key of an order with its direction and the place of missing values."""

    column: Column | str
    descending: bool = False
    missing_last: bool = False


def down(column: Column | str, missing_last: bool = False) -> Order:
    """Descending order for any type that can be sorted, text and dates included."""
    return Order(column, True, missing_last)


def measure(df: DataFrame, by: Sequence[str] = ()) -> Size:
    """Total rows and rows of the largest group, by one partial aggregate."""
    if not by:
        n = df.count()
        return Size(n, n, 1)
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.sum("n").alias("rows"), F.max("n").alias("largest"), F.count(F.lit(1)).alias("groups")).first()
    return Size(row["rows"] or 0, row["largest"] or 0, row["groups"])


def _sortable(df: DataFrame, col: Column) -> Column:
    """Dates and times as numbers, so that borders can be written as constants."""
    kind = df.select(col.alias("c")).schema["c"].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):  # no detour over a time zone, which may skip or repeat hours
        minutes = (F.unix_date(col.cast("date")).cast("long") * 24 + F.hour(col)) * 60 + F.minute(col)
        return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(col)
    if isinstance(kind, T.BinaryType):
        return F.hex(col)  # two digits per byte keep the order of the bytes
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (col * F.lit(10**kind.scale)).cast("long")
    return col


def _reversed(kind: T.DataType, key: Column) -> Column:
    """A key whose ascending order is the descending order of the given one."""
    if isinstance(kind, T.StringType):
        # complement of every digit; the mark at the end puts a text behind those it is the beginning of
        return F.concat(F.translate(F.hex(key), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    if isinstance(kind, T.BooleanType):
        return ~key
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(key)  # unlike a changed sign it has no overflow
    return -key


def _order_keys(df: DataFrame, order: Sequence[Column | str | Order]) -> list[Column]:
    keys = []
    for o in order:
        o = o if isinstance(o, Order) else Order(o)
        col = F.col(o.column) if isinstance(o.column, str) else o.column
        key = _sortable(df, col)
        if o.missing_last:
            keys.append(col.isNull())
        keys.append(_reversed(df.select(key.alias("c")).schema["c"].dataType, key) if o.descending else key)
    return keys


def _constant(values, kind: str) -> Column:
    """Nested constant of any size as one literal (folded by the optimizer), not one expression per value."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _slice_number(keys: Sequence[str], df: DataFrame, borders: Sequence[tuple]) -> Column:
    """Number of borders that are not above the row, by binary search in one constant array."""
    kinds = [df.schema[k].dataType.simpleString() for k in keys]
    row = F.struct(*[F.col(k).cast(t).alias(f"k{i}") for i, (k, t) in enumerate(zip(keys, kinds))])
    border = "struct<" + ",".join(f"k{i}:{t}" for i, t in enumerate(kinds)) + ">"
    values = _constant([{f"k{i}": _plain(v) for i, v in enumerate(b)} for b in borders], f"array<{border}>")
    steps = [1 << i for i in reversed(range(len(borders).bit_length()))]

    def advance(at, step):
        # beyond the end there is no border, the test is missing and the position stays
        return F.when(F.get(values, at + step - 1) <= row, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def _with_slices(df: DataFrame, keys: Sequence[str], rows: int, rows_per_task: int) -> DataFrame:
    slices = max(2, -(-rows // rows_per_task))
    fraction = min(1.0, slices * _SAMPLES_PER_SLICE / max(rows, 1))
    sample = df.select(*keys).sample(fraction=fraction, seed=7).orderBy(*keys).collect()
    step = max(1, len(sample) // slices)
    borders = sorted({i for i in range(step, len(sample), step)})[: slices - 1]
    if not borders:
        return df.withColumn(_SLICE, F.lit(0))
    return df.withColumn(_SLICE, _slice_number(keys, df, [tuple(sample[i]) for i in borders]))


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str | Order],
    *,
    row_number: str | None = None,
    cumsum: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    carry: Mapping[str, str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    size: Size | None = None,
    bound: int | None = None,
) -> DataFrame:
    """Add running columns per group.

    The size check is one narrow aggregate job. It is left out when the caller
    passes the ``size`` or a proven ``bound`` on the rows of any group. Persist
    an input that is expensive to compute, since it is read more than once.

    ``order`` is ascending with missing values first (pass ``-col`` for
    descending numbers, ``down(col)`` for any type) and should be unique within
    the group; equal rows are taken in an arbitrary order.

    * ``row_number``: name of the position column, from 1
    * ``cumsum``: new name -> column to add up, missing values skipped
    * ``previous``: new name -> column whose value in the preceding row is wanted
    * ``carry``: new name -> column whose last non-missing value so far is wanted
    """
    cumsum, previous, carry = dict(cumsum or {}), dict(previous or {}), dict(carry or {})
    by = list(by)
    keys = _order_keys(df, order)
    names = [f"__o{i}" for i in range(len(keys))]
    keyed = df.withColumns(dict(zip(names, keys)))
    if bound is not None and bound <= rows_per_task:
        size = Size(bound, bound)
    size = size or measure(df, by)
    if size.largest_group <= rows_per_task:
        return _local(keyed, by, names, row_number, cumsum, previous, carry).drop(*names)

    groups = [f"__g{i}" for i in range(len(by))]  # group keys whose values can stand in the border constants
    keyed = keyed.withColumns({g: _sortable(df, F.col(b)) for g, b in zip(groups, by)})
    cut = _with_slices(keyed, [*groups, *names], size.rows, rows_per_task)
    local = _local(cut, [*by, _SLICE], names, row_number, cumsum, previous, carry)
    fixes = _corrections(cut, by, names, cumsum, previous, carry)
    joined = _attach_small(local, fixes, [*by, _SLICE], -(-size.rows // rows_per_task))
    out = {}
    if row_number:
        out[row_number] = F.col(row_number) + F.coalesce(F.col("__before"), F.lit(0))
    for name in cumsum:
        fix = F.col(f"__s_{name}")
        out[name] = F.coalesce(F.col(name) + fix, F.col(name), fix)
    for name in previous:
        out[name] = F.when(F.col("__first") == 1, F.col(f"__p_{name}")).otherwise(F.col(name))
    for name in carry:
        out[name] = F.coalesce(F.col(name), F.col(f"__c_{name}"))
    return joined.withColumns(out).select(*df.columns, *out)


def _local(df, by, names, row_number, cumsum, previous, carry) -> DataFrame:
    order = [F.col(n).asc_nulls_first() for n in names]
    rank = (W.partitionBy(*by) if by else W.partitionBy()).orderBy(*order)
    so_far = rank.rowsBetween(W.unboundedPreceding, W.currentRow)
    cols = {}
    if row_number:
        cols[row_number] = F.row_number().over(rank).cast("long")
    for name, c in cumsum.items():
        cols[name] = F.sum(c).over(so_far)
    for name, c in previous.items():
        cols[name] = F.lag(c).over(rank)
    for name, c in carry.items():
        cols[name] = F.last(c, ignorenulls=True).over(so_far)
    if previous and _SLICE in by:
        cols["__first"] = F.row_number().over(rank)
    return df.withColumns(cols)


def _corrections(cut, by, names, cumsum, previous, carry) -> DataFrame:
    """What earlier slices of the same group contribute; only for groups cut by a border."""
    position = F.struct(*names)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.sum(c).alias(f"__s_{n}") for n, c in cumsum.items()]
    aggs += [F.max_by(F.struct(c), position).alias(f"__p_{n}") for n, c in previous.items()]
    aggs += [
        F.max_by(F.struct(c), F.when(F.col(c).isNotNull(), position)).alias(f"__c_{n}")
        for n, c in carry.items()
    ]
    parts = cut.groupBy(*by, _SLICE).agg(*aggs)
    # one row per (group, slice): rows / rows per task of them at most for a group
    order = (W.partitionBy(*by) if by else W.partitionBy()).orderBy(_SLICE)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    cols = {"__before": F.sum("__n").over(before)}
    for n in cumsum:
        cols[f"__s_{n}"] = F.sum(f"__s_{n}").over(before)
    for n, c in previous.items():
        cols[f"__p_{n}"] = F.lag(f"__p_{n}").over(order)[c]
    for n, c in carry.items():
        last = F.when(F.col(f"__c_{n}")[c].isNotNull(), F.col(f"__c_{n}"))
        cols[f"__c_{n}"] = F.last(last, ignorenulls=True).over(before)[c]
    fixed = parts.select(*by, _SLICE, *[v.alias(k) for k, v in cols.items()])
    return fixed.filter(F.col("__before").isNotNull())


# Corrections up to this number are broadcast; beyond it they are joined like any table.
FEW_SLICES = 4096


def _attach_small(df: DataFrame, fixes: DataFrame, keys: Sequence[str], slices: int) -> DataFrame:
    # less rows than slices: a border cuts at most one group
    small = fixes.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    small = F.broadcast(small) if slices <= FEW_SLICES else small
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return df.join(small, same, "left").drop(*[f"__r_{k}" for k in keys])


def ntile_of(position: Column, total: Column, n: int) -> Column:
    """Bucket 1..n of a position; the first ``total % n`` buckets get one row more."""
    small = F.floor(total / F.lit(n))
    extra = total % F.lit(n)
    wide = extra * (small + 1)
    at = position - 1
    first = F.floor(F.try_divide(at, small + 1)) + 1
    rest = extra + F.floor(F.try_divide(at - wide, small)) + 1
    return F.when(at < wide, first).otherwise(rest).cast("int")


def ntile(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    name: str = "ntile",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Equal-count buckets over each group (or over all rows when ``by`` is empty)."""
    by = list(by)
    size = measure(df, by)
    placed = running(df, by, order, row_number="__pos", rows_per_task=rows_per_task, size=size)
    if by:
        totals = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__total"))
        placed = attach(placed, totals, by, groups=size.groups)
    else:
        placed = placed.withColumn("__total", F.lit(size.rows).cast("long"))
    return placed.withColumn(name, ntile_of(F.col("__pos"), F.col("__total"), n)).drop("__pos", "__total")


def average_rank(df: DataFrame, by: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """Rank in which equal values share the mean of their positions.

    Equal values are counted before anything is ordered, so a value shared by
    very many rows costs one row in the ordering. Missing values get no rank.
    """
    by = list(by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    ranked = running(counts, by, [value], cumsum={"__upto": "__n"})
    ranked = ranked.select(*by, value, (F.col("__upto") - (F.col("__n") - 1) / 2).alias(name))
    return attach(df, ranked, [*by, value])
