"""Column profiles: one pass over the data, results in long form."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import case_when, half_even
from . import columns
from .aggregates import share_within
from .factors import code_of, codes, level_lists, levels_sorted, many_levels
from .keys import attach
from .quantiles import quantiles
from .rows import values_long

# Expressions per aggregate; wider requests are cut into several aggregates.
MAX_EXPRESSIONS = 400


def one_pass(df: DataFrame, stats: dict[str, Column]) -> DataFrame:
    """One row with many aggregates, in as few passes as the generated code allows."""
    items = list(stats.items())
    if len(items) <= MAX_EXPRESSIONS:
        return df.agg(*[c.alias(n) for n, c in items])
    chunks = [items[i : i + MAX_EXPRESSIONS] for i in range(0, len(items), MAX_EXPRESSIONS)]
    parts = [df.agg(F.struct(*[c.alias(n) for n, c in chunk])).scalar() for chunk in chunks]
    one = df.sparkSession.range(1)
    return one.select(*[p[n].alias(n) for p, chunk in zip(parts, chunks) for n, _ in chunk])


def native_long(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Long form ``(key, whole, number, text)`` of some columns, each value in the one of its own kind.

    Whole numbers, days and moments are whole numbers, fractions are doubles; only what is neither becomes text.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    cells = []
    for n in names:
        kind, col = kinds[n], F.col(f"`{n}`")
        whole = number = text = None
        if kind in ("byte", "short", "integer", "long", "boolean"):
            whole = col
        elif kind == "date":
            whole = F.unix_date(col)
        elif kind == "timestamp":
            whole = F.unix_micros(col)
        elif kind in ("float", "double"):
            number = col
        else:
            text = col
        slots = ((whole, "long", "whole"), (number, "double", "number"), (text, "string", "text"))
        cells.append(F.struct(F.lit(n).alias("key"), *[(F.lit(None) if c is None else c).cast(t).alias(a) for c, t, a in slots]))
    return df.select(F.inline(F.array(*cells)))


def cardinality(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Distinct values per column; a missing value counts as one more value."""
    names = list(names or columns.numeric(df))
    cells = native_long(df, names).distinct()
    return cells.groupBy("key").agg(F.count(F.lit(1)).alias("n_values"))


def value_shares(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Share of every value of every text column; missing values are left out."""
    cells = values_long(df, names or columns.textual(df)).filter(F.col("value").isNotNull())
    counts = cells.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    return share_within(counts, ["key"])


def column_profile(df: DataFrame, probs: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """Type, rows, missing, distinct values, and for numbers mean, sd and exact quantiles."""
    numbers, texts = columns.numeric(df), columns.textual(df)
    names = [c for c in df.columns if c in numbers or c in texts]
    stats: dict[str, Column] = {"__rows": F.count(F.lit(1))}
    for n in names:
        stats[f"__present_{n}"] = F.count(n)
        if n in numbers:
            stats[f"__mean_{n}"] = F.avg(F.col(n).cast("double"))
            stats[f"__sd_{n}"] = F.stddev_samp(F.col(n).cast("double"))
    wide = one_pass(df, stats)
    nothing = F.lit(None).cast("double")
    cells = F.array(
        *[
            F.struct(
                F.lit(n).alias("key"),
                F.lit("numeric" if n in numbers else "character").alias("kind"),
                F.col("__rows").alias("n_rows"),
                (F.col("__rows") - F.col(f"__present_{n}")).alias("n_missing"),
                (F.col(f"__mean_{n}") if n in numbers else nothing).alias("mean"),
                (F.col(f"__sd_{n}") if n in numbers else nothing).alias("sd"),
            )
            for n in names
        ]
    )
    out = wide.select(F.inline(cells))
    distinct = native_long(df, names).filter(F.col("whole").isNotNull() | F.col("number").isNotNull() | F.col("text").isNotNull()).distinct()
    distinct = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n_unique"))
    out = out.join(distinct, "key", "left").withColumn("n_unique", F.coalesce("n_unique", F.lit(0)))
    found = quantiles(df, numbers, probs)
    picks = [
        F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(f"p{int(round(p * 100))}") for p in probs
    ]
    return out.join(found.groupBy("key").agg(*picks), "key", "left")


def _long_stats(df: DataFrame, stats: dict[str, Column], key: str, value: str) -> DataFrame:
    wide = one_pass(df, stats)
    cells = F.array(*[F.struct(F.lit(n).alias(key), F.col(f"`{n}`").alias(value)) for n in stats])
    return wide.select(F.inline(cells))


def skewness_table(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Moment (population) skewness of every numeric column; missing for constant columns."""
    stats = {}
    for n in names or columns.numeric(df):
        x = F.col(n).cast("double")
        stats[n] = F.when(F.max(x) > F.min(x), F.skewness(x))
    return _long_stats(df, stats, "key", "skewness")


def skewed_columns(df: DataFrame, cutoff: float = 0.7, exclude: Sequence[str] = ()) -> DataFrame:
    """Columns at or above a skewness cutoff, most skewed first."""
    found = skewness_table(df).filter(F.col("skewness") >= cutoff)
    if exclude:
        found = found.filter(~F.col("key").isin(list(exclude)))
    return found.orderBy(F.desc("skewness"), "key")


def correlation(x: Column, y: Column) -> Column:
    """Aggregate: correlation over rows where both are present; missing for a constant column."""
    a, b = x.cast("double"), y.cast("double")
    sxx, syy, n = F.regr_sxx(b, a), F.regr_syy(b, a), F.regr_count(b, a)

    def varies(square, col):
        # merging partial means leaves a constant column a variance of the order of the rounding error
        size = F.lit(1e-13) * F.max(F.abs(col))
        return square > n * size * size

    return F.when(varies(sxx, a) & varies(syy, b), F.try_divide(F.regr_sxy(b, a), F.sqrt(sxx) * F.sqrt(syy)))


def correlation_matrix(df: DataFrame, names: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """All pairs ``(by..., x, y, correlation)``; each unordered pair is computed once.

    A first narrow pass gives the means and tells which columns have missing
    values; the second adds up products of shifted values, which is far lighter
    than a running covariance per pair. Few columns: built-in sums. Many
    columns: matrix products of whole batches (see ``pair_sums``).
    """
    names = list(names or columns.numeric(df))
    if len(names) * (len(names) + 1) // 2 > MAX_EXPRESSIONS:
        return _both_ways(_from_sums(pair_sums(df, names, by), by))
    return _both_ways(_from_sums(_written_out_sums(df, names, by), by))


def _means(df: DataFrame, names: Sequence[str]) -> tuple[list[float], list[bool]]:
    """Means, and whether a column has missing values."""
    stats = [F.struct(F.avg(F.col(n).cast("double")).alias("m"), (F.count(n) < F.count(F.lit(1))).alias("gaps")) for n in names]
    row = df.agg(*[c.alias(f"m{i}") for i, c in enumerate(stats)]).first()
    return [float(r["m"]) if r["m"] is not None else 0.0 for r in row], [r["gaps"] for r in row]


def _written_out_sums(df: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The result of ``pair_sums`` from built-in sums; columns without gaps share their own sums."""
    means, gaps = _means(df, names)
    x = [F.col(n).cast("double") - F.lit(m) for n, m in zip(names, means)]
    sums: dict[str, Column] = {"__n": F.count(F.lit(1)).cast("double")}
    cells = []

    def add(name, col):
        sums[name] = F.sum(col)
        return F.col(name)

    for i in range(len(names)):
        if not gaps[i]:
            add(f"__s{i}", x[i])
            add(f"__q{i}", x[i] * x[i])
    for i, a in enumerate(names):
        for j in range(i, len(names)):
            if gaps[i] or gaps[j]:
                both = x[i].isNotNull() & x[j].isNotNull()
                u, v = F.when(both, x[i]), F.when(both, x[j])
                of = {"n": F.when(both, 1.0).otherwise(0.0), "sx": u, "sy": v, "sxx": u * u, "syy": v * v, "sxy": u * v}
                got = {k: add(f"__{k}_{i}_{j}", c) for k, c in of.items()}
            else:
                product = F.col(f"__q{i}") if i == j else add(f"__p{i}_{j}", x[i] * x[j])
                got = {"n": F.col("__n"), "sx": F.col(f"__s{i}"), "sy": F.col(f"__s{j}"), "sxx": F.col(f"__q{i}")}
                got |= {"syy": F.col(f"__q{j}"), "sxy": product}
            cells.append(F.struct(F.lit(a).alias("x"), F.lit(names[j]).alias("y"), *[c.alias(k) for k, c in got.items()]))
    wide = df.groupBy(*by).agg(*[c.alias(n) for n, c in sums.items()])
    return wide.select(*by, F.inline(F.array(*cells)))


def _both_ways(upper: DataFrame) -> DataFrame:
    """Add the mirrored pairs in the same pass."""
    swap = F.struct(F.col("y").alias("x"), F.col("x").alias("y"))
    same = F.struct("x", "y")
    ways = F.when(F.col("x") == F.col("y"), F.array(same)).otherwise(F.array(same, swap))
    rest = [c for c in upper.columns if c not in ("x", "y")]
    return upper.withColumn("__xy", F.explode(ways)).select(*rest[:-1], "__xy.x", "__xy.y", rest[-1])


def pair_sums(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sums over complete pairs ``(by..., x, y, n, sx, sy, sxx, syy, sxy)`` for many columns.

    Every partition adds up matrix products of its batches, with values shifted
    by the column means so that nothing cancels, and gives one row per pair.
    """
    names, by = list(names), list(by)
    shift = np.array(_means(df, names)[0], dtype=float)
    first, second = np.triu_indices(len(names))
    labels = np.array(names, dtype=object)
    fields = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    keys = [f"__b{i}" for i in range(len(by))]

    def add(batches):
        found: dict = {}
        for pdf in batches:
            groups = pdf.groupby(keys, dropna=False, sort=False) if keys else [((), pdf)]
            for key, part in groups:
                values = part[names].to_numpy(dtype=float) - shift
                known = ~np.isnan(values)
                x, m = np.where(known, values, 0.0), known.astype(float)
                square = x * x
                full = (m.T @ m, x.T @ m, m.T @ x, square.T @ m, m.T @ square, x.T @ x)
                sums = np.stack([f[first, second] for f in full])
                found[key] = found.get(key, 0.0) + sums
        for key, sums in found.items():
            out = pd.DataFrame(dict(zip(fields, sums)))
            out.insert(0, "y", labels[second])
            out.insert(0, "x", labels[first])
            for k, v in zip(keys, key):
                out[k] = None if pd.isna(v) else v
            yield out[[*keys, "x", "y", *fields]]

    schema = ", ".join([*[f"{k} string" for k in keys], "x string", "y string", *[f"{f} double" for f in fields]])
    source = df.select(
        *[F.col(b).cast("string").alias(k) for b, k in zip(by, keys)], *[F.col(n).cast("double").alias(n) for n in names]
    )
    parts = source.mapInPandas(add, schema)
    sums = parts.groupBy(*keys, "x", "y").agg(*[F.sum(f).alias(f) for f in fields])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return sums.select(*[F.col(k).cast(kinds[b]).alias(b) for b, k in zip(by, keys)], "x", "y", *fields)


def _from_sums(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    n = F.col("n")
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    vx = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), n)
    vy = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)
    # what is left of a constant column after rounding is not variation
    flat = (vx <= F.lit(1e-12) * F.col("sxx")) | (vy <= F.lit(1e-12) * F.col("syy"))
    value = F.when(~flat, F.try_divide(cov, F.sqrt(vx * vy)))
    return sums.select(*by, "x", "y", value.alias("correlation"))


def numbers_only(df: DataFrame) -> DataFrame:
    """Text columns replaced by their 1-based level codes.

    Columns with few levels are coded in one projection, the others by a join with their levels; the codes are equal.
    """
    texts = columns.textual(df)
    wide = many_levels(df, texts)
    narrow = [n for n in texts if n not in wide]
    levels = level_lists(df, narrow)
    out = df.withColumns({n: code_of(F.col(n), levels[n]) for n in narrow})
    for n in wide:
        out = codes(out, n, levels_sorted(df, n)).withColumn(n, F.col(n).cast("double"))
    return out.select(*df.columns)


def correlation_with(df: DataFrame, target: str, order: bool = False, descending: bool = False) -> DataFrame:
    """Correlation of every other column with one target; text enters by level code."""
    coded = numbers_only(df)
    features = [c for c in columns.numeric(coded) if c != target]
    out = _long_stats(
        coded, {n: correlation(F.col(n), F.col(target)) for n in features}, "feature", "correlation"
    )
    if order:
        by = F.desc_nulls_last("correlation") if descending else F.asc_nulls_last("correlation")
        out = out.orderBy(by, "feature")
    return out


def correlation_labels(df: DataFrame, digits: int = 2, value: str = "correlation") -> DataFrame:
    """Rounded label and sign word for a correlation table."""
    return df.withColumns(
        {
            "label": half_even(F.col(value), digits),
            "direction": case_when([(F.col(value) >= 0, "Positive")], "Negative"),
        }
    )


def histogram(df: DataFrame, names: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """Equal-width bins per column: ``(key, bin, lower, upper, n)``; text enters by level code.

    Ranges come from one aggregate; the counts are one partial aggregate over
    (key, bin), so only ``columns x bins`` rows are shuffled per task.
    """
    df = df.select(*names) if names else df
    coded = numbers_only(df)
    names = columns.numeric(coded)
    limits = {}
    for n in names:
        x = F.col(n).cast("double")
        limits[f"lo_{n}"], limits[f"hi_{n}"] = F.min(x), F.max(x)
    edges = coded.agg(F.struct(*[c.alias(k) for k, c in limits.items()])).scalar()
    low = {n: edges[f"lo_{n}"] for n in names}
    width = {n: (edges[f"hi_{n}"] - edges[f"lo_{n}"]) / F.lit(bins) for n in names}
    cells = []
    for n in names:
        x = F.col(n).cast("double")
        place = F.coalesce(F.floor(F.try_divide(x - low[n], width[n])), F.lit(0))
        place = F.when(x.isNotNull(), F.least(place, F.lit(bins - 1)).cast("int"))
        cells.append(F.struct(F.lit(n).alias("key"), place.alias("bin")))
    long = coded.select(F.inline(F.array(*cells))).filter(F.col("bin").isNotNull())
    counts = long.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("n"))
    step = case_when([(F.col("key") == n, width[n]) for n in names])
    lower = case_when([(F.col("key") == n, low[n]) for n in names]) + F.col("bin") * step
    return counts.select("key", "bin", lower.alias("lower"), (lower + step).alias("upper"), "n")


def spread_by(df: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Count, mean and quartiles of numeric columns per group (the data of a violin chart)."""
    probs = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    found = quantiles(df, names, list(probs.values()), by)
    picks = [F.max(F.when(F.col("prob") == F.lit(p), F.col("value"))).alias(n) for n, p in probs.items()]
    out = found.groupBy(*by, "key").agg(*picks)
    cells = F.array(*[F.struct(F.lit(n).alias("key"), F.col(f"__a{i}").alias("s")) for i, n in enumerate(names)])
    means = df.groupBy(*by).agg(
        *[
            F.struct(F.count(n).alias("n"), F.avg(F.col(n).cast("double")).alias("mean")).alias(f"__a{i}")
            for i, n in enumerate(names)
        ]
    )
    means = means.select(*by, F.inline(cells)).select(*by, "key", F.col("s.n").alias("n"), F.col("s.mean").alias("mean"))
    return attach(out, means, [*by, "key"])


def pairs_summary(df: DataFrame, color: str) -> dict[str, DataFrame]:
    """The tables behind a pairs chart coloured by a class."""
    numbers = [c for c in columns.numeric(df) if c != color]
    texts = [c for c in columns.textual(df) if c != color]
    out = {}
    if numbers:
        out["correlation"] = correlation_matrix(df, numbers)
        out["correlation_by_class"] = correlation_matrix(df, numbers, [color])
        out["spread"] = spread_by(df, [color], numbers)
    if texts:
        cells = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in texts])
        long = df.select(color, F.inline(cells))
        out["counts"] = long.groupBy(color, "key", "value").agg(F.count(F.lit(1)).alias("n"))
    return out


def compare_classes(df: DataFrame, color: str, names: Sequence[str]) -> DataFrame:
    """Median and mean of each measure per class, side by side with the other rows' share."""
    counts = df.groupBy(color).agg(F.count(F.lit(1)).alias("n"))
    shares = share_within(counts, (), "n", "class_share").select(color, "class_share")
    return attach(spread_by(df, [color], names).select(color, "key", "n", "mean", "median"), shares, [color])


def themed(df: DataFrame, always: Sequence[str], patterns: Sequence[str]) -> DataFrame:
    """Columns that are always kept plus all whose name contains one of the patterns."""
    picked = list(always)
    for p in patterns:
        picked += [c for c in columns.containing(df, p) if c not in picked]
    return df.select(*picked)


def theme_correlations(df: DataFrame, target: str, themes: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """``(theme, feature, correlation)`` for the columns of all themes; a column may belong to several themes.

    The columns of all themes are correlated in one pass. A theme without columns has no rows.
    """
    members = {theme: [c for p in parts for c in columns.containing(df, p) if c != target] for theme, parts in (themes or THEMES).items()}
    wanted = list(dict.fromkeys(c for own in members.values() for c in own))
    if not wanted:
        return df.sparkSession.createDataFrame([], "theme string, feature string, correlation double")
    found = correlation_with(df.select(*wanted, target), target)
    listed = [(theme, c) for theme, own in members.items() for c in dict.fromkeys(own)]
    return attach(found, df.sparkSession.createDataFrame(listed, "theme string, feature string"), ["feature"]).select("theme", "feature", "correlation")


# Themes of the exploration and the name parts that select their columns.
THEMES = {
    "descriptive": ("Age", "Gender", "MaritalStatus", "NumCompaniesWorked", "Over18", "DistanceFromHome"),
    "employment": ("employee", "department", "job"),
    "compensation": ("income", "rate", "salary", "stock"),
    "survey": ("satisfaction", "life"),
    "performance": ("performance", "involvement"),
    "work_life": ("overtime", "travel"),
    "training": ("training", "education"),
    "time": ("years",),
}


def pair_points(df: DataFrame, x: str, y: str) -> DataFrame:
    """Points of a scatter chart with the title that names both columns."""
    return df.select(F.col(x).alias("x"), F.col(y).alias("y"), F.lit(f"{y} vs. {x}").alias("title"))
