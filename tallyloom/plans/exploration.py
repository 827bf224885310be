"""Column profiles, correlations, histograms, levels and class comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import density, dictionary, factors, flags, joins, profile, split
from ..sources.tables import literal_table
from .registration import Tables, query

NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    """
WITH cells AS (
  SELECT unnest(['o_orderstatus', 'o_orderpriority']) AS key, unnest([o_orderstatus, o_orderpriority]) AS value
  FROM orders WHERE o_orderstatus IS NOT NULL)
SELECT key, value, CAST(count(*) AS BIGINT) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY key), 8) AS share
FROM cells WHERE value IS NOT NULL GROUP BY key, value"""
)
def value_proportions(t: Tables):
    return profile.value_shares(t.orders).withColumn("share", F.round("share", 8))


@query(
    """
WITH s AS (SELECT l.*, q.quality, q.toxic FROM documents l LEFT JOIN labels q USING (doc_id))
SELECT key, CAST(n_values AS BIGINT) AS n_values FROM (
  SELECT unnest(['quality', 'toxic', 'n_chars', 'doc_id']) AS key,
         unnest([count(DISTINCT quality) + max(CAST(quality IS NULL AS INT)),
                 count(DISTINCT toxic) + max(CAST(toxic IS NULL AS INT)),
                 count(DISTINCT n_chars), count(DISTINCT doc_id)]) AS n_values FROM s)
WHERE n_values <= 10 ORDER BY n_values, key"""
)
def column_cardinality(t: Tables):
    df = joins.left_lookup(t.documents.drop("text"), t.labels, ["doc_id"])
    return profile.cardinality(df).filter(F.col("n_values") <= 10).orderBy("n_values", "key")


def _profile_sql(table: str, numbers, texts) -> str:
    parts = []
    for c in numbers:
        parts.append(
            f"SELECT '{c}' AS key, 'numeric' AS kind, count(*) AS n_rows, count(*) - count({c}) AS n_missing, "
            f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS sd, count(DISTINCT {c}) AS n_unique, "
            + ", ".join(
                f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS p{int(p * 100)}" for p in (0, 0.25, 0.5, 0.75, 1)
            )
            + f" FROM {table}"
        )
    for c in texts:
        parts.append(
            f"SELECT '{c}', 'character', count(*), count(*) - count({c}), NULL, NULL, count(DISTINCT {c}), "
            f"NULL, NULL, NULL, NULL, NULL FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


@query(
    "WITH t AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))\n"
    + _profile_sql("t", ("doc_id", "n_chars", "quality"), ("lang", "source"))
)
def column_profile(t: Tables):
    docs = t.documents.select("doc_id", "lang", "source", "n_chars")
    out = profile.column_profile(joins.left_lookup(docs, t.labels.select("doc_id", "quality")))
    return out.withColumns(
        {"mean": F.round("mean", 4), "sd": F.round("sd", 4)}
        | {p: F.round(p, 6) for p in ("p0", "p25", "p50", "p75", "p100")}
    )


def _skew(c: str) -> str:
    return f"avg(pow({c} - (SELECT avg({c}) FROM @), 3)) / pow(var_pop({c}), 1.5)"


def _skew_sql() -> str:
    parts = []
    for table, cols in (("lineitem", NUMBERS), ("documents", ("n_chars",)), ("events", ("value",))):
        for c in cols:
            parts.append(f"SELECT '{c}' AS key, round({_skew(c).replace('@', table)}, 5) AS skewness FROM {table}")
    return "SELECT * FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) WHERE skewness >= 0.7 AND key <> 'l_tax'"


@query(_skew_sql())
def skewed_columns(t: Tables):
    found = [
        profile.skewed_columns(df, 0.7, exclude=["l_tax"])
        for df in (t.lineitem.select(*NUMBERS), t.documents.select("n_chars"), t.events.select("value"))
    ]
    return joins.merge(found).withColumn("skewness", F.round("skewness", 5))


def _corr_sql(names) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
        for a in names
        for b in names
    )


@query(_corr_sql(NUMBERS))
def corr_matrix(t: Tables):
    found = profile.correlation_matrix(t.lineitem.select(*NUMBERS))
    return found.withColumn("correlation", F.round("correlation", 6))


@query(
    """
WITH coded AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_returnflag = 'R' AS DOUBLE) AS returned,
         dense_rank() OVER (ORDER BY l_linestatus) AS l_linestatus FROM lineitem),
c AS (
  SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'l_linestatus']) AS feature,
         unnest([corr(l_quantity, returned), corr(l_extendedprice, returned), corr(l_discount, returned),
                 corr(l_tax, returned), corr(l_linestatus, returned)]) AS correlation FROM coded)
SELECT feature, round(correlation, 6) AS correlation, round(correlation, 2) + 0.0 AS label,
       CASE WHEN correlation >= 0 THEN 'Positive' ELSE 'Negative' END AS direction FROM c"""
)
def corr_with_target(t: Tables):
    df = t.lineitem.select(*NUMBERS, "l_linestatus", (F.col("l_returnflag") == "R").cast("double").alias("returned"))
    found = profile.correlation_with(df, "returned", order=True, descending=True)
    return profile.correlation_labels(found).withColumns(
        {"correlation": F.round("correlation", 6), "label": F.col("label") + F.lit(0.0)}
    )


@query(
    """
SELECT key, o_orderstatus, round(correlation, 6) AS correlation FROM (
  SELECT o_orderstatus, 'o_custkey x o_totalprice' AS key, corr(o_custkey, o_totalprice) AS correlation
  FROM orders GROUP BY 1
  UNION ALL SELECT 'all', 'o_custkey x o_totalprice', corr(o_custkey, o_totalprice) FROM orders)"""
)
def pairs_correlation(t: Tables):
    tables = profile.pairs_summary(t.orders.select("o_orderstatus", "o_custkey", "o_totalprice"), "o_orderstatus")
    every = tables["correlation"].withColumn("o_orderstatus", F.lit("all"))
    both = tables["correlation_by_class"].unionByName(every).filter(F.col("x") < F.col("y"))
    return both.select(
        F.concat_ws(" x ", "x", "y").alias("key"), "o_orderstatus", F.round("correlation", 6).alias("correlation")
    )


@query(
    """
SELECT o_orderstatus, 'o_orderpriority' AS key, o_orderpriority AS value, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1, 3"""
)
def pairs_counts(t: Tables):
    return profile.pairs_summary(t.orders.select("o_orderstatus", "o_orderpriority"), "o_orderstatus")["counts"]


@query(
    """
SELECT o_orderstatus, 'o_totalprice' AS key, CAST(count(*) AS BIGINT) AS n, round(avg(o_totalprice), 4) AS mean,
       round(median(o_totalprice), 6) AS median, round(count(*) / sum(count(*)) OVER (), 8) AS class_share
FROM orders GROUP BY 1"""
)
def pairs_by_class(t: Tables):
    out = profile.compare_classes(t.orders, "o_orderstatus", ["o_totalprice"])
    return out.withColumns(
        {"mean": F.round("mean", 4), "median": F.round("median", 6), "class_share": F.round("class_share", 8)}
    )


@query(
    """
SELECT p_type, p_brand, CAST(count(*) AS BIGINT) AS n, round(avg(p_size), 6) AS mean, CAST(min(p_size) AS DOUBLE) AS min,
       quantile_cont(CAST(p_size AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(p_size AS DOUBLE), 0.5) AS median,
       quantile_cont(CAST(p_size AS DOUBLE), 0.75) AS q3, CAST(max(p_size) AS DOUBLE) AS max
FROM part GROUP BY 1, 2"""
)
def spread_by_category(t: Tables):
    out = profile.spread_by(t.part, ["p_type", "p_brand"], ["p_size"]).drop("key")
    return out.withColumn("mean", F.round("mean", 6))


@query(
    """
SELECT 'o_custkey' AS x_name, CAST(o_custkey AS BIGINT) AS x, o_totalprice AS y, 'o_totalprice vs. o_custkey' AS title
FROM orders"""
)
def scatter_points(t: Tables):
    return profile.pair_points(t.orders, "o_custkey", "o_totalprice").withColumn("x_name", F.lit("o_custkey"))


def _hist_sql() -> str:
    parts = []
    for c in NUMBERS:
        parts.append(
            f"SELECT '{c}' AS key, CAST(least(floor(({c} - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, "
            f"CAST(count(*) AS BIGINT) AS n, round(min(lo) + least(floor(({c} - lo) / ((hi - lo) / 10)), 9) * (min(hi) - min(lo)) / 10, 4)"
            f" AS lower FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem)"
            f" GROUP BY bin, least(floor(({c} - lo) / ((hi - lo) / 10)), 9)"
        )
    flag = (
        "SELECT 'l_returnflag', CAST(least(floor((c - 1) / 0.2), 9) AS INTEGER), CAST(count(*) AS BIGINT), "
        "round(1 + 0.2 * least(floor((c - 1) / 0.2), 9), 4) FROM "
        "(SELECT dense_rank() OVER (ORDER BY l_returnflag) AS c FROM lineitem) GROUP BY c"
    )
    return "\nUNION ALL\n".join([*parts, flag])


@query(_hist_sql())
def histograms(t: Tables):
    out = profile.histogram(t.lineitem, [*NUMBERS, "l_returnflag"], bins=10)
    return out.select("key", "bin", "n", F.round("lower", 4).alias("lower"))


@query(
    """
SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) AS INTEGER) AS brand_code FROM part"""
)
def level_codes(t: Tables):
    part = t.part.select("p_partkey", "p_brand")
    return factors.codes(part, "p_brand", factors.levels_sorted(part, "p_brand"), "brand_code")


@query(
    """
WITH f AS (SELECT o_orderpriority AS level, min(o_orderkey) AS k FROM orders GROUP BY 1),
seen AS (SELECT level, row_number() OVER (ORDER BY k) AS seen FROM f),
sorted AS (SELECT level, row_number() OVER (ORDER BY level) AS sorted FROM f),
front AS (SELECT level, row_number() OVER (ORDER BY CASE level WHEN '5-LOW' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END, level)
          AS front FROM f)
SELECT level, CAST(seen AS INTEGER) AS seen, CAST(sorted AS INTEGER) AS sorted, CAST(front AS INTEGER) AS front,
       CAST(6 - sorted AS INTEGER) AS backwards
FROM seen JOIN sorted USING (level) JOIN front USING (level)"""
)
def relevel(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    by_text = factors.levels_sorted(orders, "o_orderpriority")
    tables = {
        "seen": factors.levels_first_seen(orders, "o_orderpriority", "o_orderkey"),
        "sorted": by_text,
        "front": factors.relevel(by_text, ["5-LOW", "2-HIGH"]),
        "backwards": factors.reverse(by_text),
    }
    return joins.bind([d.withColumnRenamed("code", n) for n, d in tables.items()], ["level"])


@query(
    """
WITH s AS (SELECT o_orderpriority AS level, median(o_totalprice) AS m, max(o_totalprice) AS h, avg(o_totalprice) AS a
           FROM orders GROUP BY 1)
SELECT level, CAST(row_number() OVER (ORDER BY m, level) AS INTEGER) AS by_median,
       CAST(row_number() OVER (ORDER BY h DESC, level) AS INTEGER) AS by_max_down,
       CAST(row_number() OVER (ORDER BY a, level) AS INTEGER) AS by_mean, round(m, 6) AS median
FROM s"""
)
def reorder_levels(t: Tables):
    orders = t.orders.select("o_orderpriority", "o_totalprice")
    median = factors.levels_by(orders, "o_orderpriority", "o_totalprice", "median")
    largest = factors.levels_by(orders, "o_orderpriority", "o_totalprice", "max", descending=True)
    mean = factors.levels_by(orders, "o_orderpriority", "o_totalprice", "mean")
    return joins.bind(
        [
            median.select("level", F.col("code").alias("by_median"), F.round("median", 6).alias("median")),
            largest.select("level", F.col("code").alias("by_max_down")),
            mean.select("level", F.col("code").alias("by_mean")),
        ],
        ["level"],
    )


# The code book of the test tables in sheet form: the column name stands on the first row of its block only.
CODE_BOOK = (
    (1, "c_nationkey", "0 'Nation zero'"),
    (2, None, "1 'Nation one'"),
    (3, None, "2 'Owner's nation'"),
    (4, None, None),
    (5, "o_shippriority", "1 'Unused'"),
    (6, "o_linecount", "1 'Single'"),
    (7, None, "2 'Double'"),
    (8, None, "x 'Broken'"),
    (9, None, "3 'Triple'"),
)


@query(
    """
WITH c AS (SELECT o.o_orderkey, o.o_orderpriority, c.c_nationkey, 1 + o.o_orderkey % 5 AS o_linecount
           FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT o_orderkey, o_orderpriority,
       CASE c_nationkey WHEN 0 THEN 'Nation zero' WHEN 1 THEN 'Nation one' WHEN 2 THEN 'Owners nation''' END AS c_nationkey,
       CASE o_linecount WHEN 1 THEN 'Single' WHEN 2 THEN 'Double' WHEN 3 THEN 'Triple' END AS o_linecount
FROM c"""
)
def dictionary_decode(t: Tables):
    sheet = literal_table(t.spark, CODE_BOOK, "position int, name string, entry string")
    book = dictionary.parse_dictionary(sheet, "name", "entry", "position")
    orders = t.orders.select(
        "o_orderkey", "o_orderpriority", "o_custkey", (F.col("o_orderkey") % 5 + 1).alias("o_linecount")
    )
    customer = t.customer.select("c_custkey", "c_nationkey")
    lines = joins.left_lookup(orders, customer, {"o_custkey": "c_custkey"}).drop("o_custkey")
    return dictionary.readable(lines, book)


# Words of the part names as rules; one of them excludes a following word.
PART_RULES = {"red": "red", "ring": "ring", "large not rod": "large(?! rod)", "hot or cold": "hot |cold ", "widget": "widget"}


@query(
    """
SELECT p_partkey, p_name, CAST(lower(p_name) LIKE '%red%' AS DOUBLE) AS red,
       CAST(lower(p_name) LIKE '%ring%' AS DOUBLE) AS ring,
       CAST(lower(p_name) LIKE '%large%' AND lower(p_name) NOT LIKE '%large rod%' AS DOUBLE) AS "large not rod",
       CAST(lower(p_name) LIKE '%hot %' OR lower(p_name) LIKE '%cold %' AS DOUBLE) AS "hot or cold",
       CAST(lower(p_name) LIKE '%widget%' AS DOUBLE) AS widget
FROM part"""
)
def keyword_flags(t: Tables):
    return flags.keyword_flags(t.part.select("p_partkey", "p_name"), "p_name", PART_RULES)


@query(
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%a') AS dow, strftime(o_orderdate, '%b') AS month
FROM orders"""
)
def date_features(t: Tables):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", day.cast("date").alias("day"), dates.weekday_label(day).alias("dow"), dates.month_label(day).alias("month")
    )


@query(
    """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
cal AS (SELECT d, year(d) AS y, month(d) AS m, day(d) AS n, dayofweek(d) AS w FROM (SELECT DISTINCT d FROM o)),
nth AS (SELECT *, (n - 1) // 7 + 1 AS k, month(d + INTERVAL 7 DAY) <> m AS is_last FROM cal)
SELECT o_orderkey, CAST(m = 1 AND n = 1 AS INT) AS "NewYearsDay", CAST(m = 7 AND n = 4 AS INT) AS "IndependenceDay",
       CAST(m = 12 AND n = 25 AS INT) AS "ChristmasDay", CAST(m = 1 AND w = 1 AND k = 3 AS INT) AS "MLKingsBirthday",
       CAST(m = 5 AND w = 1 AND is_last AS INT) AS "MemorialDay", CAST(m = 9 AND w = 1 AND k = 1 AS INT) AS "LaborDay",
       CAST(m = 11 AND w = 4 AND k = 4 AS INT) AS "ThanksgivingDay",
       CAST(m = 11 AND w = 2 AND n BETWEEN 2 AND 8 AS INT) AS "ElectionDay",
       CAST(d IN (DATE '1992-04-17', DATE '1993-04-09', DATE '1994-04-01', DATE '1995-04-14', DATE '1996-04-05',
                  DATE '1997-03-28', DATE '1998-04-10', DATE '1999-04-02', DATE '2000-04-21', DATE '2001-04-13',
                  DATE '2002-03-29') AS INT) AS "GoodFriday",
       CAST(m = 1 AND n = 20 AND y % 4 = 1 AS INT) AS "InaugurationDay", CAST(m = 2 AND n = 12 AS INT) AS "LincolnsBirthday",
       CAST(m = 2 AND n = 22 AS INT) AS "WashingtonsBirthdayTraditional", CAST(m = 6 AND n = 19 AS INT) AS "Juneteenth",
       CAST(m = 11 AND n = 11 AS INT) AS "VeteransDay", CAST(m = 2 AND w = 1 AND k = 3 AS INT) AS "PresidentsDay",
       CAST(m = 10 AND w = 1 AND k = 2 AS INT) AS "ColumbusDay"
FROM o JOIN nth USING (d)"""
)
def holiday_flags(t: Tables):
    found = dates.holiday_flags(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in found.items()])


@query(
    f"""
WITH d AS (SELECT o_orderkey, {split.draw_sql('o_orderkey')} AS a, {split.draw_sql('o_orderkey', 1)} AS b FROM orders)
SELECT o_orderkey, CASE WHEN a < 0.85 THEN 'train' ELSE 'test' END AS split,
       CASE WHEN a < 0.85 THEN CASE WHEN b < 0.8 THEN 'train' ELSE 'valid' END END AS second_split FROM d"""
)
def hash_split(t: Tables):
    df = split.split(t.orders.select("o_orderkey"), "o_orderkey", 0.85)
    df = split.split(df, "o_orderkey", 0.8, salt=1, name="second_split", parts=("train", "valid"))
    return df.withColumn("second_split", F.when(F.col("split") == "train", F.col("second_split")))


@query(
    f"""
WITH d AS (SELECT c_custkey, c_mktsegment, {split.draw_sql('c_custkey')} AS a FROM customer),
p AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY a, c_custkey) AS pos,
             count(*) OVER (PARTITION BY c_mktsegment) AS n FROM d)
SELECT c_custkey, c_mktsegment, CASE WHEN pos <= floor(n * 0.75) THEN 'train' ELSE 'test' END AS split FROM p"""
)
def strata_split(t: Tables):
    return split.split_exact(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", 0.75, by=["c_mktsegment"])


@query("SELECT c_mktsegment, CAST(2 AS BIGINT) AS n_parts, true AS in_both FROM customer GROUP BY 1")
def strata_coverage(t: Tables):
    parts = split.split_exact(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", 0.75, by=["c_mktsegment"])
    return split.strata_coverage(parts, "c_mktsegment")


@query(
    f"""
SELECT CAST(floor({split.draw_sql('o_orderkey')} * 5) AS INTEGER) AS fold, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1"""
)
def fold_counts(t: Tables):
    return split.folds(t.orders.select("o_orderkey"), "o_orderkey", 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
SELECT feature, round(correlation, 6) AS correlation FROM (
  SELECT 'l_discount' AS feature, corr(l_discount, CAST(l_returnflag = 'R' AS DOUBLE)) AS correlation FROM lineitem
  UNION ALL SELECT 'l_tax', corr(l_tax, CAST(l_returnflag = 'R' AS DOUBLE)) FROM lineitem)"""
)
def themed_correlation(t: Tables):
    """One theme of columns, chosen by parts of their names, against the target."""
    df = t.lineitem.withColumn("returned", (F.col("l_returnflag") == "R").cast("double"))
    found = profile.correlation_with(profile.themed(df, ["returned"], ["DISC", "tax"]), "returned", order=True)
    return found.withColumn("correlation", F.round("correlation", 6))


_THEMES = {
    "money": ("price", "discount"), "tax": ("tax",), "amount": ("quantity",), "position": ("linenumber",),
    "part": ("part",), "supplier": ("supp",), "order": ("order",), "all_l": ("l_",),
}


@query(
    "WITH d AS (SELECT *, CAST(l_returnflag = 'R' AS DOUBLE) AS returned FROM lineitem), c AS (\n"
    + "\nUNION ALL ".join(
        f"SELECT '{theme}' AS theme, '{c}' AS feature, corr({c}, returned) AS correlation FROM d"
        for theme, own in {
            "money": ("l_extendedprice", "l_discount"), "tax": ("l_tax",), "amount": ("l_quantity",), "position": ("l_linenumber",),
            "part": ("l_partkey",), "supplier": ("l_suppkey",), "order": ("l_orderkey",),
            "all_l": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"),
        }.items() for c in own
    )
    + ") SELECT theme, feature, round(correlation, 6) AS correlation FROM c"
)
def theme_correlations(t: Tables):
    """Eight themes of columns against one target, in one pass."""
    numbers = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    df = t.lineitem.select(*numbers, (F.col("l_returnflag") == "R").cast("double").alias("returned"))
    found = profile.theme_correlations(df, "returned", _THEMES)
    return found.withColumn("correlation", F.round("correlation", 6))


def _density_sql(columns: tuple[str, ...], points: int) -> str:
    values = "\nUNION ALL ".join(f"SELECT l_returnflag, '{c}' AS key, CAST({c} AS DOUBLE) AS v FROM lineitem" for c in columns)
    return f"""
WITH v AS ({values}),
g AS (SELECT key, min(v) AS low, max(v) AS high, (max(v) - min(v)) / {points - 1} AS step FROM v GROUP BY key),
s AS (SELECT l_returnflag, key, count(v) AS n, 1.06 * stddev_samp(v) * pow(count(v), -0.2) AS h FROM v GROUP BY ALL HAVING stddev_samp(v) > 0),
b AS (SELECT l_returnflag, key, least(floor((v - low) / step), {points - 2}) AS i, (v - low) / step AS a FROM v JOIN g USING (key)),
c AS (SELECT l_returnflag, key, i, sum(w) AS w FROM (
        SELECT l_returnflag, key, i, 1 - (a - i) AS w FROM b UNION ALL SELECT l_returnflag, key, i + 1, a - i FROM b) GROUP BY ALL),
p AS (SELECT unnest(range({points})) AS j)
SELECT l_returnflag, key, CAST(n AS BIGINT) AS n, round(low + j * step, 4) AS x,
       round(sum(w * exp(-0.5 * pow((j - i) * step / h, 2))) / (n * h * sqrt(2 * pi())) * (high - low), 8) AS density
FROM c JOIN s USING (l_returnflag, key) JOIN g USING (key), p GROUP BY l_returnflag, key, n, h, low, high, step, j"""


@query(_density_sql(("l_quantity", "l_extendedprice", "l_discount"), density.POINTS))
def class_densities(t: Tables):
    """Kernel densities of three measures per return flag, scaled by the range of the measure."""
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    found = density.class_densities(t.lineitem, names, "l_returnflag")
    spans = t.lineitem.select(F.explode(F.array(*[F.struct(F.lit(n).alias("__key"), F.col(n).cast("double").alias("v")) for n in names])).alias("c"))
    spans = spans.groupBy(F.col("c.__key").alias("__key")).agg((F.max("c.v") - F.min("c.v")).alias("span"))
    met = found.join(spans, F.col("key") == F.col("__key"))
    return met.select("l_returnflag", "key", "n", F.round("x", 4).alias("x"), F.round(F.col("density") * F.col("span"), 8).alias("density"))
