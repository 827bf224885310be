"""Joins, filters, shares, windows and reshaping over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.money import money, turnover_cost
from ..functions.nulls import case_when, half_even, if_else, is_in, ratio, strict
from ..functions.text import first_match, join_text, piece, replace_first, template
from ..operators import aggregates, binning, columns, joins, kpi, ordering, quantiles, reshape, rows
from ..session import kept, scratch_path
from ..sources import tables as src
from .registration import Tables, query

# No user can have more daily rows than 10,000 years have days.
CALENDAR_DAYS = 3_660_000



@query(
    """
WITH base AS (
  SELECT c.c_mktsegment, o.o_orderpriority, o.o_orderstatus, count(*) AS n
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3),
shares AS (
  SELECT *, n / sum(n) OVER (PARTITION BY c_mktsegment, o_orderpriority) AS share FROM base),
kept AS (
  SELECT c_mktsegment, o_orderpriority, o_orderstatus, n, share,
         CASE WHEN share > 0.33 THEN 'Yes' ELSE 'No' END AS above_baseline,
         n * (500 + 10000 + 4900 + 3500 + 250000 / 240.0 * (40 + 60 * 0.5) - 80000 / 240.0 * 40) AS cost
  FROM shares WHERE o_orderstatus = 'F')
SELECT c_mktsegment, o_orderpriority, o_orderstatus, CAST(n AS BIGINT) AS n, round(share, 8) AS share,
       above_baseline, round(cost, 2) AS cost,
       c_mktsegment || ': ' || o_orderpriority AS name,
       '$' || printf('%.2f', cost / 1e6) || 'M' AS cost_text,
       row_number() OVER (ORDER BY cost, c_mktsegment || ': ' || o_orderpriority) AS bar
FROM kept"""
)
def kpi_status_share(t: Tables):
    lines = joins.left_lookup(t.orders, t.customer, {"o_custkey": "c_custkey"})
    rated = kpi.outcome_kpi(lines, ["c_mktsegment", "o_orderpriority"], "o_orderstatus", "F", baseline=0.33)
    bars = kpi.labelled_bars(rated, ["c_mktsegment", "o_orderpriority"], "cost", "M")
    return bars.select(
        "c_mktsegment", "o_orderpriority", "o_orderstatus", "n", F.round("share", 8).alias("share"), "above_baseline",
        F.round("cost", 2).alias("cost"), "name", money(F.col("cost"), 2, "M").alias("cost_text"),
        F.col("bar").cast("long").alias("bar"),
    ).orderBy("bar")


@query(
    """
WITH c AS (SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 0) AS cost FROM lineitem GROUP BY 1, 2),
d AS (SELECT *, max(abs(cost / 1000)) OVER () <= 1000 AND bool_or(cost / 1000 <> floor(cost / 1000)) OVER () AS cents
      FROM c)
SELECT l_returnflag || ': ' || l_linestatus AS name, cost,
       '$' || CASE WHEN cents THEN format('{:,.2f}', cost / 1000) ELSE format('{:,.0f}', cost / 1000) END || 'K'
         AS value_text,
       row_number() OVER (ORDER BY cost DESC, l_returnflag || ': ' || l_linestatus) AS bar
FROM d"""
)
def labelled_bars(t: Tables):
    cost = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_extendedprice"), 0).alias("cost"))
    bars = kpi.labelled_bars(cost, ["l_returnflag", "l_linestatus"], "cost", "K", reverse=True)
    return bars.select("name", "cost", "value_text", F.col("bar").cast("long").alias("bar"))


@query(
    """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
       p.p_name, p.p_brand, p.p_type, p.p_retailprice, s.s_name, n.n_name
FROM lineitem l
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey"""
)
def orderlines_star(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    supplier = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    nation = t.nation.select("n_nationkey", "n_name")
    out = joins.lookup_chain(
        lines,
        [
            (part, {"l_partkey": "p_partkey"}),
            (supplier, {"l_suppkey": "s_suppkey"}),
            (nation, {"s_nationkey": "n_nationkey"}),
        ],
    )
    return out.drop("s_nationkey")


@query(
    """
SELECT l_linestatus AS status, l_shipdate AS shipped, l_discount AS discount_pct, l_extendedprice AS line_price,
       l_quantity AS line_quantity, l_returnflag AS returnflag, l_tax AS tax_pct
FROM lineitem"""
)
def column_selection(t: Tables):
    df = t.lineitem
    picked = columns.between(df, "l_quantity", "l_tax") + columns.textual(df) + columns.containing(df, "SHIP")
    df = df.select(*picked)
    df = columns.rename(df, {"l_quantity": "l_line quantity", "l_extendedprice": "l_line-price"})
    df = columns.rename_by_pattern(columns.safe_names(df), "^l_", "")
    df = columns.rename(df, {"linestatus": "status", "shipdate": "shipped"})
    df = columns.rename_by_pattern(df, "^(discount|tax)$", r"\1_pct")
    return columns.move_first(columns.sort_columns(df), "status")


@query(
    """
SELECT d.doc_id, d.lang, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic,
       coalesce(CASE WHEN d.source = 'src3' THEN NULL ELSE d.source END, '-1') AS source,
       coalesce(l.quality, 0) AS quality_or_zero,
       CASE WHEN l.quality IS NULL THEN NULL WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS verdict,
       CASE WHEN l.quality = 1 THEN 'good' ELSE 'other' END AS verdict_or_other,
       l.quality IS NOT NULL AND l.toxic IS NOT NULL AND d.source <> 'src3' AS complete
FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def null_handling(t: Tables):
    docs = t.documents.select("doc_id", "lang", "source").withColumn("source", F.nullif("source", F.lit("src3")))
    sparse = joins.left_lookup(docs, t.labels, ["doc_id"])
    marked = sparse.withColumns(
        {
            "verdict": if_else(F.col("quality") == 1, "good", "bad"),
            "verdict_or_other": case_when([(F.col("quality") == 1, "good")], "other"),
            "complete": rows.is_complete(sparse),
            "quality_or_zero": F.col("quality"),
        }
    )
    zero = rows.fill_numbers(marked, 0, ["quality_or_zero"])
    return rows.fill_everything(zero, -1, ["lang", "quality", "toxic", "source"])


@query(
    """
SELECT count(*) AS n_rows,
       CAST(sum(quality) AS BIGINT) AS sum_known,
       CAST(CASE WHEN count(*) = count(quality) THEN sum(quality) END AS BIGINT) AS sum_strict,
       CAST(count(*) FILTER (WHERE coalesce(quality IN (0), false)) AS BIGINT) AS n_bad,
       CAST(count(*) FILTER (WHERE NOT coalesce(quality IN (0), false)) AS BIGINT) AS n_not_bad,
       lang
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang"""
)
def strict_aggregates(t: Tables):
    sparse = joins.left_lookup(t.documents.select("doc_id", "lang"), t.labels.select("doc_id", "quality"))
    quality = F.col("quality")
    return sparse.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(quality).alias("sum_known"),
        strict(F.sum(quality), quality).alias("sum_strict"),
        aggregates.count_if(is_in(quality, [0])).alias("n_bad"),
        aggregates.count_if(~is_in(quality, [0])).alias("n_not_bad"),
    )


@query(
    """
SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position, o_orderkey, o_custkey, o_totalprice,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS position_of_customer
FROM orders"""
)
def row_positions(t: Tables):
    df = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    down = [-F.col("o_totalprice"), "o_orderkey"]
    placed = rows.numbered(df, down, "position")
    return rows.numbered(placed, down, "position_of_customer", by=["o_custkey"])


@query(
    """
SELECT o_orderkey, o_orderpriority, o_orderdate,
       row_number() OVER (ORDER BY o_orderpriority DESC, o_orderdate DESC, o_orderkey) AS position,
       row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC, o_orderkey) AS position_of_status
FROM orders"""
)
def latest_positions(t: Tables):
    df = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus")
    placed = rows.numbered(df, [ordering.down("o_orderpriority"), ordering.down("o_orderdate"), "o_orderkey"], "position")
    latest = [ordering.down("o_orderdate"), "o_orderkey"]
    return rows.numbered(placed, latest, "position_of_status", by=["o_orderstatus"]).drop("o_orderstatus")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_orders(t: Tables):
    df = t.orders.select("o_orderkey", "o_totalprice")
    return rows.top(df, [F.desc("o_totalprice"), F.col("o_orderkey")], 20)


@query(
    """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1 OFFSET 4"""
)
def row_at_position(t: Tables):
    df = t.orders.select("o_orderkey", "o_totalprice")
    return rows.row_at(df, [F.desc("o_totalprice"), F.col("o_orderkey")], 5)


@query(
    """
SELECT p_brand, p_partkey, p_retailprice FROM part
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 3"""
)
def top_per_brand(t: Tables):
    df = t.part.select("p_brand", "p_partkey", "p_retailprice")
    return rows.top_within(df, ["p_brand"], [-F.col("p_retailprice"), "p_partkey"], 3)


@query(
    """
SELECT DISTINCT 'orders.' || key AS key, value FROM (
  SELECT unnest(['o_orderstatus', 'o_orderpriority']) AS key, unnest([o_orderstatus, o_orderpriority]) AS value
  FROM orders)
UNION ALL
SELECT DISTINCT 'part.' || key, value FROM (
  SELECT unnest(['p_name', 'p_brand', 'p_type']) AS key, unnest([p_name, p_brand, p_type]) AS value FROM part)"""
)
def distinct_values(t: Tables):
    def named(df, table):
        return rows.distinct_texts(df).withColumn("key", F.concat(F.lit(table), "key"))

    return named(t.orders, "orders.").unionByName(named(t.part, "part."))


@query(
    """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"""
)
def data_carry_bind(t: Tables):
    key = ["p_partkey"]
    parts = joins.carry_key(t.part, key, ["p_name", "p_brand"], ["p_type"], ["p_size", "p_retailprice"])
    whole = joins.bind(parts, key)
    whole = kept(whole, "parts")  # it is read once per type
    by_type = joins.split_by(whole, "p_type")
    return joins.merge(list(by_type.values()))


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       l_extendedprice / nullif(l_quantity, 0) AS unit_price,
       CASE WHEN l_discount >= 0.08 THEN 'high' WHEN l_discount >= 0.03 THEN 'medium' ELSE 'low' END AS discount_band,
       CASE WHEN l_discount - 0.05 >= 0 THEN 'Positive' ELSE 'Negative' END AS direction,
       CAST(round(l_tax * 100) % 2 = 0 AS DOUBLE) AS even_tax,
       round(sqrt(l_quantity) + pow(l_discount, 2) + abs(l_tax - 0.04), 8) AS mixed,
       CAST(l_linenumber AS VARCHAR) AS line_text,
       CAST(l_returnflag = 'R' AS INTEGER) AS returned
FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_shipdate >= DATE '1995-01-01' AND l_quantity > 5"""
)
def cast_filter_membership(t: Tables):
    df = t.lineitem.filter(
        is_in(F.col("l_returnflag"), ["A", "R"])
        & (F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp"))
        & (F.col("l_quantity") > 5)
    )
    discount, tax = F.col("l_discount"), F.col("l_tax")
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        ratio(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        case_when([(discount >= 0.08, "high"), (discount >= 0.03, "medium")], "low").alias("discount_band"),
        case_when([(discount - 0.05 >= 0, "Positive")], "Negative").alias("direction"),
        if_else(half_even(tax * 100) % 2 == 0, F.lit(1.0), F.lit(0.0)).alias("even_tax"),
        F.round(F.sqrt("l_quantity") + F.pow(discount, F.lit(2)) + F.abs(tax - 0.04), 8).alias("mixed"),
        F.col("l_linenumber").cast("string").alias("line_text"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
    )


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(t: Tables):
    path = scratch_path(t.spark, "csv")
    src.write_table(t.customer, path, "csv")
    return src.read_csv(t.spark, path, t.customer.schema)


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sheet_round_trip(t: Tables):
    """Orders exported as a page of text cells below a title and a header row."""
    path = scratch_path(t.spark, "sheet")
    names = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    cells = t.orders.select(*[F.col(c).cast("string") for c in names])
    head = src.literal_table(t.spark, [("Orders", None, None), tuple(names)], cells.schema)
    head.unionByName(cells).write.option("header", False).csv(path)
    return src.read_sheet(t.spark, path, names, t.orders.select(*names).schema, header_cell="o_orderkey")


@query(
    """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1"""
)
def saved_table_round_trip(t: Tables):
    path = scratch_path(t.spark, "saved")
    src.write_table(t.orders, path, "parquet", partition_by=["o_orderstatus"])
    saved = src.read_saved(t.spark, path, ["o_orderstatus", "o_totalprice"])
    return saved.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    """
WITH late AS (
  SELECT l.l_partkey, l.l_suppkey, l.l_quantity,
         CASE WHEN l.l_shipdate IS NULL OR o.o_orderdate IS NULL THEN NULL
              WHEN date_diff('day', o.o_orderdate, l.l_shipdate) >= 30 THEN 'late' ELSE 'on_time' END AS arrival
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
pairs AS (SELECT l_partkey, l_suppkey, avg(l_quantity) AS mean_quantity FROM lineitem GROUP BY 1, 2)
SELECT arrival, CAST(count(*) AS BIGINT) AS n, round(avg(l_quantity - mean_quantity), 4) AS mean_deviation,
       round(count(*) / sum(count(*)) OVER (), 8) AS share
FROM late JOIN pairs USING (l_partkey, l_suppkey) WHERE arrival IS NOT NULL GROUP BY arrival"""
)
def composite_inner_join(t: Tables):
    line = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    delay = F.date_diff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    pair = ["l_partkey", "l_suppkey"]
    # lines are shuffled once on the order and once, added up, on the pair; a pair has three rows at most from there on
    late = joins.left_lookup(line, orders, ["l_orderkey"]).withColumn("arrival", if_else(delay >= 30, "late", "on_time"))
    sums = late.groupBy(*pair, "arrival").agg(
        F.count(F.lit(1)).alias("rows"), F.count("l_quantity").alias("known"), F.sum("l_quantity").alias("total")
    )
    pairs = sums.groupBy(*pair).agg((F.sum("total") / F.sum("known")).alias("mean_quantity"))
    both = rows.complete_cases(joins.matching(sums, pairs, pair))
    gap = F.sum(F.col("total") - F.col("known") * F.col("mean_quantity"))
    counts = both.groupBy("arrival").agg(
        F.sum("rows").alias("n"), F.round(gap / F.sum("known"), 4).alias("mean_deviation")
    )
    return aggregates.share_within(counts, few=True).withColumn("share", F.round("share", 8))


CUSTOMER_TRENDS = """
WITH lines AS (
  SELECT n.n_name AS store, p.p_partkey, p.p_type, p.p_brand,
         CASE WHEN p.p_brand IS NULL THEN NULL WHEN p.p_brand = 'Brand#1' THEN 'no' ELSE 'yes' END AS branded,
         p.p_retailprice, l.l_quantity
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey)
"""


def _store_lines(t: Tables):
    line = t.lineitem.select("l_partkey", "l_suppkey", "l_quantity")
    part = t.part.select("p_partkey", "p_type", "p_brand", "p_retailprice")
    supplier = t.supplier.select("s_suppkey", "s_nationkey")
    nation = t.nation.select("n_nationkey", F.col("n_name").alias("store"))
    lines = joins.lookup_chain(
        line,
        [
            (part, {"l_partkey": "p_partkey"}),
            (supplier, {"l_suppkey": "s_suppkey"}),
            (nation, {"s_nationkey": "n_nationkey"}),
        ],
    )
    return lines.withColumn("branded", if_else(F.col("p_brand") == "Brand#1", "no", "yes"))


@query(
    CUSTOMER_TRENDS
    + """
SELECT store, p_type, branded, CAST(sum(l_quantity) AS DOUBLE) AS quantity,
       round(sum(l_quantity) / sum(sum(l_quantity)) OVER (PARTITION BY store), 8) AS share
FROM lines GROUP BY store, p_type, branded"""
)
def segment_part_share(t: Tables):
    sums = aggregates.sum_by(_store_lines(t), ["store", "p_type", "branded"], quantity="l_quantity")
    return aggregates.share_within(sums, ["store"], "quantity").withColumn("share", F.round("share", 8))


@query(
    f"""
WITH q AS (
  SELECT c.c_mktsegment, p.p_type, sum(l.l_quantity) AS quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2),
s AS (SELECT c_mktsegment, p_type, round(quantity / sum(quantity) OVER (PARTITION BY c_mktsegment), 8) AS share FROM q)
PIVOT (SELECT c_mktsegment, coalesce(p_type, 'NA') AS p_type, share FROM s) ON p_type USING coalesce(max(share), 0) GROUP BY c_mktsegment"""
)
def user_item_pivot(t: Tables):
    line = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("p_partkey"), "l_quantity")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    customer = t.customer.select("c_custkey", "c_mktsegment")
    lines = joins.matching(joins.matching(line, orders, ["l_orderkey"]), customer, ["c_custkey"])
    lines = joins.matching(lines, t.part.select("p_partkey", "p_type"), ["p_partkey"])
    sums = aggregates.sum_by(lines, ["c_mktsegment", "p_type"], quantity="l_quantity")
    shares = aggregates.share_within(sums, ["c_mktsegment"], "quantity").withColumn("share", F.round("share", 8))
    return reshape.widen(shares, ["c_mktsegment"], "p_type", "share", fill=0.0)


@query(
    """
WITH q AS (SELECT quantile_cont(p_retailprice, [0.33, 0.66]) AS c FROM part)
SELECT CASE WHEN p_retailprice <= c[1] THEN 'low' WHEN p_retailprice <= c[2] THEN 'medium' ELSE 'high' END AS price_bin,
       CAST(count(*) AS BIGINT) AS n, min(p_retailprice) AS lowest, max(p_retailprice) AS highest
FROM part, q GROUP BY 1"""
)
def price_bins(t: Tables):
    binned = binning.bin_by_quantile(t.part.select("p_retailprice"), "p_retailprice", "price_bin")
    return binned.groupBy("price_bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("p_retailprice").alias("lowest"), F.max("p_retailprice").alias("highest")
    )


@query(
    """
SELECT key, CAST(prob AS DOUBLE) AS prob, round(value, 6) AS value FROM (
  SELECT 'o_totalprice' AS key, unnest([0, 0.33, 0.66, 1]) AS prob,
         unnest(quantile_cont(o_totalprice, [0, 0.33, 0.66, 1])) AS value FROM orders
  UNION ALL
  SELECT 'o_custkey', unnest([0, 0.33, 0.66, 1]), unnest(quantile_cont(CAST(o_custkey AS DOUBLE), [0, 0.33, 0.66, 1]))
  FROM orders)"""
)
def exact_quantiles(t: Tables):
    df = t.orders.select("o_totalprice", "o_custkey")
    found = quantiles.quantiles(df, ["o_totalprice", "o_custkey"], binning.PRICE_PROBS)
    return found.withColumn("value", F.round("value", 6))


_TREND_SQL = """
, trends AS (
  SELECT p_brand AS cluster, p_type, branded,
         CASE WHEN p_retailprice <= 932.967 THEN 'low' WHEN p_retailprice <= 965.934 THEN 'medium' ELSE 'high' END
           AS price_bin, sum(l_quantity) AS quantity
  FROM lines GROUP BY 1, 2, 3, 4),
shares AS (SELECT *, quantity / sum(quantity) OVER (PARTITION BY cluster) AS share FROM trends)
"""


def _trends(t: Tables):
    lines = _store_lines(t).withColumn(
        "price_bin", binning.bin_by(F.col("p_retailprice"), (932.967, 965.934), binning.PRICE_LABELS)
    )
    lines = lines.withColumnRenamed("p_brand", "cluster")
    sums = aggregates.sum_by(lines, ["cluster", "p_type", "branded", "price_bin"], quantity="l_quantity")
    return aggregates.share_within(sums, ["cluster"], "quantity")


@query(
    CUSTOMER_TRENDS
    + _TREND_SQL
    + "SELECT cluster, p_type, branded, price_bin, CAST(quantity AS DOUBLE) AS quantity, round(share, 8) AS share FROM shares"
)
def cluster_trends(t: Tables):
    return _trends(t).withColumn("share", F.round("share", 8))


@query(
    CUSTOMER_TRENDS
    + _TREND_SQL
    + """
SELECT cluster, p_type, price_bin, round(share, 8) AS share,
       round(sum(share) OVER (PARTITION BY cluster ORDER BY quantity DESC, p_type, price_bin
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 8) AS cumulative
FROM shares"""
)
def cumulative_share(t: Tables):
    trends = _trends(t)
    out = ordering.running(
        trends, ["cluster"], [-F.col("quantity"), "p_type", "price_bin"], cumsum={"cumulative": "share"}
    )
    return out.select(
        "cluster", "p_type", "price_bin", F.round("share", 8).alias("share"), F.round("cumulative", 8).alias("cumulative")
    )


@query(
    """
WITH day AS (
  SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS price FROM events WHERE ts >= TIMESTAMP '2024-01-01' GROUP BY 1, 2),
lagged AS (SELECT *, lag(price) OVER (PARTITION BY user_id ORDER BY day) AS previous FROM day)
SELECT user_id, day, round(price, 6) AS price, round(previous, 6) AS previous,
       round((price - previous) / nullif(previous, 0), 5) AS pct_return
FROM lagged WHERE previous IS NOT NULL"""
)
def daily_return(t: Tables):
    return daily_returns(t.events).select(
        "user_id", "day", F.round("price", 6).alias("price"), F.round("previous", 6).alias("previous"),
        F.round("pct_return", 5).alias("pct_return"),
    )


def daily_returns(events):
    """Daily mean value per user, the day before, and the relative change."""
    day = (
        events.filter(F.col("ts") >= F.lit("2024-01-01").cast("timestamp"))
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.avg("value").alias("price"))
    )
    # one row per user and day: a user has at most as many rows as the calendar has days
    lagged = ordering.running(day, ["user_id"], ["day"], previous={"previous": "price"}, bound=CALENDAR_DAYS)
    change = ratio(F.col("price") - F.col("previous"), F.col("previous"))
    return lagged.filter(F.col("previous").isNotNull()).withColumn("pct_return", change)


@query(
    """
SELECT p_brand, p_type, min(p_size) AS min, max(p_size) AS max, 'p_size' AS measure_var, 'test' AS p_size
FROM part GROUP BY p_brand, p_type"""
)
def group_min_max(t: Tables):
    return aggregates.range_by(t.part, ["p_brand", "p_type"], "p_size")


@query(
    """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, round(count(*) / sum(count(*)) OVER (), 8) AS share
FROM orders GROUP BY 1"""
)
def grand_total_share(t: Tables):
    return aggregates.share_within(aggregates.count_by(t.orders, "o_orderstatus")).withColumn("share", F.round("share", 8))


@query("SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def bar_counts(t: Tables):
    return aggregates.count_by(t.orders, "o_orderpriority")


@query(
    """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, regexp_extract(p_name, '[^ ]+$') AS last_word,
       regexp_extract(p_brand, '[0-9]+') AS brand_number,
       nullif(regexp_extract(p_name, '^red [a-z]+'), '') AS red_thing,
       regexp_replace(p_name, 'l', 'L') AS first_l, upper(p_type) AS upper_type, lower(p_type) AS lower_type,
       p_type || ': ' || p_brand AS label, 'Part ' || p_partkey || ' is ' || p_name AS sentence,
       '$' || format('{:,.2f}', p_retailprice) AS price_text
FROM part"""
)
def text_parts(t: Tables):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        piece(name, " ", 0).alias("first_word"),
        piece(name, " ", -1).alias("last_word"),
        first_match(F.col("p_brand"), "[0-9]+").alias("brand_number"),
        first_match(name, "^red [a-z]+").alias("red_thing"),
        replace_first(name, "l", "L").alias("first_l"),
        F.upper("p_type").alias("upper_type"),
        F.lower("p_type").alias("lower_type"),
        join_text(F.col("p_type"), F.col("p_brand"), sep=": ").alias("label"),
        template("Part {key} is {name}", key=F.col("p_partkey"), name=name).alias("sentence"),
        money(F.col("p_retailprice"), 2).alias("price_text"),
    )


@query(
    """
SELECT o_custkey, CAST(count(*) AS BIGINT) AS n,
       round(count(*) * (500 + 10000 + 4900 + 3500 + 250000 / 240.0 * (40 + 60 * 0.5)
             - avg(o_totalprice) / 240.0 * 40), 6) AS cost
FROM orders GROUP BY 1"""
)
def turnover_cost_by_customer(t: Tables):
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("salary"))
    return counts.select("o_custkey", "n", F.round(turnover_cost(F.col("n"), salary=F.col("salary")), 6).alias("cost"))
