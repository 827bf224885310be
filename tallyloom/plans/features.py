"""Feature preparation: constants, scaling, dummies, power transform, whole recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import recipe, reshape, split
from ..operators.recipe import Recipe
from .registration import Tables, query

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _train(df):
    return split.parts(df, "o_orderkey", 0.85)[0]


def _orders(t: Tables):
    return t.orders.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey", "o_orderpriority", "o_orderdate",
        F.lit(1).alias("employee_count"), F.lit("Y").alias("over18"),
    )


def _base(t: Tables) -> Recipe:
    return Recipe("o_orderstatus", ids=["o_orderkey"])


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, o_custkey, o_orderpriority, o_orderdate FROM orders")
def zero_variance(t: Tables):
    df = _orders(t)
    return _base(t).drop_constant().fit(_train(df)).bake(df)


_TRAIN = f"(SELECT * FROM orders WHERE {split.draw_sql('o_orderkey')} < 0.85)"


@query(
    f"""
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS d, avg(o_custkey) AS mc, stddev_samp(o_custkey) AS dc
           FROM {_TRAIN})
SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS o_totalprice, round((o_custkey - mc) / dc, 6) AS o_custkey
FROM orders, s"""
)
def center_scale(t: Tables):
    df = _orders(t).select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    fitted = _base(t).center().scale().fit(_train(df))
    return fitted.bake(df).select(
        "o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"), F.round("o_custkey", 6).alias("o_custkey")
    )


_DUMMIES = ", ".join(
    f"CAST(o_orderpriority = '{p}' AS DOUBLE) AS \"{recipe.dummy_name('o_orderpriority', p)}\"" for p in PRIORITIES[1:]
)


@query(
    f"""
SELECT o_orderkey, {_DUMMIES}, CAST(o_orderstatus = 'O' AS DOUBLE) AS "o_orderstatus_O",
       CAST(o_orderstatus = 'P' AS DOUBLE) AS "o_orderstatus_P" FROM orders"""
)
def dummies(t: Tables):
    df = _orders(t).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return _base(t).dummies(outcome=True).fit(_train(df)).bake(df)


@query(
    """
SELECT event_id, round(CASE WHEN value >= 0 THEN (pow(value + 1, 0.25) - 1) / 0.25
                            ELSE -(pow(1 - value, 1.75) - 1) / 1.75 END, 6) AS value,
       round(CASE WHEN value - 10 >= 0 THEN ln(value - 9) ELSE -(pow(11 - value, 2) - 1) / 2 END, 6) AS shifted
FROM events"""
)
def yeo_johnson_fixed(t: Tables):
    df = t.events.select("event_id", "value", (F.col("value") - 10).alias("shifted"))
    step = Recipe("event_id").power_transform(["value", "shifted"], {"value": 0.25, "shifted": 0.0})
    out = step.fit(df).bake(df)
    return out.select("event_id", F.round("value", 6).alias("value"), F.round("shifted", 6).alias("shifted"))


def _changed(lam: str) -> str:
    return f"""CASE WHEN value >= 0 THEN CASE WHEN abs({lam}) < 1e-3 THEN ln(1 + value) ELSE (pow(value + 1, {lam}) - 1) / {lam} END
            WHEN abs({lam} - 2) < 1e-3 THEN -ln(1 - value) ELSE -(pow(1 - value, 2 - {lam}) - 1) / (2 - {lam}) END"""


def _grid_round(i: int) -> str:
    """21 parameters between the borders of the round before, the likelihood of each, the best and the next borders."""
    return f"""
g{i} AS (SELECT a, b, a + (b - a) * k / 20 AS lam FROM s{i - 1}, range(21) t(k)),
v{i} AS (SELECT lam, any_value(a) AS a, any_value(b) AS b, var_pop({_changed("lam")}) AS v FROM g{i}, events GROUP BY lam),
b{i} AS (SELECT * FROM v{i}, j WHERE v > 0 ORDER BY -0.5 * ln(v) + (lam - 1) * j DESC LIMIT 1),
s{i} AS (SELECT lam, greatest(-5.0, lam - (b - a) / 20) AS a, least(5.0, lam + (b - a) / 20) AS b FROM b{i}),"""


_SKEW = "(avg(pow({0}, 3)) - 3 * avg({0}) * avg({0} * {0}) + 2 * pow(avg({0}), 3)) / pow(var_pop({0}), 1.5)"


@query(
    "WITH j AS (SELECT avg(sign(value) * ln(1 + abs(value))) AS j FROM events), s0 AS (SELECT -5.0::DOUBLE AS a, 5.0::DOUBLE AS b),"
    + "".join(_grid_round(i) for i in range(1, 5))
    + f"""
c AS (SELECT value, lam, {_changed("lam")} AS changed FROM events, s4)
SELECT round(any_value(lam), 6) AS lambda, round({_SKEW.format("value")}, 5) AS skewness_before,
       round({_SKEW.format("changed")}, 5) AS skewness_after FROM c"""
)
def yeo_johnson_fit(t: Tables):
    """Fitted parameters with the skewness before and after."""
    df = t.events.select("event_id", "value")
    fitted = Recipe("event_id").power_transform(["value"]).fit(df)
    lam = fitted.steps[0][1]["lambdas"]["value"]
    both = df.withColumn("changed", recipe.yeo_johnson(F.col("value"), lam))
    return both.agg(
        F.round(F.lit(lam), 6).alias("lambda"), F.round(F.skewness("value"), 5).alias("skewness_before"),
        F.round(F.skewness("changed"), 5).alias("skewness_after"),
    )


@query(
    f"""
WITH tr AS (SELECT CASE WHEN o_totalprice >= 0 THEN (pow(o_totalprice + 1, 0.5) - 1) / 0.5 END AS x FROM {_TRAIN}),
s AS (SELECT avg(x) AS m, stddev_samp(x) AS d FROM tr)
SELECT o_orderkey, o_orderstatus, round((((pow(o_totalprice + 1, 0.5) - 1) / 0.5) - m) / d, 5) AS o_totalprice, {_DUMMIES},
       CAST(strftime(o_orderdate, '%a') = 'Mon' AS DOUBLE) AS "o_orderdate_dow_Mon",
       CAST(strftime(o_orderdate, '%b') = 'Dec' AS DOUBLE) AS "o_orderdate_month_Dec",
       CAST(month(o_orderdate) = 12 AND day(o_orderdate) = 25 AS INT) AS "o_orderdate_ChristmasDay"
FROM orders, s"""
)
def recipe_bake(t: Tables):
    """A whole recipe learned on 85 % of the orders and applied to all of them."""
    df = _orders(t)
    steps = (
        _base(t)
        .drop_constant()
        .as_category("o_custkey")
        .remove("o_custkey")
        .power_transform(["o_totalprice"], {"o_totalprice": 0.5})
        .normalise("o_totalprice")
        .date_parts("o_orderdate")
        .holidays("o_orderdate", ["ChristmasDay"])
        .remove("o_orderdate")
        .dummies()
        .safe_names()
    )
    out = steps.fit(_train(df)).bake(df)
    names = [recipe.dummy_name("o_orderpriority", p) for p in PRIORITIES[1:]]
    return out.select(
        "o_orderkey", "o_orderstatus", F.round("o_totalprice", 5).alias("o_totalprice"), *names,
        "o_orderdate_dow_Mon", "o_orderdate_month_Dec", "o_orderdate_ChristmasDay",
    )


@query(
    """
WITH v AS (SELECT user_id, event_type, sum(value) AS v FROM events GROUP BY 1, 2)
SELECT user_id, round(max(CASE WHEN event_type = 'click' THEN v ELSE 0 END), 4) AS click,
       round(max(CASE WHEN event_type = 'error' THEN v ELSE 0 END), 4) AS error,
       round(max(CASE WHEN event_type = 'purchase' THEN v ELSE 0 END), 4) AS purchase,
       round(max(CASE WHEN event_type = 'signup' THEN v ELSE 0 END), 4) AS signup,
       round(max(CASE WHEN event_type = 'view' THEN v ELSE 0 END), 4) AS view
FROM v GROUP BY 1"""
)
def user_item_vectors(t: Tables):
    """Sparse user vectors over event types, shown as columns."""
    from pyspark.ml.functions import vector_to_array

    vectors, _ = reshape.user_item_vectors(t.events, "user_id", "event_type", "value")
    cells = vector_to_array("features")
    names = ("click", "error", "purchase", "signup", "view")
    return vectors.select("user_id", *[F.round(cells[i], 4).alias(n) for i, n in enumerate(names)])


@query(
    """
SELECT l_orderkey, CAST(position AS INTEGER) AS position, key, value FROM (
  SELECT l_orderkey, 'n_lines' AS key, CAST(count(*) AS DOUBLE) AS value, 0 AS position FROM lineitem GROUP BY 1
  UNION ALL SELECT l_orderkey, 'quantity', sum(l_quantity), 1 FROM lineitem GROUP BY 1)"""
)
def unpivot_long(t: Tables):
    wide = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    return reshape.lengthen(wide, ["l_orderkey"], ["n_lines", "quantity"], cast="double", position="position")


@query(
    """
SELECT p_partkey, 'size' AS measure, CAST(p_size AS DOUBLE) AS amount FROM part
UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part"""
)
def nested_rows(t: Tables):
    """A small table nested in every row, and taken out again."""
    packed = reshape.nest(t.part, ["p_partkey"], {"size": "p_size", "price": "p_retailprice"}, "measure", "amount", "table")
    return reshape.unnest(packed, "table")


@query(
    "SELECT CAST(count(*) AS BIGINT) AS n, "
    + ", ".join(f'CAST(sum(CASE WHEN l_linenumber = {i} THEN 1 ELSE 0 END) AS DOUBLE) AS "l_linenumber_{i}"' for i in range(2, 8))
    + " FROM lineitem"
)
def number_as_category(t: Tables):
    """A number turned into a category and then into dummies, counted."""
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    baked = Recipe("l_quantity", ids=["l_orderkey"]).as_category("l_linenumber").dummies().fit(df).bake(df)
    names = sorted(c for c in baked.columns if c.startswith("l_linenumber"))
    return baked.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).cast("double").alias(c) for c in names])
