"""Lines, least squares, intervals and regression model families on parts and order lines."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..operators import joins, linear, models, split, trees
from ..operators.recipe import Recipe
from ..session import scratch_path
from ..sources.registry import ModelRegistry
from ..sources.tables import expand_steps, literal_table, uniform_table
from .registration import Tables, query

_MOMENTS = """
WITH m AS (SELECT avg(p_size) AS mx, avg(p_retailprice) AS my, var_pop(p_size) AS vx, var_pop(p_retailprice) AS vy,
                  covar_pop(p_size, p_retailprice) AS c FROM part),
grid AS (
  SELECT -5.0::DOUBLE + i * (1005.0::DOUBLE / 24) AS a1, -3.0::DOUBLE + j * (6.0::DOUBLE / 24) AS a2
  FROM range(25) t(i), range(25) u(j)),
lines AS (
  SELECT a1, a2, (SELECT sqrt(avg(pow(p_retailprice - (a1 + a2 * p_size), 2))) FROM part) AS dist FROM grid)
"""


def _grid(t: Tables):
    return joins.expand_grid(t.spark, a1=expand_steps(-5, 1000, 25), a2=expand_steps(-3, 3, 25))


@query(_MOMENTS + "SELECT round(a1, 6) AS a1, round(a2, 6) AS a2, round(dist, 6) AS dist FROM lines")
def line_grid_search(t: Tables):
    found = linear.line_search(t.part, "p_size", "p_retailprice", _grid(t))
    return found.select(*[F.round(c, 6).alias(c) for c in ("a1", "a2", "dist")])


@query(
    _MOMENTS
    + """
, ranked AS (SELECT *, rank() OVER (ORDER BY dist) + (count(*) OVER (PARTITION BY dist) - 1) / 2 AS rank FROM lines)
SELECT round(a1, 6) AS a1, round(a2, 6) AS a2, round(dist, 6) AS dist, CAST(rank AS DOUBLE) AS rank FROM ranked WHERE rank <= 10"""
)
def top10_lines(t: Tables):
    found = linear.line_search(t.part, "p_size", "p_retailprice", _grid(t))
    return linear.best_by_rank(found, "dist", 10).select(*[F.round(c, 6).alias(c) for c in ("a1", "a2", "dist")], "rank")


@query(
    f"""
WITH lines AS (SELECT {split.draw_sql('id', 3)} * 300 + 800 AS a1, {split.draw_sql('id', 4)} * 10 - 5 AS a2 FROM range(250) t(id)),
near AS (SELECT a1, a2, (SELECT sqrt(avg(pow(p_retailprice - (a1 + a2 * p_size), 2))) FROM part) AS dist FROM lines),
ranked AS (SELECT *, rank() OVER (ORDER BY dist) + (count(*) OVER (PARTITION BY dist) - 1) / 2 AS rank FROM near)
SELECT round(a1, 6) AS a1, round(a2, 6) AS a2, round(dist, 6) AS dist, CAST(rank AS DOUBLE) AS rank FROM ranked WHERE rank <= 10"""
)
def random_line_search(t: Tables):
    """250 random lines, the 10 nearest to the points."""
    lines = uniform_table(t.spark, 250, {"a1": (800, 1100), "a2": (-5, 5)}, seed=3)
    found = linear.best_by_rank(linear.line_search(t.part, "p_size", "p_retailprice", lines), "dist", 10)
    return found.select(*[F.round(c, 6).alias(c) for c in ("a1", "a2", "dist")], "rank")


@query("SELECT round(sqrt(avg(pow(p_retailprice - (940 + 0.2 * p_size), 2))), 6) AS distance FROM part")
def line_rmse(t: Tables):
    out = linear.line_distance(t.part, "p_size", "p_retailprice", 940, 0.2)
    return out.select(F.round("distance", 6).alias("distance"))


_REGR = """round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_r2(l_extendedprice, l_quantity), 8) AS r2,
CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem"""


def _round_fit(df):
    return df.withColumns({"intercept": F.round("intercept", 3), "slope": F.round("slope", 5), "r2": F.round("r2", 8)})


@query("SELECT " + _REGR)
def ols_simple(t: Tables):
    return _round_fit(linear.simple_fit(t.lineitem, "l_quantity", "l_extendedprice"))


@query("SELECT l_returnflag, " + _REGR + " GROUP BY l_returnflag")
def ols_by_group(t: Tables):
    return _round_fit(linear.simple_fit(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"]))


@query(
    """
WITH s AS (
  SELECT var_pop(l_quantity) AS xx, var_pop(l_discount) AS zz, covar_pop(l_quantity, l_discount) AS xz,
         covar_pop(l_quantity, l_extendedprice) AS xy, covar_pop(l_discount, l_extendedprice) AS zy,
         avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice) AS my FROM lineitem),
b AS (SELECT *, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS bx, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS bz FROM s)
SELECT term, round(estimate, 3) AS estimate FROM (
  SELECT '(Intercept)' AS term, my - bx * mx - bz * mz AS estimate FROM b
  UNION ALL SELECT 'l_quantity', bx FROM b UNION ALL SELECT 'l_discount', bz FROM b)"""
)
def ols_multi(t: Tables):
    fit = linear.least_squares(t.lineitem, ["l_quantity", "l_discount"], "l_extendedprice")
    return linear.coefficient_table(t.spark, fit).select("term", F.round("estimate", 3).alias("estimate"))


def _price_terms(t: Tables):
    baked = _baked(t)
    names = [c for c in baked.columns if c.startswith(("p_size", "p_type_"))]
    return linear.coefficient_table(t.spark, linear.least_squares(baked, names, "p_retailprice"))


# With one flag per type the slope is that of the deviations from the means of the types.
_WITHIN = """
m AS (SELECT p_type, count(*) AS n, avg(p_size) AS mx, avg(p_retailprice) AS my FROM part_rows GROUP BY 1),
s AS (SELECT sum(pow(p_size - mx, 2)) AS sxx, sum((p_size - mx) * (p_retailprice - my)) / sum(pow(p_size - mx, 2)) AS b FROM part_rows JOIN m USING (p_type)),
"""


_TERMS = (
    "WITH part_rows AS (SELECT * FROM part),"
    + _WITHIN
    + """
e AS (SELECT count(*) - (SELECT count(*) FROM m) - 1 AS dof, sum(pow(p_retailprice - my - b * (p_size - mx), 2)) / (count(*) - (SELECT count(*) FROM m) - 1) AS s2
      FROM part_rows JOIN m USING (p_type), s),
f AS (SELECT n AS n1, mx AS mx1, my AS my1 FROM m ORDER BY p_type LIMIT 1),
c AS (
  SELECT '(Intercept)' AS term, my1 - b * mx1 AS estimate, sqrt(s2 * (1.0 / n1 + mx1 * mx1 / sxx)) AS std_error FROM f, s, e
  UNION ALL SELECT 'p_size', b, sqrt(s2 / sxx) FROM s, e
  UNION ALL SELECT 'p_type_' || p_type, my - my1 - b * (mx - mx1), sqrt(s2 * (1.0 / n + 1.0 / n1 + pow(mx - mx1, 2) / sxx))
  FROM m, f, s, e WHERE p_type > (SELECT min(p_type) FROM m))
"""
)
_ERRORS = "SELECT term, round(estimate, 4) AS estimate, round(std_error, 5) AS std_error, round(estimate / std_error, 4) AS statistic"


@query(
    _TERMS
    # The density of Student's t from 0 to the statistic (100 at most) by Simpson's rule over 4,000 steps.
    + """
, x AS (SELECT term, least(abs(estimate / std_error), 100.0) / 4000 AS w FROM c),
i AS (SELECT term, sum(CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * pow(1 + pow(k * w, 2) / dof, -(dof + 1) / 2.0)) * any_value(w) / 3 AS area
      FROM x, e, range(4001) r(k) GROUP BY term),
q AS (SELECT term, greatest(0.0, 1 - 2 * area * exp(lgamma((dof + 1) / 2.0) - lgamma(dof / 2.0)) / sqrt(pi() * dof)) AS p FROM i, e)
"""
    + _ERRORS
    + ", round(p, 6) AS p_value FROM c JOIN q USING (term)"
)
def ols_coefficients(t: Tables):
    """Price on size and type, with standard errors and p-values."""
    digits = {"estimate": 4, "std_error": 5, "statistic": 4, "p_value": 6}
    return _price_terms(t).withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(_TERMS + _ERRORS + " FROM c")
def ols_errors(t: Tables):
    """Estimates with standard errors and test statistics of price on size and type."""
    return ols_coefficients(t).drop("p_value")


_GROUP_LINE = """
WITH f AS (SELECT l_returnflag, regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b
           FROM lineitem GROUP BY 1)
SELECT l_returnflag, CAST(20.0 AS DOUBLE) AS l_quantity, round(a + b * 20, 3) AS pred FROM f"""


@query(_GROUP_LINE)
def ols_interaction(t: Tables):
    """A regression with number x category terms predicts like one line per category."""
    df, names = linear.interaction(t.lineitem, "l_quantity", "l_returnflag")
    fit = linear.least_squares(df, names, "l_extendedprice")
    points = joins.expand_grid(t.spark, l_quantity=[20.0], l_returnflag=["A", "N", "R"])
    points, _ = linear.interaction(points, "l_quantity", "l_returnflag", ["A", "N", "R"])
    return linear.predict(points, fit).select("l_returnflag", "l_quantity", F.round("pred", 3).alias("pred"))


@query(
    """
WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS mx, var_pop(l_quantity) * count(*) AS sxx,
                  regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b,
                  var_pop(l_extendedprice) * count(*) * (1 - regr_r2(l_extendedprice, l_quantity)) AS sse FROM lineitem)
SELECT x AS l_quantity, round(a + b * x, 3) AS pred,
       round(sqrt(sse / (n - 2) * (1.0 / n + pow(x - mx, 2) / sxx)), 4) AS std_error
FROM s, (SELECT unnest([1.0::DOUBLE, 25.0, 50.0]) AS x)"""
)
def ols_interval(t: Tables):
    """Standard error of the mean prediction; the interval is this times the t quantile."""
    from ..operators.gram import t_quantile

    fit = linear.least_squares(t.lineitem, ["l_quantity"], "l_extendedprice")
    points = joins.expand_grid(t.spark, l_quantity=[1.0, 25.0, 50.0])
    out = linear.predict_interval(points, fit)
    half = (F.col("pred_upper") - F.col("pred_lower")) / 2
    return out.select(
        "l_quantity", F.round("pred", 3).alias("pred"), F.round(half / F.lit(t_quantile(0.95, fit.dof)), 4).alias("std_error")
    )


def _times(a: str, b: str) -> str:
    """Product modulo 2^64 of two unsigned numbers kept as HUGEINT."""
    return f"((({a} % 4294967296) * {b} + ((({a} // 4294967296) * ({b} % 4294967296)) % 4294967296) * 4294967296) % 18446744073709551616)"


def _turned(a: str, bits: int) -> str:
    return f"(({a} % {1 << (64 - bits)}) * {1 << bits} + {a} // {1 << (64 - bits)})"


# The primes of xxHash64.
_P1, _P2, _P3, _P4, _P5 = (
    f"{p}::HUGEINT" for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)
_WRAP = "18446744073709551616"


def _finished(source: str, name: str) -> str:
    """Last steps of xxHash64 on column h."""
    return f"""
{name}1 AS (SELECT * EXCLUDE h, {_times("xor(h, h // 8589934592)", _P2)} AS h FROM {source}),
{name}2 AS (SELECT * EXCLUDE h, {_times("xor(h, h // 536870912)", _P3)} AS h FROM {name}1),
{name} AS (SELECT * EXCLUDE h, xor(h, h // 4294967296) AS h FROM {name}2),"""


def _then_int(source: str, value: str, name: str) -> str:
    """Goes on with a further int column, as the engine's ``xxhash64`` does."""
    return f"""
{name}_a AS (SELECT * EXCLUDE h, xor((h + {_P5} + 4) % {_WRAP}, {_times(f"({value})::HUGEINT", _P1)}) AS h FROM {source}),
{name}_b AS (SELECT * EXCLUDE h, {_turned("h", 23)} AS h FROM {name}_a),
{name}_c AS (SELECT * EXCLUDE h, ({_times("h", _P2)} + {_P3}) % {_WRAP} AS h FROM {name}_b),""" + _finished(f"{name}_c", name)


@query(
    f"""
WITH k0 AS (SELECT CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, {_times("p_partkey::HUGEINT", _P2)} AS h FROM part WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL),
k1 AS (SELECT x, y, {_turned("h", 31)} AS h FROM k0),
k2 AS (SELECT x, y, xor((42 + {_P5} + 8) % {_WRAP}, {_times("h", _P1)}) AS h FROM k1),
k3 AS (SELECT x, y, {_turned("h", 27)} AS h FROM k2),
k4 AS (SELECT x, y, ({_times("h", _P1)} + {_P4}) % {_WRAP} AS h FROM k3),"""
    + _finished("k4", "z")
    + "r AS (SELECT x, y, h, b FROM z, range(1, 201) t(b)),"
    + _then_int("r", "b", "u")
    + _then_int("u", "1", "v")
    + f"""
d AS (SELECT b, x, y, CAST(h // 2048 AS DOUBLE) / 9007199254740992 AS u FROM v),
w AS (SELECT b, x, y, {" + ".join(f"CAST(u >= {c!r}::DOUBLE AS INT)" for c in linear._POISSON)} AS w FROM d),
m AS (SELECT b, sum(w) AS n, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM w GROUP BY b),
l AS (SELECT b, any_value(mx) AS mx, any_value(my) AS my, sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)) AS slope FROM w JOIN m USING (b) GROUP BY b),
g AS (SELECT p AS p_size, my + slope * (p - mx) AS pred FROM l, (SELECT unnest([1.0::DOUBLE, 25.0, 50.0]) AS p)),
s AS (SELECT p_size, avg(pred) AS pred, list_sort(list(pred)) AS o FROM g GROUP BY p_size)
SELECT p_size, round(pred, 4) AS pred, round(o[6], 4) AS pred_lower, round(o[195], 4) AS pred_upper FROM s"""
)
def bootstrap_interval(t: Tables):
    """Bootstrap interval of the mean price at three sizes."""
    points = joins.expand_grid(t.spark, p_size=[1.0, 25.0, 50.0])
    out = linear.bootstrap_interval(t.part, "p_partkey", ["p_size"], "p_retailprice", points, replicates=200)
    return out.withColumns({c: F.round(c, 4) for c in ("pred", "pred_lower", "pred_upper")})


@query(
    """
SELECT l_returnflag, metric, round(estimate, 5) AS estimate FROM (
  SELECT l_returnflag, unnest(['rmse', 'rsq', 'mae']) AS metric,
         unnest([sqrt(avg(pow(y - p, 2))), pow(corr(y, p), 2), avg(abs(y - p))]) AS estimate
  FROM (SELECT l_returnflag, l_extendedprice AS y, 1500 * l_quantity + 1000 * l_tax AS p FROM lineitem) GROUP BY 1)"""
)
def regression_metrics(t: Tables):
    guess = t.lineitem.withColumn("pred", F.col("l_quantity") * 1500 + F.col("l_tax") * 1000)
    out = linear.regression_metrics(guess, "l_extendedprice", "pred", ["l_returnflag"])
    return out.withColumn("estimate", F.round("estimate", 5))


# -- model families ------------------------------------------------------------


def _baked(t: Tables):
    df = t.part.select("p_partkey", "p_type", "p_size", "p_brand", "p_retailprice")
    return Recipe("p_retailprice", ids=["p_partkey"]).drop_constant().dummies().fit(df).bake(df)


def _features(baked):
    return [c for c in baked.columns if c not in ("p_partkey", "p_retailprice")]


def _fit(t: Tables, *names: str, **sizes: int):
    baked = _baked(t)
    features = _features(baked)
    chosen = models.regressors("p_retailprice", len(features), **sizes)
    train, _ = split.parts(baked, "p_partkey", 0.9)
    return baked, features, models.fit_all(train, features, "p_retailprice", {n: chosen[n] for n in names})


@query()
def elastic_net(t: Tables, **sizes: int):
    """Coefficients under the mixed penalty, largest first."""
    _, features, fitted = _fit(t, "elastic_net", **sizes)
    return models.coefficients(t.spark, fitted["elastic_net"], features)


@query()
def importance(t: Tables, **sizes: int):
    """Variable importance of the tree families."""
    names = ("tree", "forest", "boosted")
    _, features, fitted = _fit(t, *names, **sizes)
    tables = [models.importance(t.spark, fitted[n], features).withColumn("model_id", F.lit(n)) for n in names]
    return joins.merge(tables)


@query()
def all_models(t: Tables, **sizes: int):
    """Held-out metrics of every family in one long table."""
    baked, _, fitted = _fit(t, "linear", "elastic_net", "tree", "forest", "forest_default", "boosted", **sizes)
    _, test = split.parts(baked, "p_partkey", 0.9)
    return models.metrics_all(fitted, test, "p_retailprice")


@query()
def new_row_predictions(t: Tables):
    """Predictions of all models for one new part of every type, joined with the parts of that type."""
    baked, features, fitted = _fit(t, "linear", "tree", "boosted")
    zero = {c: 0.0 for c in features if c != "p_size"}
    new = [{**zero, "p_size": 30.0, "p_type": "ECONOMY"}, {**zero, "p_size": 30.0, "p_type": "PROMO", "p_type_PROMO": 1.0}]
    schema = ", ".join([*[f"`{c}` double" for c in features], "p_type string"])
    rows = literal_table(t.spark, [[r[c] for c in [*features, "p_type"]] for r in new], schema)
    predictions = models.predict_all(fitted, rows, ["p_type"])
    known = t.part.groupBy("p_type").agg(F.avg("p_retailprice").alias("mean_price"), F.count(F.lit(1)).alias("n_parts"))
    return joins.left_lookup(predictions, known, ["p_type"])


@query()
def model_parameters(t: Tables):
    """Settings of fitted models as rows."""
    _, _, fitted = _fit(t, "elastic_net", "tree")
    return joins.merge([models.parameters(t.spark, n, m) for n, m in fitted.items()])


@query(
    f"WITH part_rows AS (SELECT * FROM part WHERE {split.draw_sql('p_partkey')} < 0.9),"
    + _WITHIN
    + f"""
test AS (SELECT * FROM part WHERE {split.draw_sql('p_partkey')} >= 0.9)
SELECT p_partkey, p_retailprice, round(my + b * (p_size - mx), 4) AS pred FROM test JOIN m USING (p_type), s"""
)
def workflow_predictions(t: Tables):
    """Feature stages and a model as one fitted object that scores raw rows."""
    parts = t.part.select("p_partkey", "p_type", "p_size", "p_retailprice")
    train, test = split.parts(parts, "p_partkey", 0.9)
    stages = (
        StringIndexer(inputCol="p_type", outputCol="p_type_code", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="p_type_code", outputCol="p_type_flags"),
    )
    price = models.regressors("p_retailprice", 2)["linear"]
    fitted = models.workflow(["p_size", "p_type_flags"], price, *stages).fit(train)
    return fitted.transform(test).select("p_partkey", "p_retailprice", F.round("prediction", 4).alias("pred"))


@query(
    """
WITH c AS (
  SELECT 0 AS o, 'l_quantity' AS f, CAST(l_quantity AS DOUBLE) AS v, l_extendedprice AS y FROM lineitem
  UNION ALL SELECT 1, 'l_discount', l_discount, l_extendedprice FROM lineitem
  UNION ALL SELECT 2, 'l_tax', l_tax, l_extendedprice FROM lineitem),
g AS (SELECT o, f, v, count(*) AS n, sum(y) AS s FROM c GROUP BY ALL),
l AS (SELECT o, f, v, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s,
             max(v) OVER (PARTITION BY f) AS most FROM g WINDOW w AS (PARTITION BY f ORDER BY v)),
p AS (SELECT unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS penalty, unnest(['tree', 'boosted']) AS model_id),
k AS (SELECT *, CASE WHEN penalty = 0 THEN 0.0 ELSE s / n END AS base FROM l, p WHERE v < most),
b AS (SELECT *, pow(ls - ln * base, 2) / (ln + penalty) + pow(s - ls - (n - ln) * base, 2) / (n - ln + penalty) AS gain FROM k),
r AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY gain DESC, o, v) = 1)
SELECT model_id, f AS feature, round(v, 6) AS threshold, CAST(ln AS DOUBLE) AS left_rows, CAST(n - ln AS DOUBLE) AS right_rows,
       round((ls - ln * base) / (ln + penalty), 4) AS left_value, round((s - ls - (n - ln) * base) / (n - ln + penalty), 4) AS right_value
FROM r"""
)
def first_splits(t: Tables):
    """First split and leaf values of a single and of a boosted tree."""
    names = ["l_quantity", "l_discount", "l_tax"]
    df = VectorAssembler(inputCols=names, outputCol="features").transform(t.lineitem.select(*names, "l_extendedprice"))
    data = trees.rows_of(df, "features", "l_extendedprice").persist()
    single = trees.single(data, len(names), 1, 7, 0.0)[0]
    boosted = trees.boosted(data, len(names), 1, 0.25, 1)[1]
    data.unpersist()
    rows = []
    for name, found in (("tree", single), ("boosted", boosted)):
        a, b = int(found.left[0]), int(found.left[0]) + 1
        rows.append((name, names[found.feature[0]], *[float(v) for v in (found.threshold[0], found.weight[a], found.weight[b], found.value[a], found.value[b])]))
    out = t.spark.createDataFrame(rows, "model_id string, feature string, threshold double, left_rows double, right_rows double, left_value double, right_value double")
    return out.withColumns({c: F.round(c, d) for c, d in (("threshold", 6), ("left_value", 4), ("right_value", 4))})


@query(
    """
WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, stddev_samp(l_quantity) AS sx,
                  stddev_samp(l_extendedprice) AS sy, corr(l_extendedprice, l_quantity) AS r FROM lineitem),
b AS (SELECT *, greatest(0.0, r * (n - 1) / n - 5000 * 0.3 / sy) / ((n - 1) / CAST(n AS DOUBLE) + 5000 * 0.7 / sy) * sy / sx AS slope FROM s)
SELECT term, round(estimate, 1) AS estimate FROM (
  SELECT '(Intercept)' AS term, my - slope * mx AS estimate FROM b UNION ALL SELECT 'l_quantity', slope FROM b)"""
)
def elastic_net_line(t: Tables):
    """A line under the mixed penalty, whose solution has a closed form."""
    fit = LinearRegression(featuresCol="features", labelCol="l_extendedprice", regParam=5000.0, elasticNetParam=0.3, tol=1e-12, maxIter=500)
    found = models.workflow(["l_quantity"], fit).fit(t.lineitem.select("l_quantity", "l_extendedprice"))
    return models.coefficients(t.spark, found, ["l_quantity"]).withColumn("estimate", F.round("estimate", 1))


@query(
    """
WITH f AS (SELECT l_returnflag AS g, regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b,
                  regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY 1),
p AS (SELECT g, a, b, r2, l_extendedprice AS y, a + b * l_quantity AS p FROM f, lineitem),
m AS (SELECT g, any_value(a) AS a, any_value(b) AS b, any_value(r2) AS r2, unnest(['rmse', 'rsq', 'mae']) AS metric,
             unnest([sqrt(avg(pow(y - p, 2))), pow(corr(y, p), 2), avg(abs(y - p))]) AS estimate FROM p GROUP BY g)
SELECT 'line_' || g AS model_id, 'l_extendedprice' AS response, 'l_quantity' AS features, 'LinearRegression' AS family, round(a, 3) AS intercept, round(b, 5) AS slope,
       round(r2, 6) AS fitted_rsq, metric, round(estimate, 4) AS estimate FROM m"""
)
def saved_lines(t: Tables):
    """A line per return flag: saved, found in the folder, loaded by id and held against all rows."""
    registry = ModelRegistry(t.spark, scratch_path(t.spark, "lines"))
    for flag in ("A", "N", "R"):
        rows = t.lineitem.filter(F.col("l_returnflag") == flag).select("l_quantity", "l_extendedprice")
        price = LinearRegression(featuresCol="features", labelCol="l_extendedprice", solver="normal", regParam=0.0)
        fitted = models.workflow(["l_quantity"], price).fit(rows)
        registry.save(f"line_{flag}", fitted, "l_extendedprice", ["l_quantity"], {"rsq": fitted.stages[-1].summary.r2})
    loaded = registry.load_all()
    terms = [(n, type(m.stages[-1]).__name__.removesuffix("Model"), float(m.stages[-1].intercept), float(m.stages[-1].coefficients[0])) for n, m in loaded.items()]
    lines = t.spark.createDataFrame(terms, "model_id string, family string, intercept double, slope double")
    about = registry.table().select("model_id", "response", F.array_join("features", ",").alias("features"),
                                    F.get_json_object("metrics", "$.rsq").cast("double").alias("fitted_rsq"))
    out = joins.lookup_chain(models.metrics_all(loaded, t.lineitem, "l_extendedprice"), [(about, ["model_id"]), (lines, ["model_id"])])
    return out.withColumns({c: F.round(c, d) for c, d in (("intercept", 3), ("slope", 5), ("fitted_rsq", 6), ("estimate", 4))})
