"""Clusters, model search and explanations on embeddings and labelled documents."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import automl, cluster, evaluate, explain, halving, joins, manymeans, projection, reshape, split
from ..sources.registry import ModelRegistry
from ..session import scratch_path
from .registration import Tables, query
from .relational import daily_returns

# -- clusters --------------------------------------------------------------------

_NEAREST = """
WITH e AS (SELECT vec_id, label, unnest(range(1, 65)) AS i, unnest(embedding) AS v FROM embeddings),
c AS (SELECT label AS k, i, avg(v::DOUBLE) AS m FROM e GROUP BY 1, 2),
d AS (SELECT vec_id, k, sum(pow(v::DOUBLE - m, 2)) AS d FROM e JOIN c USING (i) GROUP BY 1, 2),
a AS (SELECT vec_id, arg_min(k, d) AS cluster, min(d) AS d FROM d GROUP BY 1)
"""


@query(_NEAREST + "SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, round(sqrt(d), 6) AS distance FROM a")
def kmeans_assign_fixed(t: Tables):
    """Nearest of the label means."""
    centers = cluster.mean_centers(t.embeddings, "embedding", "label")
    found = cluster.nearest_center(t.embeddings, "embedding", centers)
    return found.select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


@query(
    _NEAREST
    + "SELECT CAST(cluster AS INTEGER) AS cluster, CAST(count(*) AS BIGINT) AS size, round(sum(d), 5) AS withinss FROM a GROUP BY 1"
)
def centers_table(t: Tables):
    centers = cluster.mean_centers(t.embeddings, "embedding", "label")
    found = cluster.nearest_center(t.embeddings, "embedding", centers)
    return cluster.within_ss(found, "embedding", "cluster", centers).withColumn("withinss", F.round("withinss", 5))


@query(
    _NEAREST
    + """SELECT CAST(cluster AS INTEGER) AS cluster, CAST(i AS INTEGER) AS position, round(avg(v::DOUBLE), 6) AS value
FROM a JOIN e USING (vec_id) GROUP BY cluster, i"""
)
def kmeans_step(t: Tables):
    """Centers after one step of the common passes, from the label means."""
    starts = cluster.mean_centers(t.embeddings, "embedding", "label")
    vectors = manymeans.rows_of(t.embeddings, "embedding")
    (centers,) = manymeans.moved(vectors, [np.array([c for _, c in starts])])
    rows = [(int(k), i + 1, float(v)) for (k, _), c in zip(starts, centers) for i, v in enumerate(c)]
    return t.spark.createDataFrame(rows, "cluster int, position int, value double").withColumn("value", F.round("value", 6))


def _vectors(t: Tables):
    return reshape.array_vectors(t.embeddings.select("vec_id", "label", "embedding"), "embedding").drop("embedding").persist()


@query("SELECT round(sum(v), 4) AS totss FROM (SELECT var_pop(v::DOUBLE) * count(*) AS v FROM (SELECT unnest(range(64)) AS i, unnest(embedding) AS v FROM embeddings) GROUP BY i)")
def total_sum_of_squares(t: Tables):
    vectors = reshape.array_vectors(t.embeddings, "embedding")
    total = cluster.total_ss(vectors)
    return t.spark.range(1).select(F.round(F.lit(total), 4).alias("totss"))


@query()
def kmeans_scree(t: Tables, scans=((range(1, 16), 100), (range(16, 31), 20))):
    """Total within-cluster sum of squares: k = 1..15 with 100 restarts, on to k = 30 with 20."""
    vectors = _vectors(t)
    found = cluster.scan(vectors, [(k, restarts) for ks, restarts in scans for k in ks])
    vectors.unpersist()
    return cluster.scree_table(t.spark, found)


@query()
def kmeans_best_restart(t: Tables, restarts: int = 100):
    """Centers, sizes and sums of squares of the best restart."""
    vectors = _vectors(t)
    best = cluster.kmeans(vectors, 3, restarts)
    vectors.unpersist()
    return cluster.centers_table(t.spark, cluster.assign(vectors, best.centers), best.centers)


@query()
def project_2d(t: Tables):
    return cluster.project_2d(_vectors(t), ["vec_id"])


@query(
    """
WITH s AS (SELECT var_samp(x) AS a, var_samp(y) AS b, covar_samp(x, y) AS c FROM (SELECT CAST(l_quantity AS DOUBLE) AS x, l_extendedprice / 1000 AS y FROM lineitem)),
l AS (SELECT *, (a + b) / 2 AS m, sqrt(pow((a - b) / 2, 2) + c * c) AS d FROM s),
v AS (SELECT 1 AS component, m + d AS variance, c AS x, m + d - a AS y FROM l UNION ALL SELECT 2, m - d, c, m - d - a FROM l),
n AS (SELECT component, variance, x / sqrt(x * x + y * y) AS x, y / sqrt(x * x + y * y) AS y FROM v),
g AS (SELECT *, CASE WHEN abs(x) >= abs(y) THEN sign(x) ELSE sign(y) END AS g FROM n)
SELECT component, round(variance, 4) AS variance, round(x * g, 5) AS x, round(y * g, 5) AS y FROM g"""
)
def two_components(t: Tables):
    """Principal components of two measures, which have a closed form."""
    df = t.lineitem.select(F.array(F.col("l_quantity").cast("double"), F.col("l_extendedprice") / 1000).alias("v"))
    _, components, variance = projection.leading_components(reshape.array_vectors(df, "v"), 2)
    rows = [(i + 1, float(variance[i]), float(components[0, i]), float(components[1, i])) for i in range(2)]
    out = t.spark.createDataFrame(rows, "component int, variance double, x double, y double")
    return out.withColumns({"variance": F.round("variance", 4), "x": F.round("x", 5), "y": F.round("y", 5)})


@query()
def segments_joined(t: Tables, restarts: int = 20):
    """Users clustered by their daily returns: projection, cluster and user attributes."""
    returns = daily_returns(t.events)
    vectors, _ = reshape.user_item_vectors(returns, "user_id", "day", "pct_return")
    vectors = vectors.persist()
    best = cluster.kmeans(vectors, 4, restarts)
    about = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("mean_value"))
    return cluster.segments(vectors, best.centers, "user_id", about)


# -- model search ------------------------------------------------------------------

FEATURES = ("n_chars", "n_words", "n_lines", "upper_share", "digit_share", "mark_share", "mean_word")


def text_features(docs):
    """Shape of a whole text in numbers."""
    text = F.col("text")
    chars = F.char_length(text).cast("double")
    words = F.regexp_count(text, F.lit(r"\S+")).cast("double")

    def share(pattern):
        return F.coalesce(F.try_divide(F.regexp_count(text, F.lit(pattern)).cast("double"), chars), F.lit(0.0))

    return docs.withColumns(
        {
            "n_chars": chars,
            "n_words": words,
            "n_lines": F.regexp_count(text, F.lit("\n")).cast("double") + 1,
            "upper_share": share(r"\p{Lu}"),
            "digit_share": share("[0-9]"),
            "mark_share": share(r"\p{P}"),
            "mean_word": F.coalesce(F.try_divide(chars, words), F.lit(0.0)),
        }
    )


def _documents(t: Tables):
    """Labelled documents as features, cached: they are read by every fit."""
    docs = t.documents.select("doc_id", "text", "lang").join(t.labels.select("doc_id", "quality"), "doc_id")
    return text_features(docs).drop("text").persist()


def _all_documents(t: Tables):
    """All documents as features, with a label where there is one."""
    docs = t.documents.select("doc_id", "text", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return text_features(docs.withColumn("text", F.coalesce("text", F.lit("")))).drop("text")


def _three_parts(data):
    """Train, validation and test rows by key."""
    rest, test = split.parts(data, "doc_id", 0.7)
    train, valid = split.parts(rest, "doc_id", 0.85, salt=1)
    return train, valid, test


def _label(data):
    return data.withColumn("label", F.col("quality").cast("double"))


@query()
def automl_leaderboard(t: Tables, **sizes: int):
    """All families and their stack, ranked on rows that took no part in fitting."""
    train, _, test = _three_parts(_label(_documents(t)))
    wanted = automl.candidates(len(FEATURES), "label", **sizes)
    found = automl.search(train, "doc_id", FEATURES, "label", folds=5, wanted=wanted)
    return automl.board(found, test, "doc_id", "label")


@query()
def stacked(t: Tables):
    """Out-of-fold AUC of two base models and of their stack."""
    train, _, _ = _three_parts(_label(_documents(t)))
    wanted = automl.candidates(len(FEATURES), "label")[:2]
    found = automl.search(train, "doc_id", FEATURES, "label", folds=5, wanted=wanted)
    return found.cv_table(t.spark).drop("seconds")


@query()
def mlp(t: Tables):
    """Probabilities of a feed-forward network for all documents it did not learn from, with the label cut at the best
    threshold of those that are labelled."""
    train, _, test = _three_parts(_label(_documents(t)))
    net = automl.network("DeepLearning_1", len(FEATURES), "label", hidden=(10, 10), epochs=50)
    found = automl.search(train, "doc_id", FEATURES, "label", folds=3, wanted=[net], stack=False)
    known = automl.score(found.models, test, "doc_id", "label")
    others = _label(_all_documents(t)).join(train.select("doc_id"), "doc_id", "left_anti")
    scored = automl.score(found.models, others, "doc_id", "label")
    return evaluate.with_label(scored, evaluate.best_threshold(evaluate.threshold_table(known)))


# Network sizes and numbers of epochs of the two searches.
GRIDS = (
    (((10, 10), (20, 20), (30, 30)), (10, 20, 30)),
    (((10, 10, 10), (50, 20, 10), (20, 20, 20)), (10, 50, 100)),
)


@query()
def grid_search(t: Tables, grids=GRIDS):
    """Network sizes by numbers of epochs of both grids, five folds, best first; the best model of each grid is saved."""
    train, _, _ = _three_parts(_label(_documents(t)))
    registry = ModelRegistry(t.spark, scratch_path(t.spark, "grids"))
    rows = []
    for i, (hidden, epochs) in enumerate(grids):
        best, found = automl.network_grid(train, "doc_id", FEATURES, "label", hidden, epochs)
        saved = registry.save(f"DeepLearning_grid_{i + 1}", best, "quality", FEATURES) if best else None
        rows += [(*r, saved if k == 0 else None) for k, r in enumerate(found)]
    rows.sort(key=lambda r: (-r[2], r[0], r[1]))
    return t.spark.createDataFrame(rows, "hidden string, epochs int, cv_auc double, saved_as string")


@query()
def halving_search(t: Tables, **sizes: int):
    """63 settings of four families by successive halving; a row per setting and rung it took part in."""
    train, _, _ = _three_parts(_label(_documents(t)))
    return halving.board(t.spark, halving.search(train, "doc_id", FEATURES, "label", **sizes)[1])


@query()
def auc_train_valid_cv(t: Tables):
    """AUC of one model on training rows, validation rows and across folds."""
    train, valid, _ = _three_parts(_label(_documents(t)))
    wanted = automl.candidates(len(FEATURES), "label")[:1]
    found = automl.search(train, "doc_id", FEATURES, "label", folds=5, wanted=wanted, stack=False)
    parts = [
        automl.score(found.models, df, "doc_id", "label").withColumn("model_id", F.lit(n))
        for n, df in (("train", train), ("valid", valid))
    ]
    areas = evaluate.areas(evaluate.threshold_table(joins.merge(parts))).select(F.col("model_id").alias("part"), "auc")
    crossed = t.spark.createDataFrame([("cross-validation", found.cross_validation[0][1])], "part string, auc double")
    return areas.unionByName(crossed)


@query()
def model_registry(t: Tables):
    """Models saved, found again in the folder, loaded and evaluated; settings alongside."""
    train, _, test = _three_parts(_label(_documents(t)))
    wanted = automl.candidates(len(FEATURES), "label")[:2]
    found = automl.search(train, "doc_id", FEATURES, "label", folds=3, wanted=wanted, stack=False)
    registry = ModelRegistry(t.spark, scratch_path(t.spark, "models"))
    for name, model in found.models.items():
        registry.save(name, model, "quality", FEATURES)
    board = evaluate.leaderboard(automl.score(registry.load_all(), test, "doc_id", "label"))
    settings = registry.parameters().groupBy("model_id", "response").agg(F.count(F.lit(1)).alias("n_params"))
    return joins.lookup_chain(board, [(registry.listing().select("model_id", F.lit(True).alias("saved")), ["model_id"]), (settings, ["model_id"])])


# -- explanations ---------------------------------------------------------------------


@query(
    """
WITH d AS (SELECT CASE WHEN doc_id % 7 <> 0 THEN CAST(n_chars AS DOUBLE) END AS n_chars, CAST(doc_id AS DOUBLE) AS doc_id,
                  CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang FROM documents),
q AS (SELECT 'n_chars' AS feature, quantile_cont(n_chars, [0, 0.25, 0.5, 0.75, 1]) AS e FROM d
      UNION ALL SELECT 'doc_id', quantile_cont(doc_id, [0, 0.25, 0.5, 0.75, 1]) FROM d),
b AS (SELECT feature, i AS bin, e[i + 1] AS lower, e[i + 2] AS upper FROM q, range(4) t(i)),
v AS (SELECT 'n_chars' AS feature, n_chars AS v FROM d UNION ALL SELECT 'doc_id', doc_id FROM d),
c AS (SELECT feature, CAST(bin AS INTEGER) AS bin, lower, upper, NULL AS level,
             CAST(count(v) FILTER (WHERE (v > lower OR bin = 0) AND v <= upper) AS BIGINT) AS n
      FROM b JOIN v USING (feature) GROUP BY 1, 2, 3, 4
      UNION ALL
      SELECT 'lang', CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER), NULL, NULL, lang, count(*) FROM d WHERE lang IS NOT NULL GROUP BY lang)
SELECT *, n / sum(n) OVER (PARTITION BY feature) AS share FROM c"""
)
def lime_explainer_bins(t: Tables):
    """Bins with missing numbers and levels of a text feature."""
    docs = t.documents.select(
        F.when(F.col("doc_id") % 7 != 0, F.col("n_chars")).alias("n_chars"), "doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("lang")
    )
    return explain.explainer_table(docs, ["n_chars", "doc_id"], ["lang"])


#: Explanations made in this session, by application and folder; several queries show them.
_EXPLAINED: dict[tuple, str] = {}


def _explained(t: Tables, cases: int = 20):
    """Explanations of the 20 documents that the model finds best, of all that it did not learn from.

    Fitted and explained once a session; the rows are kept in the shared scratch folder.
    """
    at = (t.spark.sparkContext.applicationId, t.folder, cases)
    if at not in _EXPLAINED:
        path = scratch_path(t.spark, "explained")
        _explain_anew(t, cases).write.parquet(path)
        _EXPLAINED[at] = path
    return t.spark.read.parquet(_EXPLAINED[at])


def _explain_anew(t: Tables, cases: int):
    train, _, _ = _three_parts(_label(_documents(t)))
    test = _all_documents(t).join(train.select("doc_id"), "doc_id", "left_anti")
    forest = automl.candidates(len(FEATURES), "label")[1]
    model = automl.fit_one(train, FEATURES, forest)
    own = automl.columns_of("DRF_1")["probabilityCol"]

    def score(df):
        return model.transform(df).select(*df.columns, vector_to_array(own)[1].alias("score"))

    best = score(test).orderBy(F.desc("score"), "doc_id").limit(cases).drop("score")
    explainer = explain.fit_explainer(train, FEATURES)
    return explain.explain(best, "doc_id", explainer, score, n_features=8, n_permutations=5000, kernel_width=0.5)


@query()
def lime_explain(t: Tables):
    return _explained(t)


@query()
def lime_heatmap(t: Tables):
    return explain.heat_map(_explained(t))


@query()
def lime_case_view(t: Tables):
    """The first explained case with the direction of each weight."""
    rows = _explained(t)
    first = rows.agg(F.min("case")).first()[0]
    return explain.case_view(rows, first)
