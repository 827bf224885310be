"""Evaluation, gain/lift and leaderboards on fixed scores of the labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, gainlift, leaderboard, split
from .registration import Tables, query

# Three fixed scores stand for three models: text length, its opposite, and a key hash.
SCORED = """
WITH d AS (SELECT d.doc_id, d.n_chars, l.quality FROM documents d JOIN labels l USING (doc_id)),
scored AS (
  SELECT 'LEN_1' AS model_id, doc_id AS row_id, quality AS label, n_chars / (n_chars + 1500.0::DOUBLE) AS score FROM d
  UNION ALL SELECT 'SHORT_2', doc_id, quality, 1500.0::DOUBLE / (n_chars + 1500.0::DOUBLE) FROM d
  UNION ALL SELECT 'HASH_3', doc_id, quality, ((doc_id * 7919) % 1000) / 1000.0::DOUBLE FROM d),
tot AS (SELECT model_id, sum(label) AS p, sum(1 - label) AS n FROM scored GROUP BY 1),
cnt AS (SELECT model_id, score, count(*) AS c, sum(label) AS pos FROM scored GROUP BY 1, 2),
cum AS (
  SELECT model_id, score, c, pos, sum(c) OVER w AS nn, sum(pos) OVER w AS tps, p, n FROM cnt JOIN tot USING (model_id)
  WINDOW w AS (PARTITION BY model_id ORDER BY score DESC)),
thr AS (
  SELECT model_id, score AS threshold, CAST(tps AS BIGINT) AS tps, CAST(nn - tps AS BIGINT) AS fps,
         CAST(n - (nn - tps) AS BIGINT) AS tns, CAST(p - tps AS BIGINT) AS fns, CAST(pos AS BIGINT) AS pos,
         CAST(c - pos AS BIGINT) AS neg,
         tps / p AS tpr, (nn - tps) / n AS fpr, tps / nn AS precision, 2 * tps / (2 * tps + (nn - tps) + (p - tps)) AS f1
  FROM cum),
best AS (
  SELECT * FROM thr QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY f1 DESC, threshold DESC) = 1),
roc AS (
  SELECT model_id, sum(neg * (tps - pos / 2)) / (max(tps + fns) * max(fps + tns)) AS auc FROM thr GROUP BY 1),
pr AS (
  SELECT model_id, sum(pos / (tps + fns) * (precision + coalesce(before, precision)) / 2) AS aucpr FROM (
    SELECT *, lag(precision) OVER (PARTITION BY model_id ORDER BY threshold DESC) AS before FROM thr) GROUP BY 1),
prob AS (
  SELECT model_id, avg(-CASE WHEN label = 1 THEN ln(q) ELSE ln(1 - q) END) AS logloss,
         sqrt(avg((label - score) * (label - score))) AS rmse, avg((label - score) * (label - score)) AS mse
  FROM (SELECT *, least(greatest(score, 1e-15), 1 - 1e-15) AS q FROM scored) GROUP BY 1),
board AS (
  SELECT model_id, auc, logloss, aucpr, (fns / (fns + tps) + fps / (fps + tns)) / 2 AS mean_per_class_error, rmse, mse
  FROM roc JOIN prob USING (model_id) JOIN pr USING (model_id) JOIN best USING (model_id)),
tiles AS (
  SELECT *, ntile(10) OVER (PARTITION BY model_id ORDER BY score, row_id) AS ntile FROM scored),
dec AS (
  SELECT model_id, ntile, 11 - ntile AS "group", count(*) AS cases, CAST(sum(label) AS BIGINT) AS responses
  FROM tiles GROUP BY 1, 2),
gl AS (
  SELECT model_id, "group", cases, responses,
         CAST(sum(responses) OVER w AS BIGINT) AS cumulative_responses,
         responses / sum(responses) OVER (PARTITION BY model_id) AS pct_responses,
         sum(responses) OVER w / sum(responses) OVER (PARTITION BY model_id) AS gain,
         sum(cases) OVER w / sum(cases) OVER (PARTITION BY model_id) AS cumulative_pct_cases
  FROM dec WINDOW w AS (PARTITION BY model_id ORDER BY "group"))
"""


def scored(t: Tables):
    docs = t.documents.select("doc_id", "n_chars").join(t.labels.select("doc_id", "quality"), "doc_id")
    n = F.col("n_chars").cast("double")
    scores = {
        "LEN_1": n / (n + 1500),
        "SHORT_2": F.lit(1500.0) / (n + 1500),
        "HASH_3": ((F.col("doc_id") * 7919) % 1000) / F.lit(1000.0),
    }
    cells = [F.struct(F.lit(m).alias("model_id"), s.alias("score")) for m, s in scores.items()]
    return docs.select(
        F.col("doc_id").alias("row_id"), F.col("quality").alias("label"), F.inline(F.array(*cells))
    ).select("model_id", "row_id", "label", "score")


def _rounded(df, *names, digits: int = 6):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(
    SCORED
    + """
SELECT model_id, threshold, tps, fps, tns, fns, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round(precision, 6) AS precision,
       round(tpr, 6) AS recall, round(f1, 6) AS f1, round((tps + tns) / (tps + fps + tns + fns), 6) AS accuracy FROM thr"""
)
def threshold_table(t: Tables):
    out = evaluate.threshold_table(scored(t)).drop("pos_here", "neg_here")
    return _rounded(out, "tpr", "fpr", "precision", "recall", "f1", "accuracy")


@query(
    SCORED
    + """
SELECT model_id, round(auc, 8) AS auc, round(2 * auc - 1, 8) AS gini, round(aucpr, 6) AS aucpr
FROM roc JOIN pr USING (model_id)"""
)
def auc_gini(t: Tables):
    out = evaluate.areas(evaluate.threshold_table(scored(t)))
    return _rounded(_rounded(out, "auc", "gini", digits=8), "aucpr")


@query(SCORED + "SELECT model_id, round(logloss, 6) AS logloss, round(rmse, 6) AS rmse, round(mse, 6) AS mse FROM prob")
def logloss(t: Tables):
    return _rounded(evaluate.probability_metrics(scored(t)), "logloss", "rmse", "mse")


@query(
    SCORED
    + """
SELECT model_id, threshold, position, actual, predicted_no, predicted_yes, errors, predicted_no + predicted_yes AS cases,
       round(errors / (predicted_no + predicted_yes), 6) AS error
FROM (SELECT model_id, threshold, 1 AS position, 'No' AS actual, tns AS predicted_no, fps AS predicted_yes, fps AS errors FROM best
      UNION ALL SELECT model_id, threshold, 2, 'Yes', fns, tps, fns FROM best
      UNION ALL SELECT model_id, threshold, 3, 'Totals', tns + fns, fps + tps, fps + fns FROM best)"""
)
def confusion_best_f1(t: Tables):
    best = evaluate.best_threshold(evaluate.threshold_table(scored(t)))
    return _rounded(evaluate.confusion(best), "error")


@query(
    SCORED
    + """
SELECT s.model_id, s.row_id, s.label, s.score, CASE WHEN s.score >= b.threshold THEN 'Yes' ELSE 'No' END AS predict,
       1 - s.score AS "No", s.score AS "Yes"
FROM scored s JOIN best b USING (model_id)"""
)
def predicted_labels(t: Tables):
    rows = scored(t)
    return evaluate.with_label(rows, evaluate.best_threshold(evaluate.threshold_table(rows)))


@query(SCORED + "SELECT model_id, row_id, score, label FROM scored ORDER BY score DESC, row_id")
def ranked_predictions(t: Tables):
    return evaluate.ranked(scored(t))


_SPLIT_SCORED = SCORED.replace(
    "SELECT 'LEN_1' AS model_id, doc_id AS row_id",
    f"SELECT CASE WHEN {split.draw_sql('doc_id')} < 0.7 THEN 'train' ELSE 'valid' END AS model_id, doc_id AS row_id",
)


@query(_SPLIT_SCORED + "SELECT model_id AS split, round(auc, 8) AS auc FROM roc WHERE model_id IN ('train', 'valid')")
def auc_by_split(t: Tables):
    first = scored(t).filter(F.col("model_id") == "LEN_1").drop("model_id")
    parts = split.split(first, "row_id", 0.7, name="model_id", parts=("train", "valid"))
    out = evaluate.areas(evaluate.threshold_table(parts))
    return out.select(F.col("model_id").alias("split"), F.round("auc", 8).alias("auc"))


@query(SCORED + "SELECT model_id, CAST(ntile AS INTEGER) AS ntile, CAST(\"group\" AS INTEGER) AS \"group\", cases, responses FROM dec")
def decile_table(t: Tables):
    return gainlift.decile_table(scored(t))


@query(
    SCORED
    + """
SELECT model_id, CAST("group" AS INTEGER) AS "group", cases, responses, cumulative_responses,
       round(pct_responses, 6) AS pct_responses, round(gain, 6) AS gain,
       round(cumulative_pct_cases, 6) AS cumulative_pct_cases, round(gain / cumulative_pct_cases, 6) AS lift,
       round(cumulative_pct_cases, 6) AS gain_baseline, 1.0::DOUBLE AS lift_baseline FROM gl"""
)
def gain_lift(t: Tables):
    out = gainlift.gain_lift(gainlift.decile_table(scored(t)))
    return _rounded(out, "pct_responses", "gain", "cumulative_pct_cases", "lift", "gain_baseline")


_CHARTS = """
SELECT model_id, CAST("group" AS INTEGER) AS "group", chart, key, round(value, 6) AS value FROM (
  SELECT model_id, "group", 'gain' AS chart, 'gain' AS key, gain AS value FROM gl
  UNION ALL SELECT model_id, "group", 'gain', 'baseline', cumulative_pct_cases FROM gl
  UNION ALL SELECT model_id, "group", 'lift', 'lift', gain / cumulative_pct_cases FROM gl
  UNION ALL SELECT model_id, "group", 'lift', 'baseline', 1.0 FROM gl)"""


@query(SCORED + _CHARTS)
def gain_chart(t: Tables):
    table = gainlift.gain_lift(gainlift.decile_table(scored(t)))
    gain = gainlift.gain_chart(table).withColumn("chart", F.lit("gain"))
    lift = gainlift.lift_chart(table).withColumn("chart", F.lit("lift"))
    return gain.unionByName(lift).select("model_id", "group", "chart", "key", F.round("value", 6).alias("value"))


_REACHED = " + ".join(f"CAST({f}::DOUBLE <= (nn - c) / (p + n) AS INT)" for f in gainlift.FRACTIONS)
_FINE = f"""
, g AS (
  SELECT model_id, 1 + {_REACHED} AS "group", c, pos, score FROM cum),
gg AS (
  SELECT model_id, "group", sum(c) AS cases, sum(pos) AS responses, min(score) AS lower_threshold FROM g GROUP BY 1, 2),
fine AS (
  SELECT model_id, "group", lower_threshold,
         sum(cases) OVER w / sum(cases) OVER (PARTITION BY model_id) AS cumulative_data_fraction,
         sum(responses) OVER w / sum(responses) OVER (PARTITION BY model_id) AS cumulative_capture_rate
  FROM gg WINDOW w AS (PARTITION BY model_id ORDER BY "group"))
"""


@query(
    SCORED
    + _FINE
    + """
SELECT model_id, CAST("group" AS INTEGER) AS "group", lower_threshold,
       round(cumulative_data_fraction, 6) AS cumulative_data_fraction,
       round(cumulative_capture_rate, 6) AS cumulative_capture_rate,
       round(cumulative_capture_rate / cumulative_data_fraction, 6) AS cumulative_lift FROM fine"""
)
def fine_gain_lift(t: Tables):
    out = gainlift.fine_gain_lift(scored(t))
    return _rounded(out, "cumulative_data_fraction", "cumulative_capture_rate", "cumulative_lift")


@query(
    SCORED
    + _FINE
    + """
, legend AS (
  SELECT model_id, row_number() OVER (ORDER BY auc DESC, model_id) AS legend, round(auc, 3) AS auc FROM board)
SELECT chart, model_id, legend, round(x, 6) AS x, round(y, 6) AS y, auc FROM (
  SELECT 'roc' AS chart, model_id, fpr AS x, tpr AS y FROM thr
  UNION ALL SELECT 'precision_recall', model_id, tpr, precision FROM thr
  UNION ALL SELECT 'gain', model_id, cumulative_data_fraction, cumulative_capture_rate FROM fine
  UNION ALL SELECT 'lift', model_id, cumulative_data_fraction, cumulative_capture_rate / cumulative_data_fraction FROM fine)
JOIN legend USING (model_id) WHERE legend <= 2"""
)
def roc_pr_models(t: Tables):
    charts = leaderboard.performance_charts(scored(t), "auc", max_models=2)
    axes = {
        "roc": ("fpr", "tpr"),
        "precision_recall": ("recall", "precision"),
        "gain": ("cumulative_data_fraction", "gain"),
        "lift": ("cumulative_data_fraction", "lift"),
    }
    out = None
    for name, (x, y) in axes.items():
        part = charts[name].select(
            F.lit(name).alias("chart"), "model_id", "legend", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), "auc"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    SCORED
    + """
SELECT model_id, round(auc, 6) AS auc, round(logloss, 6) AS logloss, round(aucpr, 6) AS aucpr,
       round(mean_per_class_error, 6) AS mean_per_class_error, round(rmse, 6) AS rmse, round(mse, 6) AS mse
FROM board ORDER BY auc DESC"""
)
def leaderboard_table(t: Tables):
    out = evaluate.leaderboard(scored(t))
    return _rounded(out, *[c for c in out.columns if c != "model_id"])


@query(
    SCORED
    + """
, placed AS (SELECT *, row_number() OVER (ORDER BY auc DESC, model_id) AS rank FROM board),
kept AS (SELECT *, row_number() OVER (ORDER BY logloss DESC, rank DESC) AS bar FROM placed WHERE rank <= 15)
SELECT rank, rank || '. ' || model_id AS label, regexp_extract(model_id, '[^_]+') AS family, bar, key,
       CAST(position AS INTEGER) AS position, round(value, 6) AS value FROM (
  SELECT *, 'auc' AS key, auc AS value, 0 AS position FROM kept UNION ALL SELECT *, 'logloss', logloss, 1 FROM kept)"""
)
def leaderboard_long(t: Tables):
    return _rounded(leaderboard.board_long(evaluate.leaderboard(scored(t)), "logloss", 15), "value")


@query(SCORED + "SELECT model_id FROM board ORDER BY auc DESC, model_id LIMIT 1 OFFSET 1")
def model_at_position(t: Tables):
    name = leaderboard.model_at(evaluate.leaderboard(scored(t)), 2)
    return scored(t).filter(F.col("model_id") == name).select("model_id").distinct()
