import math

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import evaluate, gainlift, leaderboard
from .conftest import rows


@pytest.fixture(scope="module")
def decile_scores(spark):
    """220 cases in ten score groups with known numbers of responses."""
    responses = [15, 6, 2, 3, 3, 2, 0, 1, 0, 0]
    data, row = [], 0
    for g, hits in enumerate(responses):
        for i in range(22):
            row += 1
            data.append(("m", row, 1 if i < hits else 0, 1.0 - row / 1000.0))
    return spark.createDataFrame(data, "model_id string, row_id int, label int, score double")


def test_gain_and_lift_known_table(decile_scores):
    table = gainlift.gain_lift(gainlift.decile_table(decile_scores)).orderBy("group").collect()
    assert [r.responses for r in table] == [15, 6, 2, 3, 3, 2, 0, 1, 0, 0]
    assert [r.cumulative_responses for r in table] == [15, 21, 23, 26, 29, 31, 31, 32, 32, 32]
    assert [round(r.gain, 3) for r in table] == [0.469, 0.656, 0.719, 0.812, 0.906, 0.969, 0.969, 1, 1, 1]
    assert [round(r.lift, 2) for r in table] == [4.69, 3.28, 2.40, 2.03, 1.81, 1.61, 1.38, 1.25, 1.11, 1]
    assert [round(r.pct_responses, 4) for r in table][:3] == [0.4688, 0.1875, 0.0625]
    assert {r.lift_baseline for r in table} == {1.0}
    assert len(gainlift.gain_chart(gainlift.gain_lift(gainlift.decile_table(decile_scores))).collect()) == 20


@pytest.fixture(scope="module")
def tied(spark):
    """Two models with many equal scores; one score is shared by a third of the rows."""
    df = spark.range(600).select(
        F.col("id").alias("row_id"),
        (F.pmod(F.hash("id"), F.lit(10)) < 3).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.hash(F.col("id"), F.lit(1)), F.lit(40)) / 40.0).alias("score"),
    )
    both = df.withColumn("model_id", F.lit("a")).unionByName(df.withColumn("model_id", F.lit("b")).withColumn("score", 1 - F.col("score")))
    return both.select("model_id", "row_id", "label", "score").persist()


def test_auc_against_all_pairs(tied):
    pdf = tied.toPandas()
    for r in evaluate.areas(evaluate.threshold_table(tied)).collect():
        own = pdf[pdf.model_id == r.model_id]
        pos, neg = own[own.label == 1].score.values, own[own.label == 0].score.values
        wins = sum(float((p > neg).sum()) + 0.5 * float((p == neg).sum()) for p in pos)
        assert r.auc == pytest.approx(wins / (len(pos) * len(neg)))
        assert r.gini == pytest.approx(2 * r.auc - 1)


def test_auc_of_the_opposite_score(tied):
    a, b = [r.auc for r in evaluate.areas(evaluate.threshold_table(tied)).orderBy("model_id").collect()]
    assert a + b == pytest.approx(1)


def test_sliced_thresholds_equal_plain(tied):
    assert rows(evaluate.threshold_table(tied)) == rows(evaluate.threshold_table(tied, rows_per_task=7))
    assert rows(gainlift.decile_table(tied)) == rows(gainlift.decile_table(tied, rows_per_task=60))
    plain = gainlift.fine_gain_lift(tied)
    assert rows(plain) == rows(gainlift.fine_gain_lift(tied, rows_per_task=9))
    last = plain.groupBy("model_id").agg(F.max("cumulative_capture_rate").alias("c"), F.max_by("cumulative_lift", "group").alias("l"))
    assert rows(last) == [("a", 1.0, 1.0), ("b", 1.0, 1.0)]


def test_leaderboard_agrees_with_the_parts(tied):
    board = {r.model_id: r for r in evaluate.leaderboard(tied).collect()}
    single = {r.model_id: r for r in evaluate.probability_metrics(tied).collect()}
    for m, r in board.items():
        assert r.logloss == pytest.approx(single[m].logloss)
        assert r.mse == pytest.approx(single[m].mse)
        assert r.rmse == pytest.approx(math.sqrt(r.mse))


def test_gini_identity():
    assert 2 * 0.8588763 - 1 == pytest.approx(0.7177527, abs=2e-7)


def test_confusion_layout_and_rates(spark):
    data = [("m", 0.3586, 151, 20, 871, 23)]
    best = spark.createDataFrame(data, "model_id string, threshold double, tps long, fps long, tns long, fns long")
    got = evaluate.confusion(best).orderBy("position").collect()
    assert [(r.actual, r.predicted_no, r.predicted_yes) for r in got] == [("No", 871, 20), ("Yes", 23, 151), ("Totals", 894, 171)]
    assert [round(r.error, 6) for r in got] == [0.022447, 0.132184, 0.040376]


def test_best_threshold_takes_the_highest_of_equal_rows(spark):
    t = spark.createDataFrame([("m", 0.2, 0.5), ("m", 0.6, 0.5), ("m", 0.9, 0.1)], "model_id string, threshold double, f1 double")
    assert evaluate.best_threshold(t).first().threshold == 0.6


def test_one_class_only(spark):
    df = spark.createDataFrame([("m", 1, 1, 0.2), ("m", 2, 1, 0.4)], "model_id string, row_id int, label int, score double")
    r = evaluate.leaderboard(df).first()
    assert r.auc is None and r.logloss == pytest.approx(-(math.log(0.2) + math.log(0.4)) / 2)


BOARD = "model_id string, auc double, logloss double, aucpr double, mean_per_class_error double, rmse double, mse double"


def test_leaderboard_presentation(spark):
    data = [("GBM_2_x", 0.8, 0.30, 0.0, 0.0, 0.0, 0.0), ("Stacked_1", 0.9, 0.35, 0.0, 0.0, 0.0, 0.0), ("GLM_1", 0.7, 0.20, 0.0, 0.0, 0.0, 0.0)]
    board = spark.createDataFrame(data, BOARD)
    by_auc = leaderboard.board_long(board, ("AUC",), 2).filter("key = 'auc'").orderBy("rank").collect()
    assert [(r.label, r.family, r.bar) for r in by_auc] == [("1. Stacked_1", "Stacked", 2), ("2. GBM_2_x", "GBM", 1)]
    by_loss = leaderboard.board_long(board, "logloss").filter("key = 'logloss'").orderBy(F.desc("bar")).collect()
    assert [r.label for r in by_loss] == ["3. GLM_1", "2. GBM_2_x", "1. Stacked_1"]
    assert leaderboard.model_at(board, 2) == "GBM_2_x"
    with pytest.raises(ValueError):
        leaderboard.board_long(board, "rmse")
    with pytest.raises(IndexError):
        leaderboard.model_at(board, 9)


def test_charts_of_the_best_models(tied):
    charts = leaderboard.performance_charts(tied, "auc", max_models=1)
    assert set(charts) == {"roc", "precision_recall", "gain", "lift"}
    for c in charts.values():
        assert c.select("model_id").distinct().count() == 1
