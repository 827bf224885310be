"""Forests on many rows that share few features: rows counted, drawn once, and routed once."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tallyloom.operators import models, trees


@pytest.fixture(scope="module")
def many(spark):
    """60 distinct features with 40 rows each, some of them with equal labels."""
    rng = np.random.default_rng(4)
    x = np.repeat(np.array([(a, b, a % 2) for a in range(12) for b in range(5)], float), 40, 0)
    y = np.round(x[:, 0] * (x[:, 1] > 1) + x[:, 2] + rng.normal(size=len(x)), 1)
    df = spark.createDataFrame([(Vectors.dense(v), float(w)) for v, w in zip(x, y)], ["features", "y"]).repartition(5).persist()
    return x, y, df


def test_default_forest_of_many_rows_has_the_rules_and_the_quality_of_sparks(many, monkeypatch):
    x, y, df = many
    spark_ = RandomForestRegressor(labelCol="y", featuresCol="features", numTrees=60, seed=3).fit(df)
    forest = trees.DefaultForest(labelCol="y", trees=60, seed=3)
    assert type(forest.fit(df)) is type(spark_)  # few rows: Spark's forest as it is
    monkeypatch.setattr(trees, "FEW", 1000)
    monkeypatch.setattr(trees, "RandomForestRegressor", None)
    found = forest.fit(df)
    assert found.getNumTrees() == 60
    errors = [np.mean([(r.prediction - r.y) ** 2 for r in m.transform(df).collect()]) for m in (spark_, found)]
    assert errors[1] == pytest.approx(errors[0], rel=0.1)
    assert found.featureImportances.toArray() == pytest.approx(spark_.featureImportances.toArray(), abs=0.08)


def test_bagged_trees_split_where_the_drawn_rows_gain_most(many):
    x, y, df = many
    rows = trees.rows_of(df.select("features", "y"), "features", "y")
    grown = trees.bagged(rows, 3, 7, seed=5)
    splits = trees.splits_of(rows, 3)
    assert [e.tolist() for e in splits] == [[a + 0.5 for a in range(11)], [0.5, 1.5, 2.5, 3.5], [0.5]] and grown.depth <= trees.DEPTH
    counted = trees.binned(rows, splits).collect()
    assert len(counted) < len(y) == sum(r.c for r in counted)
    x, y = np.array([list(r.x) for r in counted], float), np.array([r.y for r in counted])
    h, c = np.array([r.h for r in counted], np.int64).view(np.uint64), np.array([r.c for r in counted])
    weight = trees.drawn_counts(h, c, np.arange(7), 5)

    def error(own, w):
        n = w[own].sum()
        return (w[own] * y[own] ** 2).sum() - (w[own] * y[own]).sum() ** 2 / n if n else 0.0

    for tree, root in enumerate(grown.roots):
        w, stack = weight[:, tree], [(root, np.arange(len(y)))]
        while stack:
            node, own = stack.pop()
            assert grown.weight[node] == w[own].sum() > 0 and grown.value[node] == pytest.approx((w[own] * y[own]).sum() / w[own].sum())
            f = grown.feature[node]
            if f < 0:
                continue
            kept = error(own, w)
            gains = {b: kept - error(own[x[own, f] <= b], w) - error(own[x[own, f] > b], w) for b in range(len(splits[f]))
                     if w[own[x[own, f] <= b]].sum() and w[own[x[own, f] > b]].sum()}
            left = x[own, f] <= np.searchsorted(splits[f], grown.threshold[node])
            assert grown.threshold[node] in splits[f]
            assert grown.gain[node] == pytest.approx(max(gains.values())) == pytest.approx(gains[int(np.searchsorted(splits[f], grown.threshold[node]))])
            stack += [(grown.left[node], own[left]), (grown.left[node] + 1, own[~left])]


def test_sums_of_draws_are_kept_and_give_the_same_trees(many, monkeypatch):
    x, y, df = many
    rows = trees.rows_of(df, "features", "y")

    def run():
        seen, reduced = [], trees.reduced
        with monkeypatch.context() as m:
            m.setattr(trees, "reduced", lambda rows, *a: (seen.append((rows.columns, rows.count())), reduced(rows, *a))[1])
            return trees.randomised(rows, 3, 6, 2, max_depth=4, seed=4), trees.bagged(rows, 3, 6, seed=4), seen

    a, b, before = run()
    monkeypatch.setattr(trees, "KEPT", 0)
    monkeypatch.setattr(trees, "KEPT_BYTES", 1 << 10)
    c, d, after = run()
    assert all("sums" not in names and n > 600 for names, n in before)
    # Features in two partitions come twice.
    assert all("sums" in names and 60 <= n <= 60 + 8 for names, n in after)
    for one, two in ((a, c), (b, d)):
        assert (one.feature == two.feature).all() and np.allclose(one.threshold, two.threshold)
        assert np.allclose(one.weight, two.weight) and np.allclose(one.value, two.value) and np.allclose(one.gain, two.gain)


def test_counts_of_equal_rows_are_sums_of_single_draws():
    h = np.random.default_rng(2).integers(0, 1 << 63, 4000).astype(np.uint64)
    numbers = np.arange(50)
    c = np.repeat([1.0, 3.0, 400.0, 2e5], 1000)
    drawn = trees.drawn_counts(h, c, numbers, 9)
    assert (drawn[:1000] == trees.drawn_weights(h[:1000], numbers, 9)).all()
    for k in (1, 3, 400, 2e5):
        own = drawn[c == k]
        assert own.mean() == pytest.approx(k, rel=0.02) and own.var() == pytest.approx(k, rel=0.05)


def test_splits_are_nearest_to_equal_shares():
    values, counts = np.arange(100.0), np.where(np.arange(100) == 7, 500.0, 1.0)
    found = trees._between(values, counts)
    assert 0 < len(found) < trees.BINS and 7.5 in found and (np.diff(found) > 0).all()
    assert trees._between(values[:5], counts[:5]).tolist() == [0.5, 1.5, 2.5, 3.5] and len(trees._between(values[:1], counts[:1])) == 0
    even = trees._between(np.arange(320.0), np.ones(320))
    assert even.tolist() == [10 * i - 0.5 for i in range(1, 32)]


def test_features_of_very_many_values_are_cut_at_quantiles(spark, monkeypatch):
    monkeypatch.setattr(trees, "VALUES", 100)
    rows = spark.range(3200).select(F.array(F.col("id").cast("double"), (F.col("id") % 2).cast("double"), F.lit(1.0)).alias("x"), F.lit(0.0).alias("y"))
    many_, two, none = trees.splits_of(rows, 3)
    assert len(many_) == 31 and np.abs(many_ - np.arange(1, 32) * 100).max() <= 2 and two.tolist() == [0.5] and len(none) == 0


def test_held_out_rows_of_equal_features_are_scored_together(spark, many):
    x, y, _ = many
    flat = spark.createDataFrame([(*map(float, v), float(w)) for v, w in zip(x, y)], "a double, b double, c double, y double").repartition(7)
    fitted = models.fit_all(flat, ["a", "b", "c"], "y", {n: e for n, e in models.regressors("y", 3, trees=4, rounds=2).items() if n in ("linear", "forest", "boosted")})
    wide = models._near(fitted["linear"].stages[0].transform(flat).select("y", "features"))
    seen = wide.select(F.spark_partition_id().alias("p"), "features").collect()
    runs = sum(a.p != b.p or a.features != b.features for a, b in zip(seen, seen[1:])) + 1
    assert len(seen) == len(y) and runs <= 60 + wide.rdd.getNumPartitions()
    plain = models.regression_metrics(models.predict_all(fitted, flat, ["y"]), "y", "pred", ["model_id"])
    got, want = ({(r.model_id, r.metric): r.estimate for r in t.collect()} for t in (models.metrics_all(fitted, flat, "y"), plain))
    assert len(got) == 9 and got == {k: pytest.approx(v) for k, v in want.items()}
