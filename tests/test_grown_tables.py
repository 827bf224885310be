"""What larger tables bring: missing returns, equal rows in numbers, small samples dealt over many tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import automl, cluster, halving, models, reshape, trees
from tallyloom.plans.relational import daily_returns


def test_missing_returns_count_as_zero_and_users_stay(spark):
    days = [(1, "2024-01-01", 0.0), (1, "2024-01-02", 4.0), (1, "2024-01-03", 6.0), (2, "2024-01-01", 0.0), (2, "2024-01-02", 1.0),
            (3, "2024-01-01", None), (3, "2024-01-02", 2.0), (3, "2024-01-03", 5.0), (4, "2024-01-01", 2.0), (4, "2024-01-02", 3.0)]
    events = spark.createDataFrame(days, "user_id long, day string, value double").withColumn("ts", F.col("day").cast("timestamp"))
    vectors, width = reshape.user_item_vectors(daily_returns(events), "user_id", "day", "pct_return")
    found = {r.user_id: r.features.toArray().tolist() for r in vectors.collect()}
    # A return on nothing, or on a missing price, is missing.
    assert width == 2 and found == {1: [0, 0.5], 2: [0, 0], 3: [0, 1.5], 4: [0.5, 0]}
    out = cluster.segments(vectors, cluster.kmeans(vectors, 2, 3).centers, "user_id", events.groupBy("user_id").count())
    assert sorted(r.user_id for r in out.collect()) == [1, 2, 3, 4]


@pytest.fixture(scope="module")
def equal_rows(spark):
    """40 distinct features with 50 rows each, half of them twice."""
    rng = np.random.default_rng(8)
    x = np.repeat(np.array([(a, b) for a in range(8) for b in range(5)], float), 50, 0)
    y = np.where(np.arange(len(x)) % 2, x[:, 0] + x[:, 1] ** 2, np.round(rng.normal(size=len(x)), 3))
    df = spark.createDataFrame([(v.tolist(), float(w)) for v, w in zip(x, y)], "x array<double>, y double")
    return x, y, df.withColumn("h", F.xxhash64("x", "y")).repartition(5).persist()


def read_by(monkeypatch, run):
    """Rows that the passes of a fit read, and what it returns."""
    seen, reduced = [], trees.reduced
    monkeypatch.setattr(trees, "reduced", lambda rows, *a: (seen.append(rows.count()), reduced(rows, *a))[1])
    return run(), set(seen)


def test_histogram_trees_read_distinct_features(equal_rows, monkeypatch):
    x, y, rows = equal_rows
    (start, one), seen = read_by(monkeypatch, lambda: trees.boosted(rows, 2, 2, 0.5, 3))
    assert seen == {40} and start == pytest.approx(y.mean())
    now = np.full(len(y), start)
    for root in one.roots:  # leaves of both trees on the rows as they are
        node = one.route(x, np.array([root]))[:, 0]
        for n in set(node.tolist()):
            own = node == n
            assert one.weight[n] == own.sum() and one.value[n] == pytest.approx((y - now)[own].sum() / (own.sum() + 1))
        now = now + 0.5 * one.value[node]


def test_randomised_trees_read_equal_rows_once_with_their_weights(equal_rows, monkeypatch):
    x, y, rows = equal_rows
    distinct = rows.select("x", "y").distinct().count()
    grown, seen = read_by(monkeypatch, lambda: trees.randomised(rows, 2, 6, 2, max_depth=3, seed=4))
    assert distinct < len(y) and seen == {distinct}
    found = rows.collect()
    x, y, h = np.array([r.x for r in found]), np.array([r.y for r in found]), np.array([r.h for r in found], np.int64).view(np.uint64)
    weight = trees.drawn_weights(h, np.arange(6), 4)
    node = grown.route(x)
    for tree in range(6):
        for n in set(node[:, tree].tolist()):
            w = weight[node[:, tree] == n, tree]
            if w.sum():
                assert grown.weight[n] == w.sum() and grown.value[n] == pytest.approx((w * y[node[:, tree] == n]).sum() / w.sum())


def test_drawn_weights_are_the_counts_of_their_chances():
    h = np.random.default_rng(2).integers(0, 1 << 63, 3000).astype(np.uint64)
    u = trees.uniform(9, np.arange(70)[None, :], h[:, None])
    assert (trees.drawn_weights(h, np.arange(70), 9) == sum((u >= c).astype(float) for c in trees._POISSON)).all()


def test_all_fits_read_rows_dealt_over_the_cores(spark, monkeypatch):
    df = spark.range(400).selectExpr("cast(id % 7 as double) a", "cast(id as double) y").coalesce(1)

    class Counting(models.LinearRegression):
        def _fit(self, dataset):
            parts.append(dataset.rdd.getNumPartitions())
            return super()._fit(dataset)

    parts: list[int] = []
    models.fit_all(df, ["a"], "y", {"linear": Counting(labelCol="y")})
    assert parts == [spark.sparkContext.defaultParallelism]


def test_samples_lie_in_as_few_partitions_as_rows_need(spark, monkeypatch):
    df = spark.range(600).selectExpr("id", "cast(id % 7 as double) a", "cast(id % 7 + id % 2 > 3 as double) label").repartition(13)
    found, crossed = [], halving._cross_validate
    monkeypatch.setattr(halving, "_cross_validate", lambda data, *a, **k: (found.append(data.rdd.getNumPartitions()), crossed(data, *a, **k))[1])
    _, rows = halving.search(df, "id", ["a"], "label", count=2, rungs=2)
    assert found == [1, 1] and len(rows) == 3


@pytest.mark.parametrize("rows, before, after", [(100, 20, 10), (100, 3, 8), (1000, 20, 20), (30, 9, 3), (0, 2, 1)])
def test_dealt_rows_are_all_there_and_even(spark, monkeypatch, rows, before, after):
    monkeypatch.setattr(automl, "TASK_ROWS", 10)
    out = automl.dealt(spark.range(rows).repartition(before))
    assert out.is_cached and sorted(r.id for r in out.collect()) == list(range(rows))
    assert out.rdd.getNumPartitions() == after
    out.unpersist()


def test_fits_of_all_candidates_share_the_cores_unless_time_is_short(spark, monkeypatch):
    df = spark.range(600).selectExpr("id", "cast(id % 7 as double) a", "cast(id % 7 + id % 2 > 3 as double) label").repartition(13)
    seen, crossed = [], automl._cross_validate

    def spied(data, settings, *a, **k):
        seen.append((data.rdd.getNumPartitions(), [c.model_id for c, _ in settings]))
        return crossed(data, settings, *a, **k)

    def found(**k):
        wanted = [automl.Candidate(n, automl.LogisticRegression(labelCol="label", regParam=r, **automl.columns_of(n))) for n, r in (("A", 0.1), ("B", 0.2))]
        return automl.search(df, "id", ["a"], "label", folds=2, wanted=wanted, stack=False, **k)

    monkeypatch.setattr(automl, "_cross_validate", spied)
    monkeypatch.setattr(automl, "TASK_ROWS", 50)
    together, one_by_one, short = found(), found(budget_seconds=1e6), found(budget_seconds=0)
    assert seen == [(1, ["A", "B"]), (1, ["A"]), (1, ["B"]), (1, ["A"])] and short.skipped == ["B"]
    assert [c[:2] for c in together.cross_validation] == [c[:2] for c in one_by_one.cross_validation]
    assert all(s > 0 for *_, s in together.cross_validation)
