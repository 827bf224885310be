"""Operators that advance many models in common passes: k-means, projections, trees, bootstrap."""

import itertools

import duckdb
import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyloom.operators import cluster, joins, linear, manymeans, projection, reshape, trees

# --- k-means --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(4, 3)) * 8
    data = [(i, [float(v) for v in middle[i % 4] + rng.normal(size=3)]) for i in range(400)]
    df = spark.createDataFrame(data, "id int, x array<double>").repartition(5)
    return reshape.array_vectors(df, "x").persist()


def test_many_models_are_no_worse_than_single_fits(spark, points):
    wanted = [(2, 6), (3, 6), (4, 6), (5, 12)]
    found = cluster.scan(points, wanted)
    for c, (k, restarts) in zip(found, wanted):
        own = min(KMeans(k=k, seed=1 + r, maxIter=20, featuresCol="features").fit(points).summary.trainingCost for r in range(restarts))
        assert c.withinss <= own * (1 + 1e-9), k


def test_within_sums_follow_from_the_centers(spark, points, tmp_path):
    rows = [(c.k, i, [float(v) for v in x]) for c in cluster.scan(points, [(k, 3) for k in (1, 2, 3, 6)]) for i, x in enumerate(c.centers)]
    found = {c.k: c.withinss for c in cluster.scan(points, [(k, 3) for k in (1, 2, 3, 6)])}
    spark.createDataFrame(rows, "k int, i int, c array<double>").write.parquet(f"{tmp_path}/c")
    points.select("id", "x").write.parquet(f"{tmp_path}/p")
    sums = duckdb.sql(
        f"""SELECT k, sum(d) FROM (SELECT k, id, min(list_distance(x, c) ** 2) AS d FROM '{tmp_path}/p/*.parquet', '{tmp_path}/c/*.parquet' GROUP BY ALL) GROUP BY k"""
    ).fetchall()
    assert {k: pytest.approx(v) for k, v in sums} == found
    whole = [c for c in cluster.scan(points, [(1, 1)])][0]
    assert whole.withinss == pytest.approx(cluster.total_ss(points)) == pytest.approx(whole.totss)


def test_models_do_not_depend_on_partitions(points):
    one = manymeans.fit_all(points.coalesce(1), [(3, 1), (3, 2), (4, 9)])
    two = manymeans.fit_all(points.repartition(7), [(4, 9), (3, 2), (3, 1)])[::-1]
    for (a, v, n), (b, w, m) in zip(one, two):
        assert np.allclose(np.sort(a, 0), np.sort(b, 0)) and v == pytest.approx(w) and n == m


def test_fewer_vectors_than_clusters_and_none(spark):
    df = reshape.array_vectors(spark.createDataFrame([([1.0, 2.0],)] * 5 + [([3.0, 4.0],)] + [(None,)], "x array<double>").filter("x is not null"), "x")
    found = cluster.scan(df, [(4, 2)])[0]
    assert len(found.centers) == 2 and found.withinss == pytest.approx(0)
    assert cluster.scan(df.limit(0), [(2, 3)], totss=0.0)[0].centers is None


def test_nearest_of_very_many_centers(spark):
    centers = [(i, [float(i), 0.0]) for i in range(3000)]
    df = spark.createDataFrame([(7, [7.2, 1.0]), (0, None), (2999, [1e9, 0.0]), (1, [1.5, 0.0])], "want int, x array<double>")
    out = cluster.nearest_center(df, "x", centers, "near").select("want", "near", "distance").collect()
    assert {(r.want, r.near) for r in out} == {(7, 7), (0, None), (2999, 2999), (1, 1)}
    assert {r.want: r.distance for r in out}[7] == pytest.approx(np.hypot(0.2, 1.0))


# --- projection -----------------------------------------------------------------------------------------------------


def test_components_are_those_of_the_covariance(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 40)) @ np.diag(np.linspace(5, 0.1, 40)) + 3
    x[:, 7] = 0
    data = [(i, Vectors.dense(v) if i % 2 else Vectors.sparse(40, [(j, float(a)) for j, a in enumerate(v) if a])) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, ["id", "features"]).repartition(3)
    mean, components, variance = projection.leading_components(df, 2)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(variance, values[::-1][:2]) and np.allclose(np.abs(np.sum(components * vectors[:, ::-1][:, :2], 0)), 1, atol=1e-6)
    placed = {r.id: (r.x, r.y) for r in projection.scores(df, (mean, components, variance), ["id"], ["x", "y"]).collect()}
    assert np.allclose(np.array([placed[i] for i in range(300)]), x @ components)


def test_very_many_sparse_columns(spark):
    width = 50_000
    rng = np.random.default_rng(2)
    # Two groups of users with items of their own: the first component tells them apart.
    data = [(i, Vectors.sparse(width, sorted({int(v) + (i % 2) * 25_000: 1.0 for v in rng.integers(0, 50, 20)}.items()))) for i in range(60)]
    df = spark.createDataFrame(data, ["id", "features"])
    mean, components, _ = projection.leading_components(df, 2)
    placed = {r.id: r.x for r in projection.scores(df, (mean, components, None), ["id"], ["x", "y"]).collect()}
    assert max(placed[i] for i in range(0, 60, 2)) < min(placed[i] for i in range(1, 60, 2)) or min(placed[i] for i in range(0, 60, 2)) > max(placed[i] for i in range(1, 60, 2))


# --- trees ----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, 9, 240), rng.normal(size=240).round(2), rng.integers(0, 2, 240)], 1).astype(float)
    y = (x[:, 0] > 4) * 5 + x[:, 2] * x[:, 1] * 3 + rng.normal(size=240).round(3)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "y"]).repartition(4)
    return x, y, df, trees.rows_of(df, "features", "y").persist()


def error(y):
    return float(((y - y.mean()) ** 2).sum()) if len(y) else 0.0


def own_rows(tree, x, root=0):
    """Rows of every node."""
    out, stack = {}, [(root, np.arange(len(x)))]
    while stack:
        node, rows = stack.pop()
        out[node] = rows
        if tree.feature[node] >= 0:
            right = x[rows, tree.feature[node]] > tree.threshold[node]
            stack += [(tree.left[node], rows[~right]), (tree.left[node] + 1, rows[right])]
    return out


def test_single_tree_takes_the_best_split_everywhere(table):
    x, y, _, rows = table
    grown = trees.single(rows, 3, 3, 7, 0.0)[1]
    for node, own in own_rows(grown.trees, x).items():
        assert grown.trees.weight[node] == len(own) and grown.trees.value[node] == pytest.approx(y[own].mean())
        if grown.trees.feature[node] < 0:
            continue
        best = max(
            (error(y[own]) - error(y[own][left]) - error(y[own][~left]))
            for f in range(3) for c in np.unique(x[own, f])[:-1] for left in [x[own, f] <= c] if min(left.sum(), (~left).sum()) >= 2
        )
        if len(np.unique(x[:, 1])) <= trees.EDGES:
            assert grown.trees.gain[node] == pytest.approx(best)
        assert grown.trees.gain[node] <= best + 1e-6


def test_pruned_tree_is_the_best_of_all_subtrees(table):
    x, y, _, rows = table
    grown = trees.single(rows, 3, 3, 7, 0.0)[1]
    tree, risk = grown.trees, trees.risks(grown.sums)
    for node, own in own_rows(tree, x).items():
        assert risk[node] == pytest.approx(error(y[own]), abs=1e-6)

    def subtrees(node):
        yield risk[node], 1
        if tree.feature[node] >= 0:
            for (a, n), (b, m) in itertools.product(list(subtrees(tree.left[node])), list(subtrees(tree.left[node] + 1))):
                yield a + b, n + m

    every = list(subtrees(0))
    links = trees.weakest_links(tree, risk)
    assert [p for p, *_ in links] == sorted(p for p, *_ in links) and links[-1][2] == 1
    for penalty in [0.0, *[p * f for p, *_ in links for f in (0.99, 1.01)]]:
        cut = trees.pruned(tree, risk, penalty)
        leaves = [n for n in own_rows(cut, x) if cut.feature[n] < 0]
        best = min((r + penalty * n, n) for r, n in every)
        assert sum(risk[leaves]) + penalty * len(leaves) == pytest.approx(best[0])


def test_boosting_takes_penalised_steps(table):
    x, y, df, rows = table
    start, one = trees.boosted(rows, 3, 1, 0.25, 3)
    assert start == pytest.approx(y.mean())
    for node, own in own_rows(one, x).items():
        if one.feature[node] < 0:
            assert one.value[node] == pytest.approx((y[own] - start).sum() / (len(own) + 1))
    model = trees.SecondOrderBoosting(labelCol="y", rounds=12, rate=0.25, max_depth=3).fit(df)
    pred = np.array([(r.prediction, r.y) for r in model.transform(df).collect()])
    assert ((pred[:, 0] - pred[:, 1]) ** 2).sum() < 0.3 * error(y)
    assert sum(model.featureImportances) == pytest.approx(1)


def test_randomised_trees_sum_what_brute_force_sums(table):
    x, y, df, rows = table
    grown = trees.randomised(rows, 3, 7, 2, min_n=10, max_depth=4, seed=3, replace=False)
    for root in grown.roots:
        for node, own in own_rows(grown, x, root).items():
            assert grown.weight[node] == len(own) > 0 and grown.value[node] == pytest.approx(y[own].mean())
            if grown.feature[node] >= 0:
                f, c = grown.feature[node], grown.threshold[node]
                assert len(own) >= 10 and x[own, f].min() <= c < x[own, f].max()
                left = x[own, f] <= c
                assert grown.gain[node] == pytest.approx(error(y[own]) - error(y[own][left]) - error(y[own][~left]))
    thresholds = {(int(f), round(float(c), 9)) for f, c in zip(grown.feature[grown.roots], grown.threshold[grown.roots])}
    assert len(thresholds) > 3  # drawn anew in every tree


def test_randomised_trees_weigh_rows_and_do_not_depend_on_partitions(table):
    x, y, df, rows = table
    a = trees.randomised(rows, 3, 5, 2, max_depth=3, seed=4)
    b = trees.randomised(rows.coalesce(1), 3, 5, 2, max_depth=3, seed=4)
    assert (a.feature == b.feature).all() and np.allclose(a.threshold, b.threshold) and np.allclose(a.value, b.value)
    total = a.weight[a.roots]
    assert len(set(total)) > 1 and all(180 < w < 300 for w in total)
    h = np.arange(200_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = trees.drawn_weights(h, np.array([5]), 1)
    assert counts.mean() == pytest.approx(1, abs=0.02) and counts.var() == pytest.approx(1, abs=0.03)


def test_trees_of_groups_are_those_of_one(table, monkeypatch):
    _, _, _, rows = table
    x = table[0]
    a = trees.randomised(rows, 3, 5, 2, max_depth=3, seed=4)
    monkeypatch.setattr(trees, "TOGETHER", 2)
    b = trees.randomised(rows, 3, 5, 2, max_depth=3, seed=4)
    assert np.allclose(a.predict(x, 0.0, 1.0), b.predict(x, 0.0, 1.0)) and np.allclose(a.importance(3), b.importance(3))


# --- bootstrap ------------------------------------------------------------------------------------------------------


def test_batches_draw_the_counts_of_the_column_function(spark):
    df = spark.range(300).withColumn("h", F.xxhash64("id"))
    reps = F.explode(F.sequence(F.lit(1), F.lit(7)))
    want = {(r.id, r.rep): r.w for r in df.select("id", reps.alias("rep")).withColumn("w", linear.poisson_weight(F.col("id"), F.col("rep"), F.lit(3))).collect()}
    rows = df.collect()
    counts = linear.drawn_counts(np.array([r.h for r in rows], np.int64).view(np.uint64), 7, 3)
    assert {(r.id, k + 1): counts[k, i] for i, r in enumerate(rows) for k in range(7)} == want


def test_bootstrap_reads_every_row_once(spark):
    df = spark.range(2000).select("id", (F.col("id") % 50).cast("double").alias("x")).withColumn("y", 3 + 2 * F.col("x") + (F.hash("id") % 7))
    found = linear.bootstrap_interval(df, "id", ["x"], "y", joins.expand_grid(spark, x=[10.0]), replicates=100)
    (r,) = found.collect()
    assert r.pred_lower < 23 + df.agg(F.avg(F.hash("id") % 7)).first()[0] < r.pred_upper and r.pred_upper - r.pred_lower < 1
