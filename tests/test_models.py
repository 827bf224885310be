import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyloom.operators import automl, cluster, explain, gram, linear, models, reshape
from tallyloom.operators.recipe import FittedRecipe, Recipe, fit_yeo_johnson, yeo_johnson
from tallyloom.session import scratch_path
from tallyloom.sources.registry import ModelRegistry

from .conftest import rows


@pytest.fixture(scope="module")
def plane(spark):
    """y = 3 + 2 a - b + noise, c = a + b is redundant."""
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(2, 400)) * [[3], [5]] + [[1000], [2]]
    y = 3 + 2 * a - b + rng.normal(size=400)
    data = [(i, float(p), float(q), float(p + q), float(v), "xyz"[i % 3]) for i, (p, q, v) in enumerate(zip(a, b, y))]
    return spark.createDataFrame(data, "id int, a double, b double, c double, y double, g string").persist()


def test_least_squares_against_numpy(plane):
    fit = linear.least_squares(plane, ["a", "b", "c"], "y")
    assert fit.aliased == ["c"] and fit.names == ["(Intercept)", "a", "b"]
    pdf = plane.toPandas()
    x = np.column_stack([np.ones(len(pdf)), pdf.a, pdf.b])
    beta, sse, *_ = np.linalg.lstsq(x, pdf.y, rcond=None)
    assert fit.coefficients == pytest.approx(beta, rel=1e-6)
    cov = np.linalg.inv(x.T @ x) * sse[0] / (len(pdf) - 3)
    assert fit.errors == pytest.approx(np.sqrt(np.diag(cov)), rel=1e-4)
    wide = gram.wide_cross_sums(plane, ["a", "b"], "y")
    assert wide["n"] == 400 and wide["yy"] == pytest.approx(float((pdf.y**2).sum()))


def test_student_t():
    assert gram.t_quantile(0.95, 10) == pytest.approx(2.228139, abs=1e-5)
    assert gram.t_quantile(0.95, 1) == pytest.approx(12.7062, abs=1e-3)
    assert gram.t_tail(1.959964, 1e7) == pytest.approx(0.05, abs=1e-5)
    assert gram.t_tail(2.228139, 10) == pytest.approx(0.05, abs=1e-6)


def test_coefficients_sorted_by_p(spark, plane):
    table = linear.coefficient_table(spark, linear.least_squares(plane, ["a", "b"], "y")).collect()
    assert [r.p_value for r in table] == sorted(r.p_value for r in table)


def test_intervals(spark, plane):
    fit = linear.least_squares(plane, ["b"], "y")
    points = spark.createDataFrame([(2.0,), (30.0,)], "b double")
    near, far = linear.predict_interval(points, fit).orderBy("b").collect()
    assert near.pred_lower < near.pred < near.pred_upper
    assert far.pred_upper - far.pred_lower > near.pred_upper - near.pred_lower
    boot = linear.bootstrap_interval(plane, "id", ["b"], "y", points, replicates=60).orderBy("b").first()
    assert boot.pred_lower < boot.pred < boot.pred_upper
    assert boot.pred_upper - boot.pred_lower == pytest.approx(near.pred_upper - near.pred_lower, rel=0.6)


def test_poisson_weights_have_mean_and_variance_one(spark):
    r = spark.range(20000).select(linear.poisson_weight(F.col("id"), F.lit(3)).alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert r[0] == pytest.approx(1, abs=0.03) and r[1] == pytest.approx(1, abs=0.05)


def test_interaction_equals_one_line_per_group(spark, plane):
    df, names = linear.interaction(plane, "a", "g")
    fit = linear.least_squares(df, names, "y")
    got = {r.g: r.p for r in linear.predict(df.filter("id < 3"), fit, "p").collect()}
    lines = {r.g: r for r in linear.simple_fit(plane, "a", "y", ["g"]).collect()}
    for r in plane.filter("id < 3").collect():
        assert got[r.g] == pytest.approx(lines[r.g].intercept + lines[r.g].slope * r.a, rel=1e-5)


def test_line_search_equals_direct_distance(spark, plane):
    lines = spark.createDataFrame([(3.0, 2.0), (-10.0, 1.9)], "a1 double, a2 double")
    for r in linear.line_search(plane, "a", "y", lines).collect():
        direct = linear.line_distance(plane, "a", "y", r.a1, r.a2).first()[0]
        assert r.dist == pytest.approx(direct)


def test_regression_metrics_use_squared_correlation(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, 20.0), (3.0, 30.0), (None, 1.0)], "y double, p double")
    got = {r.metric: r.estimate for r in linear.regression_metrics(df, "y", "p").collect()}
    assert got["rsq"] == pytest.approx(1) and got["mae"] == pytest.approx(18)
    assert got["rmse"] == pytest.approx(np.sqrt((81 + 324 + 729) / 3))


def test_model_families(spark, plane):
    train, test = plane.filter("id % 4 > 0"), plane.filter("id % 4 = 0")
    fitted = models.fit_all(train, ["a", "b"], "y", models.regressors("y", 2, trees=5, rounds=3))
    table = models.metrics_all(fitted, test, "y")
    assert table.count() == 18
    rsq = {r.model_id: r.estimate for r in table.filter("metric = 'rsq'").collect()}
    assert rsq["linear"] > 0.9 and rsq["forest"] > 0.5
    first = models.importance(spark, fitted["tree"], ["a", "b"]).collect()
    assert sum(r.importance for r in first) == pytest.approx(1)
    flow = models.workflow(["a", "b"], models.regressors("y", 2)["linear"]).fit(train)
    assert flow.transform(test).count() == test.count()


def test_recipe_normalises_training_rows_and_names_dummies(spark, plane):
    df = plane.withColumns({"same": F.lit(1), "day": F.to_date(F.lit("2024-12-25"))})
    steps = (
        Recipe("y", ids=["id"]).drop_constant().power_transform(["b"]).normalise("a", "b", "c").dummies()
    )
    fitted = steps.fit(df.filter("id < 300"))
    baked = fitted.bake(df.filter("id < 300"))
    assert "same" not in baked.columns and {"g_y", "g_z"} <= set(baked.columns) and "g_x" not in baked.columns
    r = baked.agg(F.avg("a"), F.stddev_samp("a"), F.avg("b"), F.stddev_samp("b")).first()
    assert list(r) == pytest.approx([0, 1, 0, 1], abs=1e-9)
    again = FittedRecipe.from_json(fitted.to_json())
    assert rows(again.bake(df)) == rows(fitted.bake(df))
    assert fitted.learned(spark).filter("statistic = 'lambdas'").count() == 1
    unseen = fitted.bake(df.withColumn("g", F.lit("new"))).first()
    assert unseen.g_y is None
    dated = Recipe("y").date_parts("day").holidays("day", ["ChristmasDay"]).fit(df).bake(df).first()
    assert (dated.day_dow, dated.day_month, dated.day_ChristmasDay) == ("Wed", "Dec", 1)


def test_yeo_johnson_finds_a_log_like_parameter(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(v),) for v in np.exp(rng.normal(2, 0.5, size=2000)) - 1], "v double")
    lam = fit_yeo_johnson(df, ["v"])["v"]
    assert abs(lam) < 0.15
    r = spark.createDataFrame([(3.0, -3.0)], "p double, n double").select(
        yeo_johnson(F.col("p"), 0.0), yeo_johnson(F.col("n"), 2.0), yeo_johnson(F.col("p"), 1.0), yeo_johnson(F.col("n"), 1.0)
    ).first()
    assert list(r) == pytest.approx([np.log(4), -np.log(4), 3, -3])


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(v) for v in rng.normal(size=2) + 20 * np.array([i % 3, (i % 3) ** 2])]) for i in range(150)]
    return reshape.array_vectors(spark.createDataFrame(data, "id int, x array<double>"), "x").persist()


def test_clusters(spark, blobs):
    found = cluster.scan(blobs, [(k, 2) for k in (1, 2, 3, 4)])
    table = cluster.scree_table(spark, found).orderBy("k").collect()
    assert [r.k for r in table] == [1, 2, 3, 4]
    assert all(a.withinss >= b.withinss for a, b in zip(table, table[1:]))
    assert table[0].withinss == table[0].totss and table[0].betweenss == 0
    three = found[2]
    assigned = cluster.assign(blobs, three.centers)
    centers = cluster.centers_table(spark, assigned, three.centers)
    assert sorted(r["size"] for r in centers.collect()) == [50, 50, 50]
    assert sum(r.withinss for r in centers.collect()) == pytest.approx(three.withinss, rel=1e-6)
    fixed = [(i + 1, list(c)) for i, c in enumerate(three.centers)]
    nearest = cluster.nearest_center(blobs, "x", fixed, "near").join(assigned.select("id", "cluster"), "id")
    assert nearest.filter("near <> cluster").count() == 0
    about = spark.range(150).select(F.col("id").cast("int").alias("id"), (F.col("id") % 7).alias("info"))
    joined = cluster.segments(blobs, three.centers, "id", about)
    assert joined.count() == 150 and {"x", "y", "cluster", "info", "label_text"} <= set(joined.columns)


@pytest.fixture(scope="module")
def two_class(spark):
    """The label follows u; v is noise; w is a category that shifts it."""
    df = spark.range(600).select(
        F.col("id"),
        (F.pmod(F.hash("id"), F.lit(1000)) / 1000.0).alias("u"),
        (F.pmod(F.hash(F.col("id"), F.lit(5)), F.lit(1000)) / 1000.0).alias("v"),
    )
    return df.withColumn("label", (F.col("u") + 0.2 * F.col("v") > 0.6).cast("double")).persist()


def test_search_stack_and_registry(spark, two_class):
    train, test = two_class.filter("id % 4 > 0"), two_class.filter("id % 4 = 0")
    wanted = automl.candidates(2, "label", trees=5, rounds=2)[:2]
    found = automl.search(train, "id", ["u", "v"], "label", folds=3, wanted=wanted)
    assert list(found.models) == ["GLM_1", "DRF_1", automl.STACKED] and found.cv_table(spark).count() == 3
    board = automl.board(found, test, "id", "label").collect()
    assert [r.auc for r in board] == sorted((r.auc for r in board), reverse=True) and board[0].auc > 0.95
    together = automl.score(found.models, test, "id", "label")
    apart = automl.score({"GLM_1": found.models["GLM_1"]}, test, "id", "label")
    assert rows(together.filter("model_id = 'GLM_1'")) == rows(apart)

    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    for name, model in found.models.items():
        registry.save(name, model, "label", ["u", "v"], {"auc": 0.9})
    assert sorted(r.model_id for r in registry.listing().collect()) == sorted(found.models)
    assert registry.table().count() == 3
    loaded = automl.score(registry.load_all(), test, "id", "label")
    assert rows(loaded) == rows(together)
    assert registry.parameters().filter("model_id = 'DRF_1' and param = 'numTrees' and value = '5'").count() == 1


def test_search_budget_skips_but_fits_one(two_class):
    wanted = automl.candidates(2, "label", trees=3, rounds=2)[:3]
    found = automl.search(two_class, "id", ["u", "v"], "label", folds=2, budget_seconds=0.0, wanted=wanted)
    assert list(found.models) == ["GLM_1"] and found.skipped == ["DRF_1", "DeepLearning_1"]


def test_network_grid_is_sorted(two_class):
    model, grid = automl.network_grid(two_class, "id", ["u", "v"], "label", hidden=[(2,), (4,)], epochs=[5, 20], folds=2)
    assert len(grid) == 4 and [g[2] for g in grid] == sorted((g[2] for g in grid), reverse=True)
    assert model.transform(two_class).count() == 600


def test_explanation_recovers_a_known_linear_model(spark, two_class):
    data = two_class.withColumn("w", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    explainer = explain.fit_explainer(data, ["u", "v"], ["w"])
    assert [len(s) for s in explainer.shares.values()] == [4, 4, 2]
    assert all(sum(s) == pytest.approx(1) for s in explainer.shares.values())

    def score(df):
        return df.withColumn("score", 0.1 + 0.7 * F.col("u") + 0.1 * F.col("v"))

    cases = data.orderBy(F.desc("u")).limit(2)
    got = explain.explain(cases, "id", explainer, score, n_features=3, n_permutations=1200)
    table = got.collect()
    assert len(table) == 6
    for case in {r.case for r in table}:
        w = {r.feature: r.feature_weight for r in table if r.case == case}
        assert w["u"] > 0.2 and abs(w["v"]) < w["u"] and abs(w["w"]) < 0.02
    first = table[0]
    assert first.label == "Yes" and 0 <= first.model_r2 <= 1 and first.label_prob > 0.5
    assert rows(got) == rows(explain.explain(cases, "id", explainer, score, n_features=3, n_permutations=1200))
    view = explain.case_view(got, first.case).collect()
    assert {r.direction for r in view if r.feature_weight > 0} == {"Supports"}
    ordered = [r.feature for r in explain.heat_map(got).collect()]
    assert ordered == sorted(ordered)
    wide = explain.heat_map_wide(got, sorted({r.case for r in table}))
    assert len(wide.columns) == 3
    texts = {r.feature: r.feature_desc for r in table}
    assert texts["u"].endswith("< u") and texts["w"].startswith("w = ")


def test_explainer_bins_count_all_rows(two_class):
    t = explain.explainer_table(two_class, ["u", "v"])
    assert {r.feature: r.n for r in t.groupBy("feature").agg(F.sum("n").alias("n")).collect()} == {"u": 600, "v": 600}


def test_registered_sizes_are_those_of_the_reference(spark, monkeypatch):
    """Full sizes by default, fewer only by argument."""
    from tallyloom.plans import learning, regression
    from tallyloom.plans.registration import Tables

    full = models.regressors("y", 40)
    assert (full["forest"].getNumTrees(), full["forest_default"].getNumTrees(), full["boosted"].getMaxIter()) == (5000, 500, 15)
    names = [c.model_id for c in automl.candidates(2, "label")]
    assert "SVC_1" in names and automl.candidates(2, "label")[1].estimator.getNumTrees() == 50

    class Seen(Exception):
        pass

    seen = []

    def scan(vectors, wanted, *a, **b):
        seen.append(list(wanted))
        return []

    def grid(train, key, features, label, hidden, epochs, **b):
        seen.append((list(hidden), list(epochs)))
        return None, []

    def fit_all(train, features, label, estimators):
        raise Seen({n: e for n, e in estimators.items()})

    t = Tables(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(cluster, "scan", scan)
    monkeypatch.setattr(automl, "network_grid", grid)
    monkeypatch.setattr(models, "fit_all", fit_all)
    learning.kmeans_scree(t)
    for run in (learning.kmeans_best_restart, learning.segments_joined):
        with pytest.raises(IndexError):
            run(t)
    learning.grid_search(t)
    assert seen == [
        [(k, 100 if k < 16 else 20) for k in range(1, 31)], [(3, 100)], [(4, 20)],
        ([(10, 10), (20, 20), (30, 30)], [10, 20, 30]), ([(10, 10, 10), (50, 20, 10), (20, 20, 20)], [10, 50, 100]),
    ]
    for sizes, trees in (({}, 5000), ({"trees": 3}, 3)):
        with pytest.raises(Seen) as got:
            regression.all_models(t, **sizes)
        assert got.value.args[0]["forest"].getNumTrees() == trees


def test_support_vectors_join_the_search(two_class, spark):
    wanted = [c for c in automl.candidates(2, "label") if c.model_id in ("GLM_1", "SVC_1")]
    found = automl.search(two_class, "id", ["u", "v"], "label", folds=2, wanted=wanted)
    assert set(found.models) == {"GLM_1", "SVC_1", automl.STACKED}
    scores = automl.score(found.models, two_class, "id", "label").filter("model_id = 'SVC_1'").collect()
    assert all(0 <= r.score <= 1 for r in scores) and dict((m, a) for m, a, _ in found.cross_validation)["SVC_1"] > 0.7
