"""Quantiles by brackets, densities, halving, themes, levels found in the data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import automl, density, halving, joins, profile, quantiles, reshape
from tallyloom.plans import learning
from tallyloom.plans.registration import Tables

from .conftest import rows


@pytest.mark.parametrize("fetched", [0, 40, 20_000])
def test_brackets_find_exact_places(spark, monkeypatch, fetched):
    monkeypatch.setattr(quantiles, "FETCHED", fetched)
    rng = np.random.default_rng(4)
    a = np.concatenate([rng.normal(size=300), [0.0, -0.0, 1e300, -1e300, 5e-324, float("inf")]])
    b = rng.integers(-3, 4, size=len(a)).astype(float)
    data = [(float(x), float(y), None if i % 3 else float(i), None, int(i) - 7) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e long").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.33, 0.5, 0.9, 0.999, 1.0]
    found = {(r.key, r.prob): r.value for r in quantiles.quantiles(df, ["a", "b", "c", "d", "e"], probs).collect()}
    columns = {"a": a, "b": b, "c": np.arange(0.0, len(a), 3), "e": np.arange(len(a)) - 7.0}
    assert {k for k, _ in found} == set(columns)
    for name, values in columns.items():
        values = np.sort(values)
        for p in probs:
            at = (len(values) - 1) * p
            low, high = values[int(np.floor(at))], values[int(np.ceil(at))]
            assert found[name, p] == (low if low == high else low + (high - low) * (at - np.floor(at))), (name, p)


def test_quantiles_do_not_depend_on_the_task_size_or_partitions(spark):
    df = spark.range(500).select((F.sin("id") * 1e6).alias("x"), (F.col("id") % 9).cast("double").alias("y"), F.lit("g").alias("g"))
    probs = [0.1, 0.333, 0.5, 0.77]
    some = [rows(quantiles.quantiles(d, ["x", "y"], probs, rows_per_task=n)) for d, n in ((df, 5), (df, 10**6), (df.coalesce(1), 5), (df.repartition(7), 99))]
    assert all(s == some[0] for s in some)
    assert [r[1:] for r in rows(quantiles.quantiles(df, ["x", "y"], probs, ["g"], rows_per_task=5))] == some[0]


def test_densities_next_to_a_plain_kernel(spark):
    rng = np.random.default_rng(6)
    data = [(("a", "b", None)[i % 3], float(v), 2.0, None if i % 5 else float(v) * 3) for i, v in enumerate(rng.normal(size=900) + np.arange(900) % 3)]
    df = spark.createDataFrame(data, "k string, v double, same double, w double")
    out = density.class_densities(df, ["v", "same", "w"], "k").collect()
    assert {r.key for r in out} == {"v", "w"} and {r.k for r in out} == {"a", "b", None}
    for key in ("v", "w"):
        for k in ("a", "b", None):
            own = sorted((r.x, r.density, r.n, r.bandwidth) for r in out if r.key == key and r.k == k)
            values = np.array([d[1 if key == "v" else 3] for d in data if d[0] == k and d[1 if key == "v" else 3] is not None])
            assert len(own) == density.POINTS and own[0][2] == len(values)
            x = np.array([o[0] for o in own])
            h = 1.06 * values.std(ddof=1) * len(values) ** -0.2
            exact = np.exp(-0.5 * ((x[:, None] - values[None, :]) / h) ** 2).sum(1) / (len(values) * h * np.sqrt(2 * np.pi))
            assert own[0][3] == pytest.approx(h)
            assert np.abs(np.array([o[1] for o in own]) - exact).max() < 0.03 * exact.max()
    assert density.class_densities(df.limit(0), ["v"], "k").collect() == []


def test_halving_nests_its_samples_and_keeps_every_setting(spark):
    df = spark.range(600).select(
        "id", (F.hash("id") % 100 / 50.0).alias("u"), (F.hash("id", F.lit(1)) % 100 / 50.0).alias("v")).withColumn(
        "label", (F.col("u") + F.hash("id", F.lit(2)) % 10 / 40.0 > 0).cast("double"))
    parts = [{r.id for r in halving.sample(df, "id", s).collect()} for s in halving.shares(3, 3)]
    assert parts[0] < parts[1] < parts[2] and len(parts[2]) == 600 and 30 < len(parts[0]) < 110
    model, found = halving.search(df, "id", ["u", "v"], "label", count=9, rungs=2, keep=3)
    assert [r[3] for r in found].count(0) == 9 and [r[3] for r in found].count(1) == 3
    first = [r for r in found if r[3] == 0]
    assert {r[0] for r in first if r[6]} == {r[0] for r in found if r[3] == 1}
    assert min(r[5] for r in first if r[6]) >= max(r[5] for r in first if not r[6])
    assert [r[6] for r in found if r[3] == 1].count(True) == 1 and found[-1][4] == 600
    best = next(r[0] for r in found if r[3] == 1 and r[6])
    own = automl.columns_of(best)["probabilityCol"]
    assert own in model.transform(df).columns
    again = [(c.model_id, s) for c, _, s in halving.drawn(2, "label", 12)]
    assert again == [(c.model_id, s) for c, _, s in halving.drawn(2, "label", 12)] and len({str(s) for _, s in again}) == 12
    assert halving.board(spark, found).count() == 12


def test_all_eight_themes(spark):
    names = ["Age", "MonthlyIncome", "HourlyRate", "JobSatisfaction", "PerformanceRating", "OverTime", "TrainingTimes", "YearsAtCompany", "JobLevel", "DistanceFromHome"]
    df = spark.range(50).select(*[((F.col("id") * (i + 3)) % 17).cast("double").alias(n) for i, n in enumerate(names)], (F.col("id") % 2).cast("double").alias("Attrition"))
    out = profile.theme_correlations(df, "Attrition").collect()
    assert {r.theme for r in out} == set(profile.THEMES)
    whole = {r.feature: r.correlation for r in profile.correlation_with(df, "Attrition").collect()}
    assert all(r.correlation == pytest.approx(whole[r.feature]) for r in out)
    assert {r.feature for r in out if r.theme == "compensation"} >= {"MonthlyIncome", "HourlyRate"}
    assert profile.theme_correlations(df.select("Attrition"), "Attrition").collect() == []


def test_wide_columns_come_from_the_data(spark):
    df = spark.createDataFrame([("u", "a", 1.0), ("u", "SEVENTH", 2.0), ("v", None, 3.0), ("v", "a", None)], "u string, i string, v double")
    wide = reshape.widen(df, ["u"], "i", "v", fill=0.0)
    assert wide.columns == ["u", "NA", "SEVENTH", "a"]
    assert rows(wide) == [("u", 0.0, 2.0, 1.0), ("v", 3.0, 0.0, None)]
    parts = joins.split_by(df, "i")
    assert set(parts) == {"a", "SEVENTH", joins.REST} and sum(p.count() for p in parts.values()) == 4


def test_distinct_values_are_counted_in_their_own_types(spark):
    big = 2**53
    df = spark.createDataFrame([(big, 1.0, True, None), (big + 1, 1.0, False, "x"), (None, None, True, "x")], "a long, b double, c boolean, d string")
    df = df.withColumns({"e": F.to_date(F.lit("2024-01-01")), "f": F.lit(1.5).cast("decimal(5,2)")})
    assert dict(rows(profile.cardinality(df, ["a", "b", "c", "d", "e", "f"]))) == {"a": 3, "b": 2, "c": 2, "d": 2, "e": 1, "f": 1}
    shown = profile.native_long(df, ["a", "b"])._jdf.queryExecution().toString()
    assert "as string" not in shown.replace("null as string", "").replace("cast(null as string)", "")
    kinds = {r.key: r.n_unique for r in profile.column_profile(df.select("a", "b", "d")).collect()}
    assert kinds == {"a": 2, "b": 1, "d": 1}


def test_best_network_of_a_grid_is_saved_and_scores_alike(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    out = learning.grid_search(t, grids=((((3,), (4,)), (5,)),)).collect()
    (saved,) = [r for r in out if r.saved_as]
    assert saved.cv_auc == max(r.cv_auc for r in out) and len(out) == 2
    from pyspark.ml import PipelineModel

    train, _, test = learning._three_parts(learning._label(learning._documents(t)))
    again = PipelineModel.load(saved.saved_as)
    fresh, _ = automl.network_grid(train, "doc_id", learning.FEATURES, "label", ((3,), (4,)), (5,))
    own = automl.columns_of("DeepLearning_grid")["probabilityCol"]
    scores = [[tuple(r[own]) for r in m.transform(test).orderBy("doc_id").collect()] for m in (again, fresh)]
    assert np.allclose(scores[0], scores[1])


def test_unlabelled_documents_are_scored(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    every = learning._all_documents(t)
    assert every.count() == t.documents.count() and every.filter("quality is null").count() > 0
    assert every.filter("n_chars is null").count() == 0
