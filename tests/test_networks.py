"""Networks trained in common passes against Spark's own fits."""

import numpy as np
import pytest
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tallyloom.operators import automl, networks


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 2))
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=700) > 0).astype(float)
    return spark.createDataFrame([(i, *map(float, v), float(w)) for i, (v, w) in enumerate(zip(x, y))], "id long, u double, v double, label double").repartition(3, "id").persist()


def test_grid_agrees_with_fits_of_every_setting_and_shares_passes(spark, labelled, monkeypatch):
    sizes, epochs, folds = ((3,), (4, 2)), (2, 7), 2
    stages = automl.prepare(labelled, ["u", "v"])
    data = automl.dealt(automl._folded(stages.transform(labelled), "id", folds).select("features", "label", automl.FOLD))
    base = automl.network("DeepLearning_grid", 2, "label")
    grid = ParamGridBuilder().addGrid(base.estimator.layers, [[2, *s, 2] for s in sizes]).addGrid(base.estimator.maxIter, list(epochs)).build()
    spark_says = automl._cross_validate(data, [(base, p) for p in grid], "label", folds, 2, whole=False)
    wanted = {(str(p[base.estimator.layers][1:-1]), p[base.estimator.maxIter]): auc for p, (_, _, auc) in zip(grid, spark_says)}

    passes, once = [], networks.evaluated
    monkeypatch.setattr(networks, "evaluated", lambda rows, some: (passes.append(len(some)), once(rows, some))[1])
    best, found = automl.network_grid(labelled, "id", ["u", "v"], "label", sizes, epochs, folds)
    assert {(h, e): auc for h, e, auc in found} == pytest.approx(wanted, abs=1e-9)
    assert passes[0] == len(sizes) * folds and len(passes) <= 3 * max(epochs)
    assert str(best.stages[-1].getOrDefault("layers")[1:-1]) == found[0][0]


def test_weights_on_the_way_are_those_of_shorter_fits(spark, labelled):
    rows = automl._folded(automl.prepare(labelled, ["u", "v"]).transform(labelled), "id", 3)
    net = automl.network("n", 2, "label", (4, 3)).estimator
    start = networks.model_with(spark, net).weights.toArray()
    (got,) = networks.fit_all(networks.rows_of(rows, "label", automl.FOLD), [([2, 4, 3, 2], 1, start, (1, 6, 12))])
    for steps, weights in got.items():
        own = net.fit(rows.filter(F.col(automl.FOLD) != 1), {net.maxIter: steps})
        assert np.allclose(weights, own.weights.toArray(), rtol=1e-6, atol=1e-7)
        assert np.array_equal(networks.model_with(spark, net, weights).weights.toArray(), weights)


def test_a_fit_that_stands_still_ends():
    fit, x = networks.descent(np.zeros(2), (5, 9)), next(networks.descent(np.zeros(2), (5, 9)))
    next(fit)
    with pytest.raises(StopIteration) as end:
        fit.send((0.0, np.zeros(2)))
    assert {m: w.tolist() for m, w in end.value.value.items()} == {5: x.tolist(), 9: x.tolist()}


def test_steps_that_cannot_be_evaluated_end_at_the_start():
    fit = networks.descent(np.ones(1), (3,))
    next(fit)
    sent = (1.0, np.ones(1))
    with pytest.raises(StopIteration) as end:
        for _ in range(100):
            fit.send(sent)
            sent = (np.nan, np.full(1, np.nan))
    assert end.value.value[3].tolist() == [1.0]
