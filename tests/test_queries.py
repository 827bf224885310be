"""Every query runs; those with SQL agree with it (smallest tables)."""

import pytest

import __spark_entry__ as entry
from tallyloom.plans import learning, regression
from tallyloom.plans.registration import Tables

from .conftest import SF
from .oracle import compare, connect

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(entry.queries())


# The corpus queries have tests of their own.
PLAIN = sorted(n for n in entry.queries() if n not in SQL and n != "pipeline" and not n.startswith("op"))


FEW = {"trees": 20, "rounds": 2, "default_trees": 10}
#: Queries of full size by default, with the smaller arguments of the tests.
SMALLER = {
    "all_models": (regression.all_models, FEW), "importance": (regression.importance, FEW), "elastic_net": (regression.elastic_net, FEW),
    "kmeans_scree": (learning.kmeans_scree, {"scans": ((range(1, 5), 3), (range(5, 7), 2))}),
    "kmeans_best_restart": (learning.kmeans_best_restart, {"restarts": 4}), "segments_joined": (learning.segments_joined, {"restarts": 3}),
    "grid_search": (learning.grid_search, {"grids": ((((3,), (4,)), (5,)),)}), "automl_leaderboard": (learning.automl_leaderboard, {"trees": 5, "rounds": 3}),
    "halving_search": (learning.halving_search, {"count": 6, "rungs": 2}),
}


@pytest.mark.parametrize("name", PLAIN)
def test_query_without_sql_runs(spark, name):
    spark.catalog.clearCache()
    fn, sizes = SMALLER.get(name, (None, None))
    df = fn(Tables(spark, SF), **sizes) if fn else entry.queries()[name](spark, SF)
    assert len(df.columns) > 0 and len(df.collect()) > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, duck, name):
    spark.catalog.clearCache()
    message, _, _ = compare(spark, duck, SF, name, entry.queries()[name], SQL[name])
    assert message == ""
