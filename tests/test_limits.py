"""Sizes and kinds of values at which a plan changes must not change a result."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import explain, factors, joins, ordering, profile

from .conftest import rows


@pytest.mark.parametrize(
    "kind, make",
    [
        ("date", lambda i: dt.date(2020, 1, 1 + i)),
        ("timestamp", lambda i: dt.datetime(2020, 1, 1, i)),
        ("timestamp_ntz", lambda i: dt.datetime(2020, 1, 1, i)),
        ("binary", lambda i: bytes([i, 200 + i])),
        ("decimal(10,2)", lambda i: Decimal(i) / 4 - 1),
        ("string", lambda i: f"g{i}"),
        ("boolean", lambda i: i % 2 == 0),
        ("double", lambda i: i / 3),
    ],
)
def test_running_in_slices_for_every_kind_of_group(spark, kind, make):
    data = [(make(i % 3) if i % 3 or i % 2 else None, i, float(i)) for i in range(60)]
    df = spark.createDataFrame(data, f"g {kind}, o int, x double").repartition(4)
    args = dict(by=["g"], order=["o"], row_number="n", cumsum={"s": "x"}, previous={"p": "x"}, carry={"c": "x"})
    whole = ordering.running(df, **args)
    assert rows(ordering.running(df, **args, rows_per_task=5)) == rows(whole)
    by_group = dict(by=[], order=["g", "o"], row_number="n")
    assert rows(ordering.running(df, **by_group, rows_per_task=5)) == rows(ordering.running(df, **by_group))


def test_corrections_are_equal_when_joined(spark, monkeypatch):
    df = spark.range(50).select((F.col("id") % 2).alias("g"), "id")
    args = dict(by=["g"], order=["id"], row_number="n", rows_per_task=5)
    few = rows(ordering.running(df, **args))
    monkeypatch.setattr(ordering, "FEW_SLICES", 1)
    assert rows(ordering.running(df, **args)) == few


def test_histogram_and_codes_of_many_levels(spark, monkeypatch):
    df = spark.range(3000).select(F.format_string("name %05d", "id").alias("t"), (F.col("id") % 4).cast("string").alias("u"))
    out = profile.histogram(df, bins=10).filter("key = 't'").collect()
    assert sum(r.n for r in out) == 3000 and len(out) == 10
    small = df.filter("id < 40" if "id" in df.columns else "t < 'name 00040'").union(spark.createDataFrame([(None, "9")], "t string, u string"))
    written = rows(profile.numbers_only(small))
    monkeypatch.setattr(factors, "MAX_LEVELS", 3)
    assert rows(profile.numbers_only(small)) == written


def test_large_dictionaries_decode_by_join(spark, monkeypatch):
    df = spark.createDataFrame([(1, 2), (2, None), (9, 1)], "a int, b int")
    names = spark.createDataFrame([("a", 1.0, "one"), ("a", 2.0, "two"), ("b", 2.0, "zwei"), ("c", 1.0, "x")], "column_name string, key double, value string")
    small = rows(joins.decode(df, names)), rows(joins.decode(df, names, keep_code=True))
    monkeypatch.setattr(joins, "MAX_DICTIONARY", 1)
    assert (rows(joins.decode(df, names)), rows(joins.decode(df, names, keep_code=True))) == small


def test_split_keeps_unlisted_and_missing_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "seventh"), (4, None)], "i int, t string")
    parts = joins.split_by(df, "t", ["a", "b"])
    assert rows(joins.merge(list(parts.values()))) == rows(df)
    assert [r.i for r in parts[joins.REST].collect()] in ([3, 4], [4, 3])


def test_missing_values_are_in_no_bin(spark):
    df = spark.createDataFrame([(float(i) if i >= 60 else None, "x" if i % 4 else None) for i in range(100)], "v double, t string")
    fitted = explain.fit_explainer(df, ["v"], ["t"])
    assert fitted.shares == {"v": [0.25] * 4, "t": [1.0]}
    assert {(r.feature, r.bin): r.share for r in explain.explainer_table(df, ["v"], ["t"]).collect()} == {**{("v", b): 0.25 for b in range(4)}, ("t", 0): 1.0}
    case = spark.createDataFrame([("c", None, "x"), ("d", 70.0, None)], "key string, v double, t string")
    drawn = explain.perturb(case, "key", fitted, 200, 3)
    own = drawn.filter("__draw = 1").collect() if "__draw" in drawn.columns else drawn.collect()
    missing = drawn.filter("key = 'c'").agg(F.sum("__z0"), F.count("*")).first()
    assert missing[0] == 1.0 and missing[1] == 200 and len(own) >= 2
    found = explain.explain(case, "key", fitted, lambda d: d.withColumn("score", F.coalesce(F.col("v") / 100, F.lit(0.1))), n_features=2, n_permutations=300)
    assert {r.feature_desc for r in found.filter("case = 'c' and feature = 'v'").collect()} <= {"v missing"}
