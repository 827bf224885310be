"""The sliced running calculations must equal the plain ones."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators.ordering import Size, average_rank, down, measure, ntile, running

from .conftest import rows


@pytest.fixture(scope="module")
def uneven(spark):
    """One key holds a third of all rows; keys and values have gaps."""
    df = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 41).cast("string")))
        .alias("key"),
        F.pmod(F.hash("id"), F.lit(50)).alias("score"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 13)).alias("amount"),
    )
    return df.repartition(7)


@pytest.mark.parametrize("by", [[], ["key"]])
@pytest.mark.parametrize("rows_per_task", [40, 700])
def test_sliced_equals_plain(uneven, by, rows_per_task):
    wanted = dict(
        row_number="pos", cumsum={"total": "amount"}, previous={"before": "amount"}, carry={"last": "amount"}
    )
    order = [-F.col("score"), "id"]
    plain = running(uneven, by, order, rows_per_task=10**9, **wanted)
    sliced = running(uneven, by, order, rows_per_task=rows_per_task, **wanted)
    assert plain.columns == sliced.columns
    assert rows(plain) == rows(sliced)


def test_plain_matches_pandas(uneven):
    pdf = uneven.toPandas().sort_values(["score", "id"], ascending=[False, True])
    expect = pdf.assign(pos=range(1, len(pdf) + 1), total=pdf["amount"].cumsum().ffill())
    got = running(uneven, [], [-F.col("score"), "id"], row_number="pos", cumsum={"total": "amount"}).toPandas()
    both = got.merge(expect, on="id", suffixes=("", "_e"))
    assert (both["pos"] == both["pos_e"]).all()
    pd.testing.assert_series_equal(both["total"].fillna(0.0), both["total_e"].fillna(0.0), check_names=False, check_dtype=False)


def test_text_and_date_orders_can_be_sliced(spark):
    df = spark.range(900).select(
        "id",
        F.concat(F.lit("t"), (F.col("id") % 17).cast("string")).alias("t"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 31).cast("int")).alias("d"),
        F.timestamp_seconds(F.col("id") % 29).alias("s"),
    )
    a = running(df, [], ["t", "d", "s", "id"], row_number="pos", rows_per_task=10**9)
    b = running(df, [], ["t", "d", "s", "id"], row_number="pos", rows_per_task=50)
    assert rows(a) == rows(b)


def test_no_slice_collects_the_hot_key(uneven):
    from tallyloom.operators import ordering

    keyed = uneven.withColumn("__o0", F.col("id"))
    cut = ordering._with_slices(keyed, ["key", "__o0"], 3000, 100)
    biggest = cut.groupBy("__slice").count().agg(F.max("count")).first()[0]
    assert biggest < 300


def test_ntile_puts_larger_buckets_first(spark):
    df = spark.range(23)
    sizes = [r[1] for r in ntile(df, [], ["id"], 5).groupBy("ntile").count().orderBy("ntile").collect()]
    assert sizes == [5, 5, 5, 4, 4]
    few = ntile(spark.range(3), [], ["id"], 5).orderBy("id").collect()
    assert [r["ntile"] for r in few] == [1, 2, 3]


def test_average_rank(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 5.0), (4, None), (5, 9.0)], "id int, v double")
    got = {r["id"]: r["rank"] for r in average_rank(df, [], "v").collect()}
    assert got == {1: 1.5, 2: 3.0, 3: 1.5, 4: None, 5: 4.0}


def test_empty_frame(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert measure(df, ["k"]) == Size(0, 0)
    assert running(df, ["k"], ["v"], row_number="pos").count() == 0
    assert ntile(df, [], ["v"], 4).count() == 0


def test_descending_orders_of_any_type(spark):
    texts = ["a", "ab", "", "b", "\u00e9", "aa", None]
    df = spark.range(420).select(
        "id",
        F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("id") % 7 + 1).cast("int")).alias("t"),
        F.when(F.col("id") % 11 > 0, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 31).cast("int"))).alias("d"),
        (F.col("id") % 2 == 0).alias("b"),
        (F.col("id") % 5 / 2).alias("x"),
    )
    for last in (False, True):
        order = [down("t", last), down("d", last), down("b"), down("x"), down("id")]
        sides = [F.desc_nulls_last if last else F.desc_nulls_first] * 2 + [F.desc] * 3
        sorted_ids = [r["id"] for r in df.orderBy(*[s(c) for s, c in zip(sides, "tdbx")], F.desc("id")).collect()]
        for rows_per_task in (10**9, 20):
            placed = running(df, [], order, row_number="pos", rows_per_task=rows_per_task)
            assert [r["id"] for r in placed.orderBy("pos").collect()] == sorted_ids
