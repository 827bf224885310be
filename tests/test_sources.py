import pytest
from pyspark.sql import functions as F

from tallyloom.operators.joins import expand_grid
from tallyloom.session import cut_lineage, scratch_path
from tallyloom.sources import tables as src

from .conftest import rows


def test_csv_with_schema_and_bad_cell(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, "a,b", 2.5), (2, None, None)], "id int, t string, v double")
    src.write_table(df, path, "csv")
    assert rows(src.read_csv(spark, path, df.schema)) == rows(df)
    with pytest.raises(Exception):
        src.read_csv(spark, path, "id int, t int, v double").collect()
    with pytest.raises(Exception):
        src.write_table(df, path, "csv")


def test_sheet_drops_title_and_header(spark):
    path = scratch_path(spark, "sheet")
    cells = [("Store Lookup", None), ("STORE_ID", "NAME"), ("1", "North"), ("x", "South")]
    spark.createDataFrame(cells, "a string, b string").coalesce(1).write.csv(path)
    schema = spark.createDataFrame([], "STORE_ID long, NAME string").schema
    assert rows(src.read_sheet(spark, path, ["STORE_ID", "NAME"], schema, "STORE_ID")) == [(1, "North"), (None, "South")]


def test_generated_tables(spark):
    assert [r[0] for r in src.even_sequence(spark, -5, 20, 6).collect()] == [-5, 0, 5, 10, 15, 20]
    a = src.uniform_table(spark, 500, {"x": (-20, 40), "y": (-5, 5)}, seed=1)
    assert rows(a) == rows(src.uniform_table(spark, 500, {"x": (-20, 40), "y": (-5, 5)}, seed=1).repartition(3))
    r = a.agg(F.min("x"), F.max("x"), F.avg("y")).first()
    assert -20 <= r[0] and r[1] < 40 and abs(r[2]) < 0.6
    grid = expand_grid(spark, a=[1, 2, 3], b=["x", "y"])
    assert grid.count() == 6 and grid.columns == ["a", "b"]


def test_schema_listing_and_lineage(spark):
    path = scratch_path(spark, "saved")
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    src.write_table(df, path, partition_by=["k"])
    assert rows(src.schema_table(df)) == [(0, "id", "bigint"), (1, "k", "bigint")]
    assert src.folder_listing(spark, path).filter(F.col("path").endswith(".parquet")).count() >= 2
    assert rows(src.read_saved(spark, path, ["id"])) == [(i,) for i in range(10)]
    assert rows(cut_lineage(df)) == rows(df)
