"""Stateless operators are projections, so they run on a stream unchanged."""

from pyspark.sql import functions as F

from tallyloom.operators.flags import keyword_flags
from tallyloom.operators.recipe import Recipe
from tallyloom.session import scratch_path

from .conftest import SF, rows


def test_bake_and_flags_on_a_stream(spark, table):
    part = table("part")
    fitted = Recipe("p_partkey").normalise("p_size", "p_retailprice").dummies("p_type").fit(part)

    def shape(df):
        return fitted.bake(keyword_flags(df, "p_name", {"red": "red"}))

    stream = spark.readStream.schema(part.schema).parquet(f"{SF}/part*.parquet")
    out = scratch_path(spark, "stream")
    q = (
        shape(stream).writeStream.format("parquet").option("checkpointLocation", f"{out}-state")
        .trigger(availableNow=True).start(out)
    )
    q.awaitTermination(120)
    assert rows(spark.read.parquet(out)) == rows(shape(part))
    assert shape(part).filter(F.col("red") == 1).count() > 0
