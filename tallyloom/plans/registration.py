"""Registration of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import dataset

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of one folder by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return dataset(self.spark, self.folder, name)


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(tables)`` under its name, with equivalent SQL when SQL can express it."""

    def keep(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[key] = sql
        return fn

    return keep
