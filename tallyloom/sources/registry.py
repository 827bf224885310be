"""Saved models in a shared folder, with a table that lists them."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import piece

_ENTRY = "model_id string, path string, response string, features array<string>, params string, metrics string"


class ModelRegistry:
    """Models under ``root/models/<model_id>`` and one entry per model under ``root/entries``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, model_id: str) -> str:
        return f"{self.root}/models/{model_id}"

    def save(
        self, model_id: str, model: PipelineModel, response: str, features=(), metrics: Mapping[str, float] | None = None,
        overwrite: bool = True,
    ) -> str:
        """Write a model and its entry; returns the path."""
        path = self.path(model_id)
        writer = model.write().overwrite() if overwrite else model.write()
        writer.save(path)
        last = model.stages[-1]
        params = {p.name: str(v) for p, v in last.extractParamMap().items()}
        row = (model_id, path, response, list(features), json.dumps(params), json.dumps(dict(metrics or {})))
        entry = self.spark.createDataFrame([row], _ENTRY).coalesce(1)
        entry.write.mode("overwrite").parquet(f"{self.root}/entries/{model_id}")
        return path

    def table(self) -> DataFrame:
        """All entries, one row per model."""
        return self.spark.read.schema(_ENTRY).parquet(f"{self.root}/entries/*")

    def listing(self) -> DataFrame:
        """Saved models found by looking at the folder; the id is the folder's last piece."""
        files = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "part-*")
            .load(f"{self.root}/models/*/metadata")
        )
        folder = F.regexp_replace(F.col("path"), "/metadata/[^/]*$", "")
        return files.select(folder.alias("path")).distinct().select(piece(F.col("path"), "/", -1).alias("model_id"), "path")

    def load(self, model_id: str) -> PipelineModel:
        return PipelineModel.load(self.path(model_id))

    def load_all(self) -> dict[str, PipelineModel]:
        names = sorted(r["model_id"] for r in self.listing().select("model_id").collect())
        return {n: self.load(n) for n in names}

    def parameters(self) -> DataFrame:
        """Settings of all saved models as rows."""
        pairs = F.from_json("params", "map<string,string>")
        return self.table().select("model_id", "response", F.explode(pairs).alias("param", "value"))
