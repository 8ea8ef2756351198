"""Fitted models by name: saved by one session, found and used by another."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators import tabular
from marlstone.sources.batches import BatchTable, new_batch


class ModelStore:
    """Tabular models below one folder.

    A model is written to a folder of its own before its name points to it, so a save that fails leaves the model
    of that name as it was. What the fit knew (columns in their order, target, task, algorithm) is kept with it;
    classes are part of the written stages.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.names = BatchTable(spark, f"{self.root}/names", "info map<string,string>")

    def save(self, name: str, model: tabular.TabularModel) -> None:
        """Keep ``model`` under ``name``; files of an earlier one of that name are removed."""
        earlier = self._info(name)
        folder = f"{self.root}/models/{new_batch()}"
        model.pipeline.write().save(folder)
        info = {"features": json.dumps(model.features), "target": model.target, "task": model.task, "algorithm": model.algorithm, "folder": folder}
        self.names.write(name, self.spark.createDataFrame([(info,)], "info map<string,string>"), "info")
        if earlier:
            self._remove(earlier["folder"])

    def _info(self, name: str) -> dict | None:
        found = self.names.rows(name).first()
        return dict(found["info"]) if found else None

    def _remove(self, folder: str) -> None:
        # Overwriting with no rows leaves a mark of success and nothing else.
        self.spark.createDataFrame([], "x int, y int").write.mode("overwrite").partitionBy("x").parquet(folder)

    def load(self, name: str) -> tabular.TabularModel:
        info = self._info(name)
        if info is None:
            raise ValueError(f"no model {name!r}")
        pipeline = PipelineModel.load(info["folder"])
        return tabular.TabularModel(pipeline, json.loads(info["features"]), info["target"], info["task"], info["algorithm"])

    def predict(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` with what the model of that name predicts."""
        return tabular.predict(self.load(name), df)

    def delete(self, name: str) -> None:
        info = self._info(name)
        self.names.clear(name)
        if info:
            self._remove(info["folder"])

    def list(self) -> DataFrame:
        """Names with target, task, algorithm and number of features."""
        info = F.col("info")
        features = F.from_json(info["features"], "array<string>")
        return self.names.rows().select(
            "name", *[info[c].alias(c) for c in ("target", "task", "algorithm")], F.size(features).alias("features")
        )
