"""Named tables in plain Parquet, written batch by batch.

A table has a folder per name and in it a folder per batch. A batch is written by dynamic partition overwrite of its
own folder: writing the same batch again, after a failure or by a repeated job, replaces it; two writers with batches of
their own never touch each other's files; and a write that fails leaves the table as it was. Emptying a name removes
its files.
"""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def new_batch() -> str:
    """An id that no other writer gives, in order of time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex}"


class BatchTable:
    """Rows of ``schema`` under a name and a batch, cut further by the columns ``lists``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, lists: str = ""):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.cut = ["folder", *[f.split()[0] for f in lists.split(", ") if f], "batch"]
        self.fields = ", ".join(f for f in (schema, "name string", "folder string", lists, "batch string") if f)
        self.columns = [f.name for f in spark.createDataFrame([], self.fields).schema]
        # An empty table makes its folder, so that it can be read before anything is written.
        self._empty().write.mode("append").partitionBy(*self.cut).parquet(self.path)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.fields)

    @staticmethod
    def _folder(name: str) -> str:
        return hashlib.md5(name.encode(), usedforsecurity=False).hexdigest()

    def write(self, name: str | Column, rows: DataFrame, batch: str | None = None) -> str:
        """Write ``rows`` as one batch of ``name``, in place of an earlier attempt of it; the batch's id.

        With a column as ``name`` each row goes to the name it gives, all in one job.
        """
        batch = batch or new_batch()
        named = F.lit(name) if isinstance(name, str) else name
        marked = rows.withColumns({"name": named, "batch": F.lit(batch)})
        marked = marked.withColumn("folder", F.md5(F.col("name").cast("binary")))
        writer = marked.select(*self.columns).write.mode("overwrite").partitionBy(*self.cut)
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)
        return batch

    def clear(self, name: str) -> None:
        """Remove all files of ``name``."""
        inner = self._empty().drop("folder").write.mode("overwrite").option("partitionOverwriteMode", "static")
        inner.partitionBy(*self.cut[1:]).parquet(f"{self.path}/folder={self._folder(name)}")

    def rows(self, name: str | None = None) -> DataFrame:
        """Rows with their ``batch``, of one name (only its folder is read) or with the ``name`` of all."""
        # Listed anew at each read: other writers may have added folders.
        table = self.spark.read.schema(self.fields).parquet(self.path)
        if name is None:
            return table.drop("folder")
        return table.where(F.col("folder") == self._folder(name)).drop("folder", "name")
