"""Lineage cuts and scratch tables that outlive a lost executor.

Both live in the shared folder named by ``spark.checkpoint.dir``. Only a local
session (tests) may fall back to a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, registered with the context."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="marlstone-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and continue from it.

    Unlike a checkpointed plan, the written table is columnar and tells the planner its
    size, so later joins are planned on facts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    # The written table replaces its shuffle files; else they stay until the driver happens to collect its garbage.
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table written by one run."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
