"""Stored vector indexes: created by name, filled in batches, searched, restored by path."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.operators import vectors
from marlstone.plans.neighbors import METRICS
from marlstone.plans.durable import durable
from marlstone.sources.batches import BatchTable

KINDS = {"Flat": "exact", "IVFFlat": "ivf", "HNSW": "lsh"}
FILES_PER_LIST = 4


class IndexStore:
    """Indexes below one folder; opening the folder again restores them all.

    One row holds vector, document and metadata, so they cannot drift apart. The files of an index lie in folders by
    inverted list, and a search reads only the lists that its queries probe. ``HNSW`` asks for approximate search and
    is served by random-projection hashing.
    """

    VECTORS = "at long, vec array<float>, document string, metadata map<string,string>"

    def __init__(self, spark: SparkSession, root: str):
        root = root.rstrip("/")
        self.names = BatchTable(spark, f"{root}/names", "info map<string,string>")
        self.batches = BatchTable(spark, f"{root}/vectors", self.VECTORS, lists="cell int")
        self.lists = BatchTable(spark, f"{root}/centers", "cell int, center array<double>")
        self.spark = spark

    def create(self, name: str, dim: int, *, kind: str = "Flat", metric: str = "ip", nlist: int | None = None) -> None:
        """A new, empty index; the files of one of the same name are removed. ``nlist`` is the number of inverted lists."""
        if kind not in KINDS:
            raise ValueError(f"unknown index kind {kind!r}")
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric!r}")
        for part in (self.names, self.batches, self.lists):
            part.clear(name)
        info = {"dim": str(dim), "kind": kind, "metric": metric, **({"nlist": str(nlist)} if nlist else {})}
        self.names.write(name, self.spark.createDataFrame([(info,)], "info map<string,string>"), batch="info")

    def _info(self, name: str) -> dict:
        found = self.names.rows(name).first()
        if found is None:
            raise ValueError(f"no index {name!r}")
        return dict(found["info"])

    def _centers(self, name: str) -> np.ndarray | None:
        rows = self.lists.rows(name).orderBy("cell").collect()
        return np.array([r["center"] for r in rows]) if rows else None

    def vectors(self, name: str) -> DataFrame:
        """``pos``, ``vec``, ``document``, ``metadata``, ``cell``; positions count the rows of the batches in their order."""
        rows = self.batches.rows(name)
        # One row per batch and list: the running total never sees the vectors.
        sizes = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
        before = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("batch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
        placed = rows.join(F.broadcast(starts), "batch")
        return placed.select((F.col("start") + F.col("at")).alias("pos"), "vec", "document", "metadata", "cell")

    def add(
        self, name: str, batch: DataFrame, *, order_by: Sequence[str], vec: str = "vec", batch_id: str | None = None
    ) -> int:
        """Append a batch at the next positions; the first one trains the inverted lists. The new total.

        The same ``batch_id`` again replaces what it wrote before.
        """
        info = self._info(name)
        blank = {"document": F.lit(""), "metadata": F.create_map().cast("map<string,string>")}
        rows = batch.select(
            *order_by,
            F.col(vec).cast("array<float>").alias("vec"),
            *[
                (F.coalesce(F.col(c), v) if c in batch.columns else v).alias(c)
                for c, v in blank.items()
            ],
        )
        placed = vectors.at_positions(rows, order_by=order_by, vec="vec", dim=int(info["dim"]), start=-1)
        placed = durable(placed.withColumnRenamed("pos", "at"))
        cell = placed.withColumn("cell", F.lit(0))
        if info["kind"] == "IVFFlat":
            centers = self._centers(name)
            if centers is None:
                centers = vectors.train_cells(placed, vec="vec", nlist=int(info["nlist"]) if "nlist" in info else None)
                table = self.spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(centers)], "cell int, center array<double>")
                self.lists.write(name, table, batch="centers")
            cell = vectors.assign_cells(placed, centers, vec="vec")
            cell = cell.repartition("cell", F.pmod(F.xxhash64("at"), F.lit(FILES_PER_LIST)))
        self.batches.write(name, cell.select("at", "vec", "document", "metadata", "cell"), batch_id)
        return self.batches.rows(name).count()

    def probed(self, name: str, queries: DataFrame, *, vec: str, nprobe: int) -> DataFrame:
        """Vectors of the lists that any of the queries probes; the other lists' files are not opened."""
        centers = self._centers(name)
        if centers is None:
            return self.vectors(name)
        wanted = vectors.assign_cells(queries.select(F.col(vec).cast("array<double>").alias("v")), centers, vec="v", nprobe=nprobe)
        cells = [r["cell"] for r in wanted.select("cell").distinct().collect()]  # at most one row per list
        return self.vectors(name).where(F.col("cell").isin(cells))

    def search(self, name: str, queries: DataFrame, *, query_id: str, vec: str = "vec", k: int = 5, nprobe: int = 1):
        """Query id, rank, position, score, document and metadata of the nearest rows."""
        info = self._info(name)
        ivf = info["kind"] == "IVFFlat"
        return vectors.search(
            self.probed(name, queries, vec=vec, nprobe=nprobe) if ivf else self.vectors(name),
            queries,
            id="pos",
            vec="vec",
            query_id=query_id,
            query_vec=vec,
            k=k,
            metric=info["metric"],
            method=KINDS[info["kind"]],
            nprobe=nprobe,
            centers=self._centers(name) if ivf else None,
            carry=["document", "metadata"],
        )

    def info(self, name: str) -> DataFrame:
        known = self._info(name)
        return vectors.index_info(
            self.vectors(name), vec="vec", cell="cell", metric=known["metric"], kind=known["kind"]
        )
