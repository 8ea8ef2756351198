"""Stored graphs: named node and edge tables that grow by batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators import graph
from marlstone.plans.positions import with_position
from marlstone.sources.batches import BatchTable


class GraphStore:
    """Graphs below one folder; a graph not created yet opens on first use."""

    NODES = "id string, label string, attrs map<string,string>"
    EDGES = "src string, dst string, relation string, at long"

    def __init__(self, spark: SparkSession, root: str):
        root = root.rstrip("/")
        self.node_batches = BatchTable(spark, f"{root}/nodes", self.NODES)
        self.edge_batches = BatchTable(spark, f"{root}/edges", self.EDGES)

    def create(self, name: str) -> None:
        """Create or empty a graph; an emptied graph's files are removed."""
        self.node_batches.clear(name)
        self.edge_batches.clear(name)

    def add_nodes(self, name: str, nodes: DataFrame, *, order_by: Sequence[str], batch_id: str | None = None) -> int:
        """Insert or replace nodes; the number of nodes afterwards.

        The batch is reduced to its last row per id here, and to the last batch per id when the graph is read.
        """
        blank = nodes.limit(0)
        if "name" in nodes.columns:
            blank = blank.drop("name")
        rows = graph.upsert_nodes(blank, nodes, order_by=order_by)
        self.node_batches.write(name, rows.select("id", "label", "attrs"), batch_id)
        return self.nodes(name).count()

    def add_edges(self, name: str, edges: DataFrame, *, order_by: Sequence[str], batch_id: str | None = None) -> int:
        """Append edges in ``order_by`` order; the number of edges afterwards."""
        numbered = with_position(graph.add_edges(None, edges), order_by=order_by, name="at")
        self.edge_batches.write(name, numbered.select("src", "dst", "relation", "at"), batch_id)
        return self.edges(name).count()

    def nodes(self, name: str) -> DataFrame:
        rows = self.node_batches.rows(name)
        last = rows.groupBy("id").agg(F.max_by(F.struct("label", "attrs"), "batch").alias("n"))
        return last.select("id", "n.label", "n.attrs")

    def edges(self, name: str) -> DataFrame:
        """Edges with their arrival order as ``seq``: batch, then place in the batch."""
        return self.edge_batches.rows(name).select("src", "dst", "relation", F.struct("batch", "at").alias("seq"))
