"""Connected components of a large undirected graph, and joins that broadcast only what was counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.plans.durable import durable

BROADCAST_ROWS = 1_000_000


def sized(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written narrow table, marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(table) if table.count() <= rows else table


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node reachable) for every end of the edges ``a``, ``b``.

    Each round takes the smallest label among neighbors and then the label of that label, so that long chains
    shorten by half; every round is a written table.
    """
    both = durable(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = durable(labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        ))
        jump = lower.select(F.col("node").alias("at"), F.col("label").alias("next"))
        new = durable(lower.join(jump, lower["label"] == jump["at"]).select("node", "old", F.least("label", "next").alias("label")))
        labels = new.select("node", "label")
        if new.where("old != label").isEmpty():
            return labels
