"""Directed graphs as two tables: nodes (id, label, attrs) and edges (src, dst, relation, seq)."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.plans.durable import durable
from marlstone.plans.joins import attach
from marlstone.plans.positions import with_position

DEFAULT_RELATION = "related"


def upsert_nodes(
    old: DataFrame, new: DataFrame, *, id: str = "id", name: str = "name", order_by: Sequence[str]
) -> DataFrame:
    """Insert or replace nodes; the last of a batch's repeats wins, with all its attributes.

    A node without an id is known by its name; one with neither is refused.
    """
    from marlstone.sources.collections import update

    known = F.coalesce(F.col(id).cast("string"), F.col(name)) if name in new.columns else F.col(id)
    refused = F.raise_error(F.lit("a node needs an id or a name")).cast("string")
    named = new.withColumn(id, F.coalesce(known, refused))
    if name in named.columns and name not in old.columns:
        named = named.drop(name)
    return update(old, named, id=id, order_by=order_by)


def add_edges(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Append edges; repeats stay, endpoints need not exist, relation defaults to ``related``."""
    relation = F.lit(None).cast("string") if "relation" not in new.columns else F.col("relation")
    rows = new.withColumn("relation", F.coalesce(relation, F.lit(DEFAULT_RELATION)))
    return rows if old is None else old.unionByName(rows)


def edge_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("relation").agg(F.count(F.lit(1)).alias("edges"))


def neighbors(edges: DataFrame, ids: DataFrame, *, direction: str = "out") -> DataFrame:
    """Neighbors of a set of nodes ``ids(node)``; any direction but ``out`` means incoming."""
    here, there = ("src", "dst") if direction == "out" else ("dst", "src")
    rows = edges.select(F.col(here).alias("node"), F.col(there).alias("neighbor"), "relation")
    return attach(rows, ids.select("node").distinct(), ["node"], how="inner")


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Outgoing and incoming edges of every declared node."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")),
                F.struct(F.col("dst").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into")),
            )
        )
    )
    counts = ends.groupBy("id").agg(F.sum("out").alias("out_degree"), F.sum("into").alias("in_degree"))
    return nodes.select("id").join(counts, "id", "left").fillna(0)


def export(nodes: DataFrame, edges: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Write all nodes and the flat edge list below one folder."""
    nodes.write.format(fmt).save(f"{path}/nodes")
    flat_edges(edges).write.format(fmt).save(f"{path}/edges")


def flat_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("source"), F.col("dst").alias("target"), "relation")


def _steps(edges: DataFrame) -> DataFrame:
    """One step per pair of nodes, with its earliest place in the edge order."""
    place = F.min("seq") if "seq" in edges.columns else F.col("dst")
    if "seq" in edges.columns:
        return edges.groupBy("src", "dst").agg(place.alias("place"))
    return edges.select("src", "dst", place.alias("place")).distinct()


HUB_EDGES = 20_000
LEVELS_AT_ONCE = 6


def _hops(max_hops: int | None):
    return itertools.count(1) if max_hops is None else range(1, max_hops + 1)


def distances(edges: DataFrame, sources: DataFrame, *, max_hops: int | None = None) -> DataFrame:
    """Hops from the nearest source ``sources(node)`` to every node reached, within ``max_hops`` if given."""
    steps = durable(edges.select("src", "dst").distinct())
    frontier = durable(sources.select("node").distinct().withColumn("depth", F.lit(0)))
    visited = frontier
    for depth in _hops(max_hops):
        reached = frontier.join(steps, F.col("node") == F.col("src")).select(F.col("dst").alias("node"))
        fresh = reached.distinct().join(visited.select("node"), "node", "left_anti")
        frontier = durable(fresh.withColumn("depth", F.lit(depth)))
        if not frontier.take(1):
            break
        visited = visited.unionByName(frontier)
    return visited


def _split_steps(edges: DataFrame, hub_edges: int) -> tuple[DataFrame, DataFrame]:
    """Steps with the ``part`` of their source they belong to, and the sources (``node``) that have several ``parts``."""
    steps = durable(_steps(edges))
    degrees = steps.groupBy(F.col("src").alias("node")).agg(F.ceil(F.count(F.lit(1)) / hub_edges).cast("int").alias("parts"))
    hubs = durable(degrees.where("parts > 1"))
    named = steps.withColumnRenamed("src", "node")
    part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1))).cast("int")
    return durable(attach(named, hubs, ["node"]).select("node", part.alias("part"), "dst", "place")), hubs


def shortest_paths(
    nodes: DataFrame,
    edges: DataFrame,
    pairs: DataFrame,
    *,
    max_hops: int | None = None,
    hub_edges: int = HUB_EDGES,
) -> DataFrame:
    """Fewest-hop paths for ``pairs(pair_id, source, target)``: status, length and path.

    Status is ``found``, ``no path``, ``missing`` when an endpoint is not declared, or ``beyond bound`` when a given
    ``max_hops`` ended the search before all was reached. Among equally short paths the one that a breadth-first
    search in edge order meets first wins.

    A level is a table of nodes with their parents and their places in the order of the search; a node met from several
    parents stays with the one placed first. Paths do not travel with the search: at its end they are put together
    from the parents, one join of the found pairs per level. A node of more than ``hub_edges`` edges is
    searched in parts, so that neither its edges nor the pairs that stand on it meet in one task.
    """
    declared = nodes.select(F.col("id").alias("node")).distinct()
    ends = pairs.select("pair_id", "source", "target")
    for end in ("source", "target"):
        known = declared.select(F.col("node").alias(end), F.lit(True).alias(f"has_{end}"))
        ends = ends.join(known, end, "left")
    ends = durable(
        ends.select(
            "pair_id", "source", "target", (F.col("has_source") & F.col("has_target")).alias("ok")
        )
    )
    steps, hubs = _split_steps(edges, hub_edges)
    none = F.lit(None).cast(steps.schema["node"].dataType)
    level = durable(
        ends.where("ok").select(
            "pair_id", "target", F.col("source").alias("node"), none.alias("parent"), F.lit(0).cast("long").alias("nth")
        )
    )
    levels = [level]
    visited = level.select("pair_id", "node")
    for hop in _hops(max_hops):
        done = level.where("node = target").select("pair_id")
        open_pairs = attach(level.join(done, "pair_id", "left_anti"), hubs, ["node"])
        parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
        met = open_pairs.withColumn("part", F.explode(parts)).join(steps, ["node", "part"])
        first = F.min(F.struct("nth", "place", "node")).alias("first")
        reached = met.groupBy("pair_id", "target", "dst").agg(first)
        reached = reached.select("pair_id", "target", F.col("dst").alias("node"), "first.nth", "first.place", F.col("first.node").alias("parent"))
        fresh = durable(reached.join(visited, ["pair_id", "node"], "left_anti"))
        if fresh.isEmpty():
            level = fresh
            break
        placed = with_position(fresh, keys=["pair_id"], order_by=["nth", "place", "node"], name="at")
        level = durable(placed.select("pair_id", "target", "node", "parent", F.col("at").alias("nth")))
        levels.append(level)
        visited = visited.unionByName(level.select("pair_id", "node"))
        if hop % LEVELS_AT_ONCE == 0:
            visited = durable(visited)
    unfinished = level.where("node <> target").select("pair_id", F.lit(True).alias("cut")).distinct()
    paths = _paths(levels)
    status = (
        F.when(F.coalesce("ok", F.lit(False)) == F.lit(False), "missing")
        .when(F.col("path").isNull() & F.col("cut"), "beyond bound")
        .when(F.col("path").isNull(), "no path")
        .otherwise("found")
    )
    return ends.join(paths, "pair_id", "left").join(unfinished, "pair_id", "left").select(
        "pair_id",
        "source",
        "target",
        status.alias("status"),
        F.when(F.col("path").isNotNull(), F.size("path") - 1).alias("length"),
        "path",
    )


def _paths(levels: list[DataFrame]) -> DataFrame:
    """``pair_id`` and ``path`` of the pairs whose target is in a level, followed back from parent to parent."""
    back = None
    for number, level in reversed(list(enumerate(levels))):
        ends = level.where("node = target").select("pair_id", F.col("parent").alias("at"), F.array("node").alias("path"))
        if back is not None:
            own = level.select("pair_id", F.col("node").alias("at"), "parent")
            before = back.join(own, ["pair_id", "at"])
            ends = ends.unionByName(before.select("pair_id", F.col("parent").alias("at"), F.concat(F.array("at"), "path").alias("path")))
        back = durable(ends) if number % LEVELS_AT_ONCE == 0 else ends
    return back.select("pair_id", "path")
