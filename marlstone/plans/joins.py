"""Joining a narrow per-key table to rows whose keys may be hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.plans.durable import durable

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64_000_000
HEAVY_ROWS = 1_000_000


def fits_broadcast(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a written table has at most so many rows, and values of at most so many bytes as text."""
    if table.count() > rows:
        return False
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns])))
    return (table.agg(F.sum(width.cast("long"))).first()[0] or 0) <= size


def attach(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    *,
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``rows`` joined with ``table`` (one narrow row per key, ``how`` inner or left).

    The table is computed once into the shared folder and measured. Small tables are broadcast. For larger ones the
    rows are counted by key: keys of more than ``heavy_rows`` rows, of which there can be only few, stay where they
    are and meet a broadcast of their own part of the table, and all other keys are shuffled. Nothing is copied per
    key, and columns of any type pass through. A null key matches nothing; such rows are not shuffled either.
    """
    known = durable(table)
    keys = list(on)
    if fits_broadcast(known, broadcast_rows):
        return rows.join(F.broadcast(known), keys, how)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    heavy = durable(counts.where(F.col("__rows") > heavy_rows).select(*keys))
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    keyed = rows.where(whole)
    if heavy.isEmpty():
        joined = keyed.join(known, keys, how)
    else:
        few = F.broadcast(heavy)
        light = keyed.join(few, keys, "left_anti").join(known, keys, how)
        hot = keyed.join(few, keys, "left_semi").join(F.broadcast(known.join(few, keys, "left_semi")), keys, how)
        joined = light.unionByName(hot)
    if how == "inner":
        return joined
    return joined.unionByName(rows.where(~whole), allowMissingColumns=True)
