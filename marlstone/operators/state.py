"""Keyed state and notes derived from append-only logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.plans.positions import GROUP_ROWS, over_trailing_rows, with_position

DEFAULT_ROLE = "planner"


def latest(log: DataFrame, *, key: str, order_by: Sequence[str]) -> DataFrame:
    """The last write per key: one aggregate, combined before the shuffle."""
    rest = [c for c in log.columns if c != key]
    return (
        log.groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("last"))
        .select(key, "last.*")
    )


def write(log: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Append writes; missing tags become an empty list."""
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>"))
    rows = batch.withColumn("tags", tags)
    return rows if log is None else log.unionByName(rows)


def lookup(state: DataFrame, keys: DataFrame, *, key: str) -> DataFrame:
    """Requested keys with their state; ``found`` tells a miss from a NULL."""
    marked = state.withColumn("found", F.lit(True))
    return keys.join(marked, key, "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def by_tag(state: DataFrame, tag: str | None = None, *, tags: str = "tags") -> DataFrame:
    """All keys, or those carrying a tag."""
    return state if tag is None else state.where(F.array_contains(tags, tag))


def index_notes(notes: DataFrame, *, order_by: Sequence[str], role: str = "role") -> DataFrame:
    """Each note's index in arrival order; a missing role is ``planner``."""
    named = notes.withColumn(role, F.coalesce(F.col(role), F.lit(DEFAULT_ROLE)))
    return with_position(named, order_by=order_by, name="index")


def recent(notes: DataFrame, *, order_by: Sequence[str], limit: int = 20) -> DataFrame:
    """The last ``limit`` notes in arrival order; 0 returns none."""
    if limit < 0:
        raise ValueError("limit must not be negative")
    last = notes.orderBy(*[F.desc(c) for c in order_by]).limit(limit)
    return last.orderBy(*order_by)


def after_clear(log: DataFrame, *, cleared: Column, order_by: Sequence[str]) -> DataFrame:
    """Writes after the last clearing row; the mark is one row, found by an aggregate."""
    at = F.struct(*order_by)
    mark = log.where(cleared).agg(F.max(at).alias("at")).first()["at"]
    kept = log.where(~cleared)
    if mark is None:
        return kept
    bound = F.struct(
        *[F.lit(mark[c]).cast(log.schema[c].dataType).alias(c) for c in order_by]
    )
    return kept.where(at > bound)


def trace(
    events: DataFrame,
    *,
    actor: str,
    order_by: Sequence[str],
    time: str,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Each actor's events in order with the seconds since the one before."""

    def columns(window) -> dict[str, Column]:
        before = F.lag(time).over(window)
        gap = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(before.cast("timestamp"))
        return {"gap_seconds": gap / F.lit(1e6)}

    return over_trailing_rows(
        events, keys=[actor], order_by=order_by, width=2, columns=columns, group_rows=group_rows
    )
