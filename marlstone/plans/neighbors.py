"""Top-k nearest rows by blocks of matrix products.

Scores never exist as rows: each task multiplies a block of base vectors with a
block of query vectors and keeps ``k`` hits per query; a window merges the parts.

* When one side is small (bounded by ``BROADCAST_FLOATS``) it is broadcast as a
  matrix and the other side is scanned in place, without a shuffle.
* Otherwise both sides are cut into shares of bounded size, and a task gets one base
  share and one query share. Every pair of shares meets for an exact search, those of
  the same cell for an approximate one; a cell that holds most rows is more shares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.plans.durable import durable
from marlstone.plans.joins import attach

METRICS = ("ip", "l2", "cosine")
BROADCAST_FLOATS = 8_000_000
BLOCK_ROWS = 200_000
QUERY_ROWS = 1_000_000
PANEL_CELLS = 4_000_000
# Scores are compared at this many decimals, finer than single precision resolves.
DECIMALS = 9
HITS = "query_id long, id long, score double"


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    lengths = np.diff(column.offsets.to_numpy())
    if lengths.min() != lengths.max():
        raise ValueError("vectors of unequal length")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _scores(queries: np.ndarray, base: np.ndarray, metric: str) -> np.ndarray:
    """Larger is better for every metric; squared distances are negated."""
    if queries.shape[1] != base.shape[1]:
        raise ValueError("query and base vectors differ in length")
    product = queries @ base.T
    if metric == "l2":
        squares = (queries**2).sum(1)[:, None] + (base**2).sum(1)[None, :]
        product = -np.maximum(squares - 2 * product, 0.0)
    elif metric == "cosine":
        lengths = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(base, axis=1)[None, :]
        product = product / (lengths + 1e-9)
    return np.round(product, DECIMALS) + 0.0


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best (score descending, id ascending)."""
    width = scores.shape[1]
    if width > 4 * k:
        # Everything at least as good as the k-th score stays, so ties survive the cut; only what stays is sorted.
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        rows, at = np.nonzero(~(scores < kth[:, None]))
        order = np.lexsort((ids[rows, at], -scores[rows, at], rows))
        rows, at = rows[order], at[order]
        nth = np.arange(len(rows)) - np.searchsorted(rows, np.arange(len(scores)))[rows]
        keep = at[nth < k].reshape(-1, k)
        return np.take_along_axis(scores, keep, 1), np.take_along_axis(ids, keep, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _panels(rows: int, others: int) -> Iterator[slice]:
    step = max(1, PANEL_CELLS // max(others, 1))
    for begin in range(0, rows, step):
        yield slice(begin, begin + step)


def _hits(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    k = ids.shape[1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(query_ids, k), pa.int64()),
            pa.array(ids.ravel(), pa.int64()),
            pa.array(scores.ravel(), pa.float64()),
        ],
        names=["query_id", "id", "score"],
    )


def _scan_base(query_ids, queries, k: int, metric: str):
    """Base batches against a broadcast query matrix, k running hits per query."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ids, matrix = query_ids.value, queries.value
        best_scores = np.zeros((len(all_ids), 0))
        best_ids = np.zeros((len(all_ids), 0), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows or not len(all_ids):
                continue
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            base = _matrix(batch.column("vec"))
            scores, picked = [], []
            for part in _panels(len(all_ids), len(ids) + best_ids.shape[1]):
                found = _scores(matrix[part], base, metric)
                joined = np.concatenate([best_scores[part], found], axis=1)
                names = np.concatenate(
                    [best_ids[part], np.broadcast_to(ids, found.shape)], axis=1
                )
                top = _best(joined, names, k)
                scores.append(top[0])
                picked.append(top[1])
            best_scores, best_ids = np.concatenate(scores), np.concatenate(picked)
        if best_ids.shape[1]:
            yield _hits(all_ids, best_ids, best_scores)

    return scan


def _scan_queries(base_ids, base, k: int, metric: str):
    """Query batches against a broadcast base matrix: each batch is complete at once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = base_ids.value, base.value
        for batch in batches:
            if not batch.num_rows or not len(names):
                continue
            asked = batch.column("id").to_numpy(zero_copy_only=False)
            vectors = _matrix(batch.column("vec"))
            for panel in _panels(len(asked), len(names)):
                found = _scores(vectors[panel], matrix, metric)
                scores, picked = _best(found, np.broadcast_to(names, found.shape), k)
                yield _hits(asked[panel], picked, scores)

    return scan


def _meet_blocks(k: int, metric: str):
    """Rows sorted by block, base rows first: hold one base block, stream its queries."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, rows, base, names = None, [], [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            sides = batch.column("side").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(sides) != 0)) + 1
            edges = [0, *turns.tolist(), batch.num_rows]
            for begin, end in zip(edges[:-1], edges[1:]):
                part = batch.slice(begin, end - begin)
                if blocks[begin] != block:
                    block, ids, rows, base, names = blocks[begin], [], [], None, None
                part_ids = part.column("id").to_numpy(zero_copy_only=False)
                vectors = _matrix(part.column("vec"))
                if sides[begin] == 0:
                    ids.append(part_ids)
                    rows.append(vectors)
                    continue
                if not ids:
                    continue
                if base is None:
                    base, names = np.concatenate(rows), np.concatenate(ids)
                    rows = []
                for panel in _panels(len(part_ids), len(names)):
                    found = _scores(vectors[panel], base, metric)
                    scores, picked = _best(found, np.broadcast_to(names, found.shape), k)
                    yield _hits(part_ids[panel], picked, scores)

    return meet


def _merge(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    ranked = hits.withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k)


def exact(
    base: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str,
    *,
    broadcast_floats: int = BROADCAST_FLOATS,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``base(id, vec)`` against ``queries(id, vec)``: (query_id, id, score, rank)."""
    asked, asked_floats = _size(queries)
    known, known_floats = _size(base)
    if known_floats <= min(broadcast_floats, asked_floats):
        return _merge(_scan(queries, base, _scan_queries, k, metric), k)
    if asked_floats <= broadcast_floats:
        # Each task keeps k hits per query, so tasks read many splits rather than one.
        tasks = 4 * base.sparkSession.sparkContext.defaultParallelism
        return _merge(_scan(base.coalesce(tasks), queries, _scan_base, k, metric), k)
    sizes = {"shares": F.lit(-(-known // block_rows)), "parts": F.lit(-(-asked // query_rows))}
    return _merge(
        _meet(base.withColumns(sizes), queries.withColumns(sizes), F.lit(0), k, metric), k
    )


def _size(df: DataFrame) -> tuple[int, int]:
    """Rows and floats; all vectors are of one length, so none but the first is computed."""
    rows = df.count()
    first = df.select(F.size("vec")).first()
    return rows, rows * first[0] if first else 0


def _scan(scanned: DataFrame, held: DataFrame, scan, k: int, metric: str) -> DataFrame:
    table = held.select("id", "vec").toArrow()
    context = scanned.sparkSession.sparkContext
    ids = context.broadcast(table.column("id").to_numpy())
    matrix = context.broadcast(_matrix(table.column("vec")))
    return scanned.select("id", "vec").mapInArrow(scan(ids, matrix, k, metric), HITS)


def _meet(base: DataFrame, queries: DataFrame, cell: Column, k: int, metric: str) -> DataFrame:
    """Bring shares together; both sides carry ``shares`` and ``parts`` of their cell."""

    def spot(of: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(of)).cast("long")

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of).cast("long") - 1))

    placed = base.withColumn("share", spot("shares")).withColumn("part", every("parts"))
    visiting = queries.withColumn("part", spot("parts")).withColumn("share", every("shares"))
    block = F.xxhash64(cell, "share", "part").alias("block")
    both = placed.select(block, F.lit(0).alias("side"), "id", "vec").unionByName(
        visiting.select(block, F.lit(1).alias("side"), "id", "vec")
    )
    together = both.repartition("block").sortWithinPartitions("block", "side")
    return together.mapInArrow(_meet_blocks(k, metric), HITS)


def within_cells(
    base: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str,
    *,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """As ``exact`` but each query only visits its cells: both sides carry ``cell``.

    A row may stand in several cells; a pair met twice counts once.
    """

    def shares(df: DataFrame, rows: int, name: str) -> DataFrame:
        return df.groupBy("cell").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("long").alias(name)
        )

    sizes = durable(
        shares(base, block_rows, "shares").join(shares(queries, query_rows, "parts"), "cell")
    )
    hits = _meet(
        attach(base, sizes, ["cell"], how="inner"),
        attach(queries, sizes, ["cell"], how="inner"),
        F.col("cell"),
        k,
        metric,
    )
    once = hits.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    return _merge(once, k)
