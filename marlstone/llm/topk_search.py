"""Exact top-k inner-product search by a three-phase uniform threshold.

The components of a vector are dealt to a few lists; a list's score of a candidate is the part of the inner product
over its components. No list alone knows the best, but a uniform threshold finds them exactly:

1. Each list gives its best candidates. Their whole scores are made up, and the k-th best of them is a safe cutoff
   of the answer.
2. The cutoff is shared out: each list gets its own average score plus an equal part of what the cutoff lies above
   all averages. These thresholds, broadcast with the queries, sum to the cutoff at most, so a candidate below its
   threshold in every list is below the cutoff. Each list collects all entries that reach its threshold.
3. The scores that collected candidates still lack are looked up in the other lists and added; what
   reaches the cutoff is ranked.

Candidates lie in slices and queries in groups, one packed row per list; a slice meets a group as matrices, and
entries travel as packed keys and scores. Each round broadcasts at most ``ROUND`` groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.plans.durable import durable

LISTS = 2
DEPTH = 128
SLICE = 4096
GROUP = 512
ROUND = 32
CHUNK = 16
_NONE = -(1 << 62)
_PACKED = "{name} long, list int, n int, rid binary, id binary, cells binary"
_ENTRIES = "g long, slice long, list int, keys binary, scores binary"


def whole_vectors(rows: DataFrame, *, id: str, vec: str, scale: float) -> DataFrame:
    """``rid``, ``id`` and ``v`` (each component times ``scale``, rounded down) of the rows that take part.

    Rows without an id, without a vector or with a null or non-finite component take no part. ``rid`` tells rows
    apart, repeated ones too. Other columns are not read.
    """
    x = F.col(vec)
    sound = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    return durable(
        rows.where(F.col(id).isNotNull() & sound).select(
            F.monotonically_increasing_id().alias("rid"), F.col(id).cast("long").alias("id"), whole.alias("v")
        )
    )


def _pack(rows: DataFrame, name: str, size: int, width: int, kind: str) -> DataFrame:
    """``rows`` (``rid``, ``id``, ``v``) in packed rows of up to ``size``, one for each list; short vectors end in zeros."""
    columns = np.array_split(np.arange(width), LISTS)

    def packed(number: int, rid: np.ndarray, ids: np.ndarray, cells: np.ndarray) -> Iterator[tuple]:
        for k, own in enumerate(columns):
            yield number, k, len(ids), rid.tobytes(), ids.tobytes(), np.ascontiguousarray(cells[:, own]).tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                v = part.column("v")
                lengths = np.diff(v.offsets.to_numpy())
                cells = np.zeros((part.num_rows, width), kind)
                cells[np.arange(width) < lengths[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
                rid, ids = part.column("rid").to_numpy(), part.column("id").to_numpy()
                made = list(zip(*packed(number, rid, ids, cells), strict=True))
                types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(made, types, strict=True)], [name, "list", "n", "rid", "id", "cells"]
                )
                number += 1

    return durable(rows.select("rid", "id", "v").mapInArrow(pack, _PACKED.format(name=name)))


def _arrays(batch: pa.RecordBatch | pa.Table, *columns: str) -> Iterator[list]:
    """Rows of the named columns, one at a time; binary cells as they are."""
    for at in range(batch.num_rows):
        yield [batch.column(c)[at].as_py() for c in columns]


def _matrix(cells: bytes, n: int, kind: str, work: str) -> np.ndarray:
    return np.frombuffer(cells, kind).reshape(n, -1).astype(work)


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    named = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(named)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[t]) for c, (_, t) in zip(columns, named, strict=True)], [n for n, _ in named]
    )


def _scores(kind, work, qcells, qn, qrid, cells, n, rid) -> tuple[np.ndarray, np.ndarray]:
    """Scores of a group by a slice, and where a query meets its own row."""
    scores = _matrix(qcells, qn, kind, work) @ _matrix(cells, n, kind, work).T
    own = np.frombuffer(qrid, np.int64)
    there = np.frombuffer(rid, np.int64)
    order = np.argsort(there)
    at = np.minimum(np.searchsorted(there[order], own), n - 1)
    met = np.flatnonzero(there[order[at]] == own)
    return scores, np.array([met, order[at[met]]])


class _Search:
    """One round: its groups of queries against all slices."""

    def __init__(self, slices: DataFrame, groups: DataFrame, k: int, kind: str, work: str):
        self.slices, self.groups, self.k, self.kind, self.work = slices, durable(groups), k, kind, work

    def _meet(self, groups: DataFrame, *more: str) -> DataFrame:
        """Every slice with every group of the round, as one packed row for each list."""
        own = groups.select("g", "list", F.col("n").alias("qn"), F.col("rid").alias("qrid"), F.col("cells").alias("qcells"), *more)
        return self.slices.select("slice", "list", "n", "rid", "cells").join(F.broadcast(own), "list")

    def first_lists(self) -> DataFrame:
        """Phase 1: the best entries of each list for each query, and the sum of all its scores."""
        schema = "g long, chunk int, list int, refs binary, scores binary, sums binary, n long"
        kind, work, exact = self.kind, self.work, "int64" if self.work == "int64" else "float64"

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[tuple[int, int], list] = {}
            for batch in batches:
                for g, k, number, *cells in _arrays(batch, "g", "list", "slice", "qcells", "qn", "qrid", "cells", "n", "rid"):
                    scores, own = _scores(kind, work, *cells)
                    sums, n = scores.sum(axis=1, dtype=exact).astype(np.int64), scores.shape[1]
                    mine = np.full(scores.shape, False)
                    mine[tuple(own)] = True
                    low = scores.min() - 1
                    scores[mine] = low
                    top = np.argpartition(scores, n - DEPTH, axis=1)[:, -DEPTH:] if n > DEPTH else np.tile(np.arange(n), (len(scores), 1))
                    value = np.take_along_axis(scores, top, 1)
                    refs = np.where(value == low, -1, (number * SLICE) + top)
                    value = np.where(value == low, _NONE, value.astype(np.int64))
                    if (g, k) in best:
                        refs, value = np.hstack([best[g, k][0], refs]), np.hstack([best[g, k][1], value])
                        if refs.shape[1] > DEPTH:
                            cut = np.argpartition(value, refs.shape[1] - DEPTH, axis=1)[:, -DEPTH:]
                            refs, value = np.take_along_axis(refs, cut, 1), np.take_along_axis(value, cut, 1)
                        sums, n = best[g, k][2] + sums, best[g, k][3] + n
                    best[g, k] = [refs, value, sums, n]
            for (g, k), (refs, value, sums, n) in best.items():
                rows = []
                for at in range(0, len(refs), CHUNK):
                    part = slice(at, at + CHUNK)
                    rows.append((g, at // CHUNK, k, refs[part].tobytes(), value[part].tobytes(), sums[part].tobytes(), n))
                yield _rows(schema, rows)

        return durable(self._meet(self.groups).mapInArrow(collect, schema))

    def cutoffs(self) -> DataFrame:
        """``g``, ``cut`` (the k-th best whole score of the listed candidates of each query) and ``average`` (of each list)."""
        listed = "g long, slice long, keys binary, query binary, average binary"

        def merge(table: pa.Table) -> pa.Table:
            g, chunk = table.column("g")[0].as_py(), table.column("chunk")[0].as_py()
            refs: dict[int, list] = {}
            sums, seen = np.zeros((LISTS, 0), np.int64), np.zeros(LISTS, np.int64)
            for k, r, s, total, n in _arrays(table, "list", "refs", "scores", "sums", "n"):
                own = np.frombuffer(total, np.int64)
                if not sums.shape[1]:
                    sums = np.zeros((LISTS, len(own)), np.int64)
                sums[k] += own
                seen[k] += n
                refs.setdefault(k, []).append((np.frombuffer(r, np.int64).reshape(len(own), -1), np.frombuffer(s, np.int64).reshape(len(own), -1)))
            found = []
            for parts in refs.values():
                r, s = np.hstack([p[0] for p in parts]), np.hstack([p[1] for p in parts])
                if r.shape[1] > DEPTH:
                    cut = np.argpartition(s, r.shape[1] - DEPTH, axis=1)[:, -DEPTH:]
                    r = np.take_along_axis(r, cut, 1)
                query = np.repeat(np.arange(len(r)) + chunk * CHUNK, r.shape[1])
                found.append(np.stack([r.ravel(), query]))
            pairs = np.unique(np.hstack(found), axis=1)
            pairs = pairs[:, pairs[0] >= 0]
            number, place = pairs[0] // SLICE, pairs[0] % SLICE
            keys = (pairs[1] * SLICE + place).astype(np.int32)
            edges = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)] if len(number) else []
            rows = [(g, int(number[a]), keys[a:b].tobytes(), None, None) for a, b in zip(edges, edges[1:], strict=False)]
            query = np.arange(sums.shape[1], dtype=np.int64) + chunk * CHUNK
            rows.append((g, None, None, query.tobytes(), (sums // np.maximum(seen, 1)[:, None]).tobytes()))
            return pa.Table.from_batches([_rows(listed, rows)])

        found = durable(self.first_lists().groupBy("g", "chunk").applyInArrow(merge, listed))
        wanted = found.where("slice is not null").select("g", "slice", "keys", F.explode(F.array(*map(F.lit, range(LISTS)))).alias("list"))
        whole = self.added(self.looked_up(wanted)).select("g", "keys", "scores", F.lit(None).cast("binary").alias("query"), F.lit(None).cast("binary").alias("average"))
        empty = F.lit(None).cast("binary")
        averages = found.where("slice is null").select("g", empty.alias("keys"), empty.alias("scores"), "query", "average")
        schema, most = "g long, cut binary, average binary", self.k

        def cut(table: pa.Table) -> pa.Table:
            g, keys, scores, average = table.column("g")[0].as_py(), [], [], np.zeros((LISTS, GROUP), np.int64)
            for k, s, query, mean in _arrays(table, "keys", "scores", "query", "average"):
                if query is None:
                    keys.append(np.frombuffer(k, np.int32))
                    scores.append(np.frombuffer(s, np.int64))
                else:
                    query = np.frombuffer(query, np.int64)
                    average[:, query] = np.frombuffer(mean, np.int64).reshape(LISTS, -1)
            cuts = np.full(GROUP, _NONE, np.int64)
            if keys:
                query, score = np.concatenate(keys) // SLICE, np.concatenate(scores)
                order = np.lexsort([-score, query])
                query, score = query[order], score[order]
                rank = np.arange(len(query)) - np.searchsorted(query, query)
                cuts[query[rank == most - 1]] = score[rank == most - 1]
            return pa.Table.from_batches([_rows(schema, [(g, cuts.tobytes(), average.tobytes())])])

        return durable(whole.unionByName(averages).groupBy("g").applyInArrow(cut, schema))

    def looked_up(self, wanted: DataFrame) -> DataFrame:
        """The scores in one list of wanted candidates (``g``, ``slice``, ``list``, ``keys``)."""
        asked = wanted.groupBy("g", "slice", "list").agg(F.collect_list("keys").alias("keys"))
        own = self.groups.select("g", "list", F.col("n").alias("qn"), F.col("cells").alias("qcells"))
        met = asked.join(self.slices.select("slice", "list", "n", "cells"), ["slice", "list"]).join(F.broadcast(own), ["g", "list"])
        kind, work = self.kind, "int64" if self.work == "int64" else "float64"

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for g, number, k, asked, qcells, qn, cells, n in _arrays(batch, "g", "slice", "list", "keys", "qcells", "qn", "cells", "n"):
                    keys = np.frombuffer(b"".join(asked), np.int32)
                    a, b = _matrix(qcells, qn, kind, work), _matrix(cells, n, kind, work)
                    scores = np.zeros(len(keys), np.int64)
                    for at in range(0, len(keys), 1 << 16):
                        part = keys[at : at + (1 << 16)]
                        scores[at : at + len(part)] = np.einsum("ij,ij->i", a[part // SLICE], b[part % SLICE])
                    yield _rows(_ENTRIES, [(g, number, k, keys.tobytes(), scores.tobytes())])

        return met.mapInArrow(look, _ENTRIES)

    def added(self, entries: DataFrame, missing: bool = False) -> DataFrame:
        """Scores of each candidate summed over its entries, as entries of list -1.

        With ``missing``, also what each list still lacks, as entries of that list without scores. A group and a slice
        have at most ``GROUP * SLICE`` candidates.
        """

        def add(table: pa.Table) -> pa.Table:
            g, number = table.column("g")[0].as_py(), table.column("slice")[0].as_py()
            parts = [(k, np.frombuffer(a, np.int32), np.frombuffer(s, np.int64)) for k, a, s in _arrays(table, "list", "keys", "scores")]
            total = np.zeros(GROUP * SLICE, np.int64)
            seen = np.zeros(GROUP * SLICE, np.int8)
            for k, keys, scores in parts:
                total[keys] += scores
                seen[keys] |= np.int8((1 << LISTS) - 1 if k < 0 else 1 << k)
            keys = np.flatnonzero(seen).astype(np.int32)
            rows = [(g, number, -1, keys.tobytes(), total[keys].tobytes())]
            if missing:
                for k in range(LISTS):
                    lacking = keys[(seen[keys] >> k & 1) == 0]
                    if len(lacking):
                        rows.append((g, number, k, lacking.tobytes(), None))
            return pa.Table.from_batches([_rows(_ENTRIES, rows)])

        return entries.groupBy("g", "slice").applyInArrow(add, _ENTRIES)

    def entries(self, cutoffs: DataFrame) -> DataFrame:
        """Phase 2: of each list all entries that reach its threshold."""
        limited, kind, work = self.groups.join(cutoffs, "g"), self.kind, self.work

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for g, number, k, cut, average, *cells in _arrays(
                    batch, "g", "slice", "list", "cut", "average", "qcells", "qn", "qrid", "cells", "n", "rid"
                ):
                    scores, own = _scores(kind, work, *cells)
                    cut = np.frombuffer(cut, np.int64)[: len(scores)]
                    average = np.frombuffer(average, np.int64).reshape(LISTS, -1)[:, : len(scores)]
                    above = np.where(cut == _NONE, _NONE // 2, average[k] + (cut - average.sum(axis=0)) // LISTS)
                    reached = scores >= above[:, None]
                    reached[tuple(own)] = False
                    query, place = np.nonzero(reached)
                    if len(query):
                        keys = (query * SLICE + place).astype(np.int32)
                        yield _rows(_ENTRIES, [(g, number, k, keys.tobytes(), scores[query, place].astype(np.int64).tobytes())])

        return durable(self._meet(limited, "cut", "average").mapInArrow(collect, _ENTRIES))

    def run(self) -> DataFrame:
        """``query_row``, ``query_id``, ``vec_id`` and ``score`` of all candidates that reach their query's cutoff."""
        cutoffs = self.cutoffs()
        collected = durable(self.added(self.entries(cutoffs), missing=True))
        # Phase 3: scores that collected candidates lack.
        lacking = self.looked_up(collected.where("list >= 0").select("g", "slice", "list", "keys"))
        whole = self.added(collected.where("list < 0").unionByName(lacking))
        ids = self.slices.where("list = 0").select("slice", "id")
        own = self.groups.where("list = 0").select("g", F.col("id").alias("qid"), F.col("rid").alias("qrid")).join(cutoffs, "g")
        ranked = whole.join(ids, "slice").join(F.broadcast(own), "g")
        schema, most = "query_row long, query_id long, vec_id long, score long", self.k

        def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for keys, scores, cut, id, qid, qrid in _arrays(batch, "keys", "scores", "cut", "id", "qid", "qrid"):
                    keys, scores = np.frombuffer(keys, np.int32), np.frombuffer(scores, np.int64)
                    query = keys // SLICE
                    good = scores >= np.frombuffer(cut, np.int64)[query]
                    query, scores, ids = query[good], scores[good], np.frombuffer(id, np.int64)[keys[good] % SLICE]
                    order = np.lexsort([ids, -scores, query])
                    query, scores, ids = query[order], scores[order], ids[order]
                    best = np.arange(len(query)) - np.searchsorted(query, query) < most
                    query, scores, ids = query[best], scores[best], ids[best]
                    columns = [np.frombuffer(qrid, np.int64)[query], np.frombuffer(qid, np.int64)[query], ids, scores]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_row", "query_id", "vec_id", "score"])

        return durable(ranked.mapInArrow(reach, schema))


def search(vectors: DataFrame, is_query: Column, *, k: int) -> DataFrame:
    """The ``k`` best candidates of each query: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``vectors`` comes from ``whole_vectors``. Queries are the rows with ``is_query``; candidates of a query are all rows but its
    own, and the score is the inner product; all of them if fewer than ``k``; ties go to the smaller id. A repeated row
    is a row of its own: it is a candidate of its copies, and as a query gets its own ranks. Vectors of unlike length
    meet as if the shorter ended in zeros. Of rows with the same vector only the ``k + 1`` of smallest id can be in an
    answer, so only these become candidates, however many copies there are. Scores that might not fit a long are
    refused. An empty table or one without queries gives no rows.
    """
    facts = vectors.agg(
        F.coalesce(F.max(F.size("v")), F.lit(0)),
        F.coalesce(F.max(F.array_max(F.transform("v", lambda c: F.greatest(c, F.bitwise_not(c))))), F.lit(0)),
        F.count_if(is_query),
        F.count(F.lit(1)),
    ).first()
    width, largest, queries = max(facts[0], LISTS), facts[1] + 1, facts[2]
    if width * largest**2 >= 1 << 62:
        raise ValueError(f"inner products of {width} components of up to {largest} may not fit a long")
    if not queries:
        empty = vectors.limit(0)
        return empty.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score"))
    kind = "int16" if largest < 1 << 15 else "int64"
    work = "float32" if width * largest**2 < 1 << 24 else "float64" if width * largest**2 < 1 << 53 else "int64"
    alike = F.row_number().over(Window.partitionBy("v").orderBy("id", "rid"))
    candidates = vectors.withColumn("nth", alike).where(F.col("nth") <= k + 1)
    # Few tasks fill their slices; a file holds up to eight, fewer while that keeps the cores busy.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    files = max(-(-facts[3] // (8 * SLICE)), min(-(-facts[3] // SLICE), 2 * cores))
    slices = _pack(candidates.coalesce(files), "slice", SLICE, width, kind)
    groups = _pack(vectors.where(is_query).repartition(-(-queries // GROUP)), "g", GROUP, width, kind)
    numbers = sorted(r["g"] for r in groups.where("list = 0").select("g").collect())
    found = None
    for at in range(0, len(numbers), ROUND):
        some = numbers[at : at + ROUND]
        part = _Search(slices, groups.where(F.col("g").isin(some)), k, kind, work).run()
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
