"""Packing documents into token sequences by a linear grouping scheme.

How many pieces there are of each length is all that planning needs: at most ``capacity`` numbers. Large
lengths are rounded up within groups of equal cardinality; configurations of these few sizes are optimised by
column generation; real lengths are put in the places of the rounded ones, the largest that fit; what is left
and all small lengths go where they fit best. The plan is a list of segments (so many pieces of one length,
from this sequence on, at this offset), whose number depends on ``capacity`` and not on the rows. Pieces are
numbered by length in one sort, and the number of a piece finds its segment.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.numbering import numbered
from marlstone.llm.token_ids import id_arrays
from marlstone.plans.durable import durable

GROUPS = 48
LARGE_SHARE = 8
_PIVOTS = 4000


class Segment(NamedTuple):
    """``count`` pieces of one ``length``, one in each sequence from ``sequence`` on, at ``offset``."""

    length: int
    count: int
    sequence: int
    offset: int


def rounded_groups(counts: np.ndarray, capacity: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes (descending) and demands after rounding up large lengths within groups of equal cardinality."""
    lengths = np.flatnonzero(counts)[::-1]
    lengths = lengths[lengths > capacity // LARGE_SHARE]
    ends = np.cumsum(counts[lengths])
    if not len(ends):
        return np.zeros(0, int), np.zeros(0, int)
    heads = np.unique(np.arange(groups) * ends[-1] // groups)
    sizes = lengths[np.searchsorted(ends, heads, side="right")]
    demand = np.diff(np.append(heads, ends[-1]))
    merged = np.unique(-sizes)
    return -merged, np.array([demand[sizes == -m].sum() for m in merged])


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable set of sizes that fits (a knapsack with repeated items)."""
    value = np.zeros(capacity + 1)
    steps = []
    for g, (size, gain) in enumerate(zip(sizes.tolist(), worth.tolist(), strict=True)):
        for _ in range(capacity // size if gain > 0 else 0):
            better = np.zeros(capacity + 1, bool)
            better[size:] = value[:-size] + gain > value[size:] + 1e-12
            if not better.any():
                break
            value = np.where(better, np.concatenate([np.zeros(size), value[:-size]]) + gain, value)
            steps.append((g, size, better))
    chosen, room = np.zeros(len(sizes), int), capacity
    for g, size, better in reversed(steps):
        if better[room]:
            chosen[g] += 1
            room -= size
    return chosen


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each, rounded down, from the linear program over all of them."""
    basis = np.diag(capacity // sizes).astype(float)
    use = demand / np.diag(basis)
    for _ in range(_PIVOTS):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        entering = _best_configuration(sizes, worth, capacity)
        if entering @ worth <= 1 + 1e-7:
            break
        change = np.linalg.solve(basis, entering.astype(float))
        ratio = np.where(change > 1e-9, use / np.where(change > 1e-9, change, 1), np.inf)
        leaving = int(np.argmin(ratio))
        use = np.maximum(use - change * ratio[leaving], 0)
        use[leaving] = ratio[leaving]
        basis[:, leaving] = entering
    return [(basis[:, c].round().astype(int), int(use[c] + 1e-6)) for c in range(len(sizes))]


class _Bins:
    """Sequences by the room that is left in them, as runs of consecutive numbers."""

    def __init__(self, capacity: int, counts: np.ndarray):
        self.capacity, self.left = capacity, counts.copy()
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.open = np.zeros(capacity + 1, bool)
        self.total = 0
        self.segments: list[Segment] = []

    def new(self, count: int) -> tuple[int, int]:
        self.total += count
        return self.total - count, count

    def put(self, length: int, run: tuple[int, int], room: int) -> None:
        self.left[length] -= run[1]
        self.segments.append(Segment(length, run[1], run[0], self.capacity - room))

    def give(self, room: int, run: tuple[int, int]) -> None:
        self.runs[room].append(run)
        self.open[room] = True

    def take(self, room: int, most: int) -> tuple[int, int]:
        start, count = self.runs[room].pop()
        if count > most:
            self.runs[room].append((start + most, count - most))
        self.open[room] = bool(self.runs[room])
        return start, min(count, most)


def _substitute(bins: _Bins, sizes: np.ndarray, chosen: np.ndarray, times: int) -> None:
    """Fill ``times`` new sequences by one configuration with the largest real lengths that fit its places."""
    runs = [(bins.new(times), bins.capacity)]
    places = np.repeat(sizes, chosen).tolist()
    for k, _ in enumerate(places):
        kept = sum(places[k + 1 :])
        following = []
        while runs:
            (start, count), room = runs.pop()
            fitting = np.flatnonzero(bins.left[1 : room - kept + 1])
            if not len(fitting):
                following.append(((start, count), room))
                continue
            length = int(fitting[-1]) + 1
            done = min(count, int(bins.left[length]))
            bins.put(length, (start, done), room)
            following.append(((start, done), room - length))
            if count > done:
                runs.append(((start + done, count - done), room))
        runs = following
    for run, room in runs:
        bins.give(room, run)


def _best_fit(bins: _Bins) -> None:
    """Place every remaining length, largest first, where the least room stays."""
    for length in range(bins.capacity, 0, -1):
        while bins.left[length]:
            fits = np.flatnonzero(bins.open[length:])
            if len(fits):
                room = length + int(fits[0])
                run = bins.take(room, int(bins.left[length]))
                bins.put(length, run, room)
                bins.give(room - length, run)
                continue
            per = bins.capacity // length
            whole, rest = divmod(int(bins.left[length]), per)
            for number, each in ((whole, per), (1 if rest else 0, rest)):
                if number:
                    run, room = bins.new(number), bins.capacity
                    for _ in range(each):
                        bins.put(length, run, room)
                        room -= length
                    bins.give(room, run)


def plan(counts: np.ndarray, capacity: int, groups: int = GROUPS) -> list[Segment]:
    """Segments that place ``counts[n]`` pieces of each length n (1 to ``capacity``)."""
    bins = _Bins(capacity, np.asarray(counts, np.int64))
    alone = int(bins.left[capacity])
    if alone:
        bins.put(capacity, bins.new(alone), capacity)
    sizes, demand = rounded_groups(bins.left, capacity, groups)
    if len(sizes):
        for chosen, times in configurations(sizes, demand, capacity):
            if times:
                _substitute(bins, sizes, chosen, times)
    _best_fit(bins)
    return bins.segments


def pack(pieces: DataFrame, *, order: list[str], length: str = "length", capacity: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every length is from 1 to ``capacity``.

    ``order`` names the columns that number pieces of equal length. Columns of the input named like the new
    ones are replaced; ties and repeated rows each get a place of their own; an empty table stays empty.
    """
    plain = pieces.drop("sequence_id", "offset")
    rows = numbered(plain, [F.col(length).desc(), *[F.col(c) for c in order]], "__row")
    counts = np.zeros(capacity + 1, np.int64)
    for size, many in rows.groupBy(length).count().collect():  # at most one row per length
        counts[size] = many
    segments = sorted(plan(counts, capacity), key=lambda s: -s.length)
    starts = np.cumsum([0, *[s.count for s in segments]])[:-1]
    sequence = np.array([s.sequence for s in segments], np.int64)
    offset = np.array([s.offset for s in segments], np.int64)

    @F.pandas_udf("sequence_id long, offset long")
    def place(row: pd.Series) -> pd.DataFrame:
        numbers = row.to_numpy()
        at = np.searchsorted(starts, numbers, side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + numbers - starts[at], "offset": offset[at]})

    return rows.withColumn("__at", place("__row")).select(*plain.columns, "__at.sequence_id", "__at.offset")


def cut(total: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of a document: full ones, the first may be shorter."""
    at, size = 0, (total - 1) % capacity + 1
    while at < total:
        yield at, size
        at, size = at + size, capacity


def token_pieces(
    docs: DataFrame, *, path: str, capacity: int, end: int, keep_ids: bool = False
) -> DataFrame:
    """The pieces of every document (``doc_id``, ``text``): place, length, checksum and, if asked, ids.

    A null or empty text is its end id alone; texts of any length are encoded whole.
    """
    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType())]
    fields += [("ids_crc32", T.LongType()), *([("ids", T.ArrayType(T.IntegerType()))] if keep_ids else [])]
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, t) for n, t in fields]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made = [], []
            for row, ids in enumerate(id_arrays(batch.column("text"), path, True, end)):
                for k, (at, size) in enumerate(cut(len(ids), capacity)):
                    part = ids[at : at + size].astype("<u4")
                    rows.append(row)
                    made.append((k, at, size, zlib.crc32(part.tobytes()), *([part.astype("i4")] if keep_ids else [])))
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=False)]
            if columns:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), *columns], schema.names)

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def pack_documents(docs: DataFrame, *, path: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """Where every piece of every document lies: one row per piece with its sequence and offset.

    Texts are encoded once; only lengths, places and checksums are written and sorted.
    """
    pieces = durable(token_pieces(docs, path=path, capacity=capacity, end=end))
    return pack(pieces, order=["doc_id", "piece", "ids_crc32"], capacity=capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from placed pieces that kept their ``ids``: at most ``capacity`` ids each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
