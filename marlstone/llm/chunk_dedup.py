"""Exact duplicates by recipes of content-defined chunks.

Texts are compared without white space. A rolling hash cuts each into chunks at places that depend on the bytes
around them. Chunks meet once, to verify that equal hashes mean equal bytes; where they do not, the contents get
identifiers of their own. From there on a document is the list of its chunk identifiers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.textarrays import BLOCK, bounded, mix, text_bytes
from marlstone.plans.durable import durable

LEAST, MOST = 1024, 16384
_CUT_BITS = np.uint32((1 << 12) - 1)
_WINDOW = 32
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
MOST_COLLISIONS = 100_000


def cut_places(data: np.ndarray) -> np.ndarray:
    """Where the hash of the 32 bytes before ends in zeros; right from place 32 of any text on."""
    found = []
    for at in range(0, len(data), BLOCK):
        begin = max(0, at - _WINDOW)
        rolled = _GEAR[data[begin : at + BLOCK]]
        width = 1
        while width < _WINDOW:
            longer = rolled.copy()
            longer[width:] += rolled[:-width] << np.uint32(width)
            rolled, width = longer, 2 * width
        places = np.flatnonzero((rolled & _CUT_BITS) == 0) + begin + 1
        found.append(places[places > at])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunks(column: pa.Array) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Each text without white space, with the begin and end of its chunks."""
    data, offsets = text_bytes(column)
    kept = ~_WHITE[data]
    offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
    data = data[kept]
    places = cut_places(data)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        at, spans = a, []
        inside = places[np.searchsorted(places, a + LEAST) : np.searchsorted(places, b)].tolist()
        for place in [*inside, b]:
            while place - at > MOST:
                spans.append((at - a, at + MOST - a))
                at += MOST
            if place > at and (place - at >= LEAST or place == b):
                spans.append((at - a, place - a))
                at = place
        yield data[a:b].tobytes(), spans


def chunk_hash(content: bytes, bits: int) -> int:
    number = int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True)
    return number >> (64 - bits)


def colliding_chunks(docs: DataFrame, bits: int = 64) -> dict[bytes, int]:
    """Contents whose hash another content has as well, with identifiers of their own.

    Equal chunks meet as one row per task and content. Two contents of one 64-bit hash are so rare (16 pairs are
    expected in 100 TB) that the list fits the driver; a longer one is refused.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in bounded(batch.column("text")):
                found = {text[a:b] for text, spans in chunks(part) for a, b in spans}
                hashes = [chunk_hash(c, bits) for c in found]
                yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(found, pa.binary())], ["h", "chunk"])

    contents = docs.select("text").mapInArrow(emit, "h long, chunk binary").distinct()
    shared = contents.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("chunk").alias("first")).where("n > 1")
    shared = durable(shared.select("h", "first"))
    if shared.isEmpty():
        return {}
    if shared.count() > MOST_COLLISIONS:
        raise ValueError("too many chunks share a hash")
    others = contents.join(F.broadcast(shared), "h").where("chunk != first").select("chunk")
    rows = durable(others).limit(MOST_COLLISIONS + 1).collect()
    if len(rows) > MOST_COLLISIONS:
        raise ValueError("too many chunks share a hash")
    wide = (hashlib.blake2b(bytes(r[0]), digest_size=8, person=b"second").digest() for r in rows)
    return {bytes(r[0]): int.from_bytes(w, "little", signed=True) for r, w in zip(rows, wide, strict=True)}


def recipes(docs: DataFrame, *, bits: int = 64) -> DataFrame:
    """``doc_id``, ``n_chars``, ``text_sha256`` and ``recipe`` (ordered chunk identifiers) of every document."""
    special = colliding_chunks(docs, bits)
    fields = [("n_chars", T.LongType()), ("text_sha256", T.StringType()), ("recipe", T.ArrayType(T.LongType()))]
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, t) for n, t in fields]])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in bounded(batch.column("text")):
                sums, lists = [], []
                for text, spans in chunks(part):
                    sums.append(hashlib.sha256(text).hexdigest())
                    pieces = (text[a:b] for a, b in spans)
                    lists.append([special[p] if p in special else chunk_hash(p, bits) for p in pieces])
                columns = [batch.column(c).slice(at, len(part)) for c in ("doc_id", "n_chars")]
                columns += [pa.array(sums, pa.string()), pa.array(lists, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    length = F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars")
    return docs.select("doc_id", length, "text").mapInArrow(write, schema)


def dedup(docs: DataFrame, *, bits: int = 64) -> DataFrame:
    """One row per document: which document of its group stays, and whether it is this one.

    Of equal texts the longest original stays, then the smallest ``doc_id`` (null before all), then the first in
    the written table, so that repeated rows keep one. Null and empty texts and those of white space alone are one
    group. Groups meet as one row per task; hot groups are joined back on a key that Spark can split.
    """
    rows = durable(recipes(docs, bits=bits).withColumn("__row", F.monotonically_increasing_id()))
    rank = F.struct((-F.col("n_chars")).alias("shorter"), "doc_id", "__row")
    groups = rows.groupBy("recipe").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(groups, "recipe").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("__row") == F.col("best.__row")).alias("kept"),
        "text_sha256",
    )
