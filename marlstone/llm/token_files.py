"""Token ids in Arrow files that give any equal-length sequence without copying.

Each file holds record batches of ``BATCH`` sequences, two fixed-size lists a row: ids and a mask of the places
that hold one. Buffers are not compressed, so that a reader maps the file and takes sequence ``i`` as a view.
Only the last sequence of a file is padded. A second small file lists where each document begins.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.token_ids import encoder, id_arrays
from marlstone.plans.durable import durable, scratch_path

LENGTH = 1024
BATCH = 256


def _schema(length: int, wide: bool) -> pa.Schema:
    ids = pa.uint32() if wide else pa.uint16()
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class TokenFile:
    """A file of sequences: ``sequence(i)`` and ``ids(start, n)`` read only what they return."""

    def __init__(self, path: str):
        system, name = _at(path)
        local = isinstance(system, fs.LocalFileSystem)
        self.reader = pa.ipc.open_file(pa.memory_map(name) if local else system.open_input_file(name))
        self.length = self.reader.schema.field("ids").type.list_size
        self.batches = self.reader.num_record_batches
        self._kept: tuple[int, pa.RecordBatch] | None = None

    def _batch(self, number: int) -> pa.RecordBatch:
        if self._kept is None or self._kept[0] != number:
            self._kept = number, self.reader.get_batch(number)
        return self._kept[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of sequence ``i``."""
        batch, row = self._batch(i // BATCH), i % BATCH
        part = slice(row * self.length, (row + 1) * self.length)
        ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)[part]
        return ids, batch.column("mask").flatten()[part].to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` on."""
        per, parts, end = BATCH * self.length, [], start + n
        while start < end:
            number = start // per
            flat = self._batch(number).column("ids").flatten().to_numpy(zero_copy_only=True)
            stop = min(end, (number + 1) * per)
            parts.append(flat[start - number * per : stop - number * per])
            start = stop
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint32), *parts])


class _Writer:
    def __init__(self, path: str, length: int, wide: bool):
        system, name = _at(path)
        self.schema, self.length = _schema(length, wide), length
        self.sink = system.open_output_stream(name)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.waiting = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        per = BATCH * self.length
        if self.waiting >= per:
            flat = np.concatenate(self.held)
            for at in range(0, len(flat) - per + 1, per):
                self._write(flat[at : at + per])
            self.held = [flat[len(flat) // per * per :]]
            self.waiting = len(self.held[0])

    def _write(self, flat: np.ndarray) -> None:
        padded = np.zeros(-(-len(flat) // self.length) * self.length, flat.dtype)
        padded[: len(flat)] = flat
        mask = np.arange(len(padded)) < len(flat)
        kind = self.schema.field("ids").type.value_type
        if padded.max() >= 1 << kind.bit_width:
            raise ValueError(f"id {padded.max()} does not fit {kind}")
        values = pa.array(padded.astype(kind.to_pandas_dtype()), kind), pa.array(mask)
        lists = [pa.FixedSizeListArray.from_arrays(v, self.length) for v in values]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            self._write(np.concatenate(self.held))
        self.file.close()
        self.sink.close()


def write_token_files(
    docs: DataFrame, *, path: str, end: int, keep_space: bool, wide: bool | None = None, length: int = LENGTH
) -> list[tuple[str, int]]:
    """Write the ids of all documents (``doc_id``, ``text``) in ascending ``doc_id`` order; files with their ids.

    One task writes one range of documents and reports its file through a table in the shared folder, so a file
    of a lost attempt is never read. Only a name and a count per file reach the driver. Null ids come first, null
    and empty texts are their end id alone, repeated rows are written as often as they occur, and a table
    without rows gives no file. Very long texts are written as they are read, and columns other than these two are not
    read. Ids take two bytes each, or four (``wide``) where the vocabulary or ``end`` asks for it; an id that does not
    fit is refused.
    """
    if wide is None:
        wide = max(encoder(path, keep_space).largest_id(), end) >= 1 << 16
    folder = scratch_path(docs.sparkSession, "tokens")
    system, name = _at(folder)
    system.create_dir(name, recursive=True)

    def index_schema(batch: pa.RecordBatch) -> pa.Schema:
        return pa.schema([("doc_id", batch.schema.field("doc_id").type), ("start", pa.int64()), ("n", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        stem = f"{folder}/{part:06d}-{uuid.uuid4().hex}"
        out = index = None
        for batch in batches:
            if out is None:
                out = _Writer(f"{stem}.ids.arrow", length, wide)
                system, name = _at(f"{stem}.docs.arrow")
                sink = system.open_output_stream(name)
                index = pa.ipc.new_file(sink, index_schema(batch))
            starts, sizes = [], []
            for ids in id_arrays(batch.column("text"), path, keep_space, end):
                starts.append(out.total)
                sizes.append(len(ids))
                out.add(ids)
            arrays = [batch.column("doc_id"), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())]
            index.write_batch(pa.RecordBatch.from_arrays(arrays, schema=index_schema(batch)))
        if out is not None:
            out.close()
            index.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "stem": [stem], "ids": [out.total]})

    ordered = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    found = durable(ordered.mapInArrow(write, "part int, stem string, ids long"))
    return [(r["stem"], r["ids"]) for r in sorted(found.collect())]


def read_token_files(spark, files: Sequence[tuple[str, int]], id_type: T.DataType) -> DataFrame:
    """What the files hold: one row per document with its place among all ids, their number and checksum."""
    starts = np.cumsum([0, *[n for _, n in files]])[:-1].tolist()
    rows = [(stem, start) for (stem, _), start in zip(files, starts, strict=True)]
    listed = spark.createDataFrame(rows, "stem string, base long").repartition(max(1, len(rows)))
    fields = [T.StructField("doc_id", id_type)]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")]
    schema = T.StructType(fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stem, base in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                tokens = TokenFile(f"{stem}.ids.arrow")
                system, name = _at(f"{stem}.docs.arrow")
                index = pa.ipc.open_file(system.open_input_file(name))
                for number in range(index.num_record_batches):
                    docs = index.get_batch(number)
                    begins, sizes = docs.column("start").to_numpy(), docs.column("n").to_numpy()
                    sums = [
                        zlib.crc32(tokens.ids(a, n).astype("<u4").tobytes())
                        for a, n in zip(begins.tolist(), sizes.tolist(), strict=True)
                    ]
                    columns = [docs.column("doc_id"), pa.array(begins + base), pa.array(sizes), pa.array(sums, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

    return listed.mapInArrow(read, schema)
