"""Words of a batch of texts as Arrow and numpy arrays: split and coded for a whole piece of the batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 22


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string column with at most ``limit`` bytes, or one text; with their first row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, done = 0, 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield at, column.slice(at, stop - at)
        at, done = stop, int(ends[stop - 1])


def split_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of texts whose words stand apart by blanks: each word's row and its place among the distinct words, and these.

    Null and empty texts have no words.
    """
    lists = pc.split_pattern(column, " ")
    row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.list_flatten(lists).dictionary_encode()
    code, terms = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    word = pc.not_equal(terms, "").to_numpy(zero_copy_only=False)[code]
    return row[word], code[word], terms
