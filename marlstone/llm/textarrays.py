"""Words and shingles of a batch of texts as numpy arrays.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased. Work is done on the
bytes of a whole batch; memory is bounded by ``BLOCK`` bytes at a time (or by the longest word).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, base: int, n: int) -> np.ndarray:
    known = _powers[name]
    while len(known) < n:
        step = np.uint64(pow(base, len(known), 1 << 64))
        known = np.concatenate([known, known * step])
    _powers[name] = known
    return known[:n]


def bounded(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string column with at most ``limit`` bytes, or one text; with their first row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at, done = 0, 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield at, column.slice(at, stop - at)
        at, done = stop, int(sizes[stop - 1])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and where each begins; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not offsets[-1] - offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of the first word of each text (plus the end)."""
    data, offsets = text_bytes(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(~space & (edge[:-1] | np.concatenate([[True], space[:-1]])))
    ends = np.flatnonzero(~space & (edge[1:] | np.concatenate([space[1:], [True]]))) + 1
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, side="right")))
        a, b = starts[at], ends[stop - 1]
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_VALUES[_LOWER[data[a:b]]] * _power("up", _BASE, b - a), out=sums[1:])
        s, e = starts[at:stop] - a, ends[at:stop] - a
        raw = (sums[e] - sums[s]) * _power("down", _INVERSE, b - a)[s]
        out[at:stop] = mix(raw + (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at = stop
    return out, np.searchsorted(starts, offsets)


def shingles(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``size``-word shingles.

    A text of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    hashes, first = words(column)
    count = len(hashes) - size + 1
    runs = np.zeros(0, np.uint64)
    if count > 0:
        runs = hashes[:count].copy()
        for k in range(1, size):
            runs = mix(runs) * np.uint64(_BASE) + hashes[k : k + count]
        runs = mix(runs)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        elif b > a:
            whole = hashes[a:b].tobytes() + bytes([size])
            yield np.frombuffer(hashlib.blake2b(whole, digest_size=8).digest(), np.uint64)
        else:
            yield np.zeros(0, np.uint64)
