"""Sharding by a keyed permutation of global row numbers.

A Feistel network over the smallest even number of bits that holds all rows is a bijection; values that
land beyond the last row are sent through it again (cycle walking) until they are inside, which makes it a
bijection of the row numbers themselves. Shard and slot follow from the permuted place alone, so that any
row can be located, and any place traced back, without a table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.numbering import numbered
from marlstone.llm.textarrays import mix

ROUNDS = 6


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round_keys(key: str) -> list[np.uint64]:
    digests = (hashlib.blake2b(f"{key}:{i}".encode(), digest_size=8).digest() for i in range(ROUNDS))
    return [np.uint64(int.from_bytes(d, "little")) for d in digests]


def _once(x: np.ndarray, half: int, keys: Sequence[np.uint64]) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for key in keys:
        left, right = right, left ^ (mix(right + key) & mask)
    return (right << shift) | left


def _walk(x: np.ndarray, n: int, keys: Sequence[np.uint64]) -> np.ndarray:
    out = np.asarray(x).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        out[todo] = _once(out[todo], _half_bits(n), keys)
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def permute(rows: np.ndarray, n: int, key: str) -> np.ndarray:
    """Places of the row numbers ``rows`` (all below ``n``) in the shuffled order."""
    return _walk(rows, n, _round_keys(key))


def row_at(places: np.ndarray, n: int, key: str) -> np.ndarray:
    """The row numbers that ``permute`` sends to ``places``."""
    # Swapping halves on the way out makes the same network with reversed keys its own inverse.
    return _walk(places, n, _round_keys(key)[::-1])


def place_of(row: int, n: int, shards: int, key: str) -> tuple[int, int]:
    """Shard and slot of one row number."""
    place = int(permute(np.array([row]), n, key)[0])
    return place % shards, place // shards


def shard(df: DataFrame, *, order: Sequence[Column], shards: int, key: str) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` and ``slot``: a reproducible shuffle dealt over ``shards``.

    ``order`` fixes the row numbers. Shards differ by one row at most and their slots have no gaps. Nulls in
    ``order`` come first, ties follow the reader's order, repeated rows each take a place of their own, and an
    empty table stays empty. Columns of the input named like the three new ones are replaced.
    """
    plain = df.drop("row_number", "shard", "slot")
    rows = numbered(plain, order)
    n = rows.count()

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, key))

    placed = rows.withColumn("__place", place("row_number"))
    return placed.select(
        *rows.columns,
        (F.col("__place") % shards).cast("int").alias("shard"),
        F.expr(f"__place div {shards}").alias("slot"),
    )
