"""Gapless row numbers over a whole table, written once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.plans.durable import durable

_ORDINAL, _AT, _PART = "__ordinal", "__at", "__part"
_WITHIN = 33


def numbered(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """``df`` with the 0-based place of each row in ``order``, in a table in the shared folder.

    Rows are range-partitioned and sorted; a place is the row's place in its partition plus the rows of the
    partitions before it. Only one count per partition reaches the driver. Rows that tie in ``order`` follow
    the reader's order, and so spread over partitions however many there are.
    """
    keyed = df.withColumn(_ORDINAL, F.monotonically_increasing_id())
    cut = durable(
        keyed.repartitionByRange(*order, F.col(_ORDINAL))
        .sortWithinPartitions(*order, F.col(_ORDINAL))
        .drop(_ORDINAL)
        .withColumn(_AT, F.monotonically_increasing_id())
    )
    part = F.shiftright(_AT, _WITHIN).cast("int")
    counts = sorted(cut.groupBy(part.alias(_PART)).count().collect())
    starts, total = [], 0
    for at, rows in counts:
        starts.append((at, total))
        total += rows
    offsets = df.sparkSession.createDataFrame(starts, f"{_PART} int, __start long")
    placed = cut.withColumn(_PART, part).join(F.broadcast(offsets), _PART)
    within = F.col(_AT).bitwiseAND(F.lit((1 << _WITHIN) - 1))
    return placed.withColumn(name, F.col("__start") + within).drop(_PART, _AT, "__start")
