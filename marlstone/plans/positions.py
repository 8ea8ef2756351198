"""Row positions and trailing frames that never put one whole group in one task.

A plain window is right while every group fits a task. The size of the largest
group is therefore counted first (a map-side combined count over the key columns
only); beyond the bound the rows are range-partitioned on (keys, order), which
cuts a hot group into as many sorted slices as its size asks for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.plans.durable import durable

GROUP_ROWS = 2_000_000
BLOCK_ROWS = 100_000

_SLICE = "__slice"
_AT = "__at"
_START = "__start"
_ROWS = "__rows"
_BLOCK = "__block"
_COPY = "__copy"


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest group."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS))
    return counts.agg(F.max(_ROWS)).first()[0] or 0


def with_position(
    df: DataFrame,
    *,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "pos",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add the 0-based rank of each row within ``keys``; ``order_by`` must be unique there."""
    if keys and largest_group(df, keys) <= group_rows:
        ranked = Window.partitionBy(*keys).orderBy(*order_by)
        return df.withColumn(name, F.row_number().over(ranked).cast("long") - F.lit(1))
    return _position_by_slices(df, list(keys), list(order_by), name, group_rows)


def _position_by_slices(
    df: DataFrame, keys: list[str], order_by: list[str], name: str, group_rows: int
) -> DataFrame:
    cut = _sliced(df, [*keys, *order_by], group_rows)
    parts = cut.groupBy(*keys, _SLICE).agg(
        F.count(F.lit(1)).alias(_ROWS), F.min(_AT).alias("__first")
    )
    # At most one row per key and slice: the running total never sees the data itself.
    before = (
        Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = parts.select(
        *keys,
        _SLICE,
        (F.coalesce(F.sum(_ROWS).over(before), F.lit(0)) - F.col("__first")).alias(_START),
    )
    placed = _null_safe_join(cut, starts, keys)
    return placed.withColumn(name, F.col(_AT) + F.col(_START)).select(*df.columns, name)


def _sliced(df: DataFrame, sort_keys: list[str], group_rows: int) -> DataFrame:
    """``df`` cut into sorted ranges: the slice of each row and its place there."""
    rows = df.count()
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Slice ids come from sampled bounds, so the cut is written once and read twice.
    return durable(
        df.repartitionByRange(max(least, -(-rows // group_rows), 1), *sort_keys)
        .sortWithinPartitions(*sort_keys)
        .withColumn(_SLICE, F.spark_partition_id())
        .withColumn(_AT, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )


def _null_safe_join(cut: DataFrame, starts: DataFrame, keys: list[str], carried: Sequence[str] = (_START,)) -> DataFrame:
    right = starts.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], F.col(_SLICE).alias("__r_slice"), *carried
    )
    same = F.col(_SLICE) == F.col("__r_slice")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__r_{key}"))
    return cut.join(right, same)


def sums_before(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order_by: Sequence[str],
    sums: dict[str, Column],
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add, per name of ``sums``, the sum of its column over the group's earlier rows (0 before the first).

    ``order_by`` must be unique in a group. A hot group is cut into sorted slices: running sums stay inside a
    slice, and what lies before it comes from one row per group and slice. Null keys form a group.
    """
    if largest_group(df, keys) <= group_rows:
        return df.withColumns(_running(sums, list(keys), list(order_by)))
    cut = _sliced(df, [*keys, *order_by], group_rows)
    parts = cut.groupBy(*keys, _SLICE).agg(*[F.sum(c).alias(f"__sum_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*keys, _SLICE, *[F.coalesce(F.sum(f"__sum_{n}").over(earlier), F.lit(0)).alias(f"__from_{n}") for n in sums])
    placed = _null_safe_join(cut, starts, list(keys), [f"__from_{n}" for n in sums])
    within = placed.withColumns(_running(sums, [*keys, _SLICE], list(order_by)))
    return within.select(*df.columns, *[(F.col(n) + F.col(f"__from_{n}")).alias(n) for n in sums])


def _running(sums: dict[str, Column], keys: list[str], order_by: list[str]) -> dict[str, Column]:
    before = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    return {n: F.coalesce(F.sum(c).over(before), F.lit(0)) for n, c in sums.items()}

def over_trailing_rows(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order_by: Sequence[str],
    width: int,
    columns,
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add window columns that look back at most ``width - 1`` rows, plus ``pos``.

    ``columns(window)`` gets a window spec ordered within the group and returns
    ``{name: Column}``. A hot group is cut into blocks; each block carries a copy
    of the ``width - 1`` rows before it, so every frame is complete in its block.
    """
    if keys and largest_group(df, keys) <= group_rows:
        window = Window.partitionBy(*keys).orderBy(*order_by)
        pos = F.row_number().over(window).cast("long") - F.lit(1)
        return df.withColumns({"pos": pos, **columns(window)})
    placed = _position_by_slices(df, list(keys), list(order_by), "pos", group_rows)
    size = max(block_rows, width)
    block = F.expr(f"pos div {size}")
    in_halo = F.col("pos") % F.lit(size) > F.lit(size - width)
    own = F.struct(block.alias("block"), F.lit(False).alias("copy"))
    following = F.struct((block + 1).alias("block"), F.lit(True).alias("copy"))
    copied = placed.withColumn(
        _BLOCK, F.explode(F.when(in_halo, F.array(own, following)).otherwise(F.array(own)))
    ).select("*", F.col(f"{_BLOCK}.block").alias("__b"), F.col(f"{_BLOCK}.copy").alias(_COPY))
    window = Window.partitionBy(*keys, "__b").orderBy("pos")
    framed = copied.withColumns(columns(window)).where(~F.col(_COPY))
    return framed.drop(_BLOCK, "__b", _COPY)


def hash_unit(key: Column, seed: int) -> Column:
    """A reproducible number in [0, 2**32) for ``key``: the md5 prefix of ``key:seed``."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
