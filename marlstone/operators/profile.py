"""Column statistics and missing-value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT_VALUES = 1_000_000
QUARTILES = (0.25, 0.5, 0.75)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe_numeric(
    df: DataFrame, *, columns: Sequence[str] | None = None, exact_values: int = EXACT_VALUES
) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max: one row per numeric column.

    Quartiles interpolate linearly and are exact at every size. While no column has
    more than ``exact_values`` distinct values, ``percentile`` merges one value map
    per column; beyond that they are read off a distributed sort.
    """
    names = list(columns or numeric_columns(df))
    long = _unpivot_numbers(df, names)
    stats = long.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    if _widest(df, names) <= exact_values:
        cut = F.percentile("value", F.lit(list(QUARTILES))).alias("cut")
        quartiles = long.groupBy("column_name").agg(cut).select(
            "column_name",
            *[F.get("cut", F.lit(i)).alias(f"p{int(q * 100)}") for i, q in enumerate(QUARTILES)],
        )
    else:
        quartiles = _sorted_quartiles(long.where(F.col("value").isNotNull()))
    return stats.join(quartiles, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def _unpivot_numbers(df: DataFrame, names: list[str]) -> DataFrame:
    numbers = df.select(*[F.col(n).cast("double").alias(n) for n in names])
    return numbers.unpivot([], names, "column_name", "value")


def _widest(df: DataFrame, names: list[str]) -> int:
    sizes = df.agg(*[F.approx_count_distinct(n).alias(n) for n in names]).first()
    return max(sizes)


def _sorted_quartiles(long: DataFrame) -> DataFrame:
    """Quartiles from ranks: values are counted first, so a hot value is one row."""
    from marlstone.plans.positions import with_position

    counted = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = with_position(counted, keys=(), order_by=("column_name", "value"), name="at")
    # Blocks of values carry their row totals, so no running sum walks a whole column.
    block = placed.withColumn("block", F.expr("at div 100000"))
    totals = block.groupBy("column_name", "block").agg(F.sum("n").alias("rows"))
    earlier = (
        Window.partitionBy("column_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    sizes = totals.groupBy("column_name").agg(F.sum("rows").alias("total"))
    inside = (
        Window.partitionBy("column_name", "block")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = (
        block.withColumn("upto", F.sum("n").over(inside))
        .join(offsets, ["column_name", "block"])
        .join(sizes, "column_name")
        .withColumn("last", F.col("before") + F.col("upto") - 1)
        .withColumn("first", F.col("last") - F.col("n") + 1)
    )

    def quantile(q: float):
        at = (F.col("total") - 1) * F.lit(q)
        low, high = F.floor(at), F.ceil(at)
        pick = [
            F.max(F.when((F.col("first") <= edge) & (F.col("last") >= edge), F.col("value")))
            for edge in (low, high)
        ]
        share = F.max(at - low)
        return (pick[0] + (pick[1] - pick[0]) * share).alias(f"p{int(q * 100)}")

    return ranked.groupBy("column_name").agg(*[quantile(q) for q in QUARTILES])


def describe_categorical(df: DataFrame, *, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value and its frequency per column.

    Ties for the most frequent value go to the smallest one.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], list(columns), "column_name", "value")
    counts = (
        long.where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def missing(df: DataFrame) -> DataFrame:
    """NULL count of every column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "missing")


def dtypes(df: DataFrame) -> DataFrame:
    """Column names, types and the row count of a loaded table."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"), F.lit(n).alias("column_name"), F.lit(t).alias("dtype")
            )
            for i, (n, t) in enumerate(df.dtypes)
        ]
    )
    counted = df.agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("rows", F.inline(fields)).select(
        "ordinal", "column_name", "dtype", "rows"
    )
