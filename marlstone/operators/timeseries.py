"""Series operators over a long table: one row per (series, order key, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.plans.joins import attach
from marlstone.plans.positions import GROUP_ROWS, over_trailing_rows, with_position

SIGMA_FLOOR = 1e-9


def summary(df: DataFrame, *, series: Sequence[str], value: str) -> DataFrame:
    """Length, mean and population standard deviation per series."""
    return df.groupBy(*series).agg(
        F.count(value).alias("length"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
    )


def rolling(
    df: DataFrame,
    *,
    series: Sequence[str],
    order_by: Sequence[str],
    value: str,
    window: int = 7,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Trailing mean and population deviation; only full windows are returned."""
    if window < 1:
        raise ValueError("window must be at least 1")

    def columns(spec) -> dict[str, Column]:
        frame = spec.rowsBetween(-(window - 1), 0)
        return {
            "rolling_mean": F.avg(value).over(frame),
            "rolling_std": F.stddev_pop(value).over(frame),
        }

    narrow = df.select(*series, *order_by, value)
    framed = over_trailing_rows(
        narrow, keys=series, order_by=order_by, width=window, columns=columns, group_rows=group_rows
    )
    return framed.where(F.col("pos") >= window - 1).drop("pos", value)


def forecast(
    df: DataFrame,
    *,
    series: Sequence[str],
    order_by: Sequence[str],
    value: str,
    horizon: int = 5,
    method: str = "last",
) -> DataFrame:
    """``horizon`` future steps per series; unknown methods mean ``last``.

    One aggregate with map-side combine; nothing is sorted.
    """
    if horizon < 0:
        raise ValueError("horizon must not be negative")
    order = F.struct(*order_by)
    first, last = F.min_by(value, order), F.max_by(value, order)
    step = F.col("step")
    if method == "mean":
        ends, predicted = [F.avg(value).alias("level")], F.col("level")
    elif method == "drift":
        slope = (last - first) / F.greatest(F.count(value) - 1, F.lit(1))
        ends = [last.alias("level"), slope.alias("slope")]
        predicted = F.col("level") + F.col("slope") * step
    else:
        ends, predicted = [last.alias("level")], F.col("level")
    levels = df.groupBy(*series).agg(*ends)
    if horizon == 0:
        levels = levels.limit(0)
    steps = levels.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(max(horizon, 1)))))
    return steps.select(*series, "step", predicted.alias("forecast"))


def anomalies(
    df: DataFrame,
    *,
    series: Sequence[str],
    value: str,
    z: float = 3.0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows whose z-score exceeds ``z`` in absolute value (strictly).

    Aggregate and join, not a window: a series that holds most rows is still
    reduced map-side and scored wherever its rows lie.
    """
    stats = df.groupBy(*series).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")
    )
    rows = df.select(*series, *carry, value)
    scored = attach(rows, stats, series, how="inner").withColumn(
        "z", (F.col(value) - F.col("mean")) / (F.col("std") + F.lit(SIGMA_FLOOR))
    )
    return scored.where(F.abs("z") > z).drop("mean", "std")


def resample(
    df: DataFrame,
    *,
    series: Sequence[str],
    order_by: Sequence[str],
    value: str,
    factor: int = 2,
    method: str = "mean",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Mean or median of consecutive blocks of ``factor`` rows; a short last block is dropped."""
    if factor < 1:
        raise ValueError("factor must be at least 1")
    narrow = df.select(*series, *order_by, value)
    placed = with_position(narrow, keys=series, order_by=order_by, group_rows=group_rows)
    level = F.median(value) if method == "median" else F.avg(value)
    blocks = placed.groupBy(*series, F.expr(f"pos div {factor}").alias("block")).agg(
        F.count(F.lit(1)).alias("rows"), level.alias("resampled")
    )
    return blocks.where(F.col("rows") == factor).drop("rows")
