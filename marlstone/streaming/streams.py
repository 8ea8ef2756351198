"""Structured Streaming forms of ingest, resampling, anomaly scoring and keyed state.

Every run drains what has arrived (``availableNow``) into Parquet with a checkpoint, so
it can be stopped, repeated and scheduled; rows never pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlstone.operators import state
from marlstone.plans.durable import durable
from marlstone.plans.joins import attach
from marlstone.plans.positions import GROUP_ROWS, sums_before

SIGMA_FLOOR = 1e-9


def source(
    spark: SparkSession, path: str, schema: StructType, *, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as an unbounded table, oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def drain(stream: DataFrame, path: str, checkpoint: str, *, partition_by: Sequence[str] = ()) -> None:
    """Append everything available to a Parquet table, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("path", path).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()


def resample(
    stream: DataFrame,
    *,
    time: str,
    value: str,
    every: str,
    keys: Sequence[str] = (),
    lateness: str = "10 minutes",
    gap: str | None = None,
) -> DataFrame:
    """Mean and count per tumbling window, or per session when ``gap`` is given.

    Works on streams and tables. A stream emits a window once the watermark has passed it.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    frame = F.session_window(time, gap) if gap else F.window(time, every)
    return (
        timed.withWatermark(time, lateness)
        .groupBy(*keys, frame.alias("frame"))
        .agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
        .select(
            *keys,
            F.col("frame.start").alias("start"),
            F.col("frame.end").alias("end"),
            "mean",
            "n",
        )
    )


def resample_all(
    stream: DataFrame,
    root: str,
    *,
    time: str,
    value: str,
    every: str,
    keys: Sequence[str] = (),
    lateness: str = "10 minutes",
    gap: str | None = None,
) -> DataFrame:
    """Every window of all rows that have arrived: those of ``resample``, the open ones, and late rows in theirs.

    Arrived rows are kept in ``rows`` below ``root``; the stream's own windows are read from them and written to
    ``closed`` as the watermark passes. The result is the batch aggregate of the rows, with ``n_closed``, the count
    that the stream wrote for a window; it is null for open windows and too small where rows came late.
    """
    spark = stream.sparkSession
    frame = {"time": time, "value": value, "every": every, "keys": keys, "lateness": lateness, "gap": gap}
    kept = stream.select(*keys, time, value)
    drain(kept, f"{root}/rows", f"{root}/checkpoint/rows")
    closed = resample(source(spark, f"{root}/rows", kept.schema), **frame)
    drain(closed, f"{root}/closed", f"{root}/checkpoint/closed")
    whole = resample(spark.read.schema(kept.schema).parquet(f"{root}/rows"), **frame)
    names = [*keys, "start", "end"]
    written = spark.read.schema(closed.schema).parquet(f"{root}/closed")
    written = written.select(*[F.col(c).alias(f"__{c}") for c in names], F.col("n").alias("n_closed"))
    same = F.lit(True)
    for c in names:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return whole.join(written, same, "left").select(*whole.columns, "n_closed")


class _BatchStream:
    """A stream whose batches are folded into tables below ``root``.

    What a batch writes depends only on its id, its rows and what the batch before it left, and replaces what an
    earlier attempt of the same batch wrote. The checkpoint repeats a batch that did not end, so a run that was
    killed at any point goes on as if it had not been, in a new session too.
    """

    def __init__(self, spark: SparkSession, incoming: str, root: str, schema: StructType, files_per_batch: int | None):
        self.spark, self.incoming, self.root, self.schema = spark, incoming, root, schema
        self.files_per_batch = files_per_batch

    def advance(self) -> None:
        """Fold in all that has arrived."""
        stream = source(self.spark, self.incoming, self.schema, files_per_batch=self.files_per_batch)
        writer = stream.writeStream.foreachBatch(self.fold).trigger(availableNow=True)
        writer.option("checkpointLocation", f"{self.root}/checkpoint").start().awaitTermination()

    def fold(self, rows: DataFrame, batch: int) -> None:
        raise NotImplementedError


class AnomalyStream(_BatchStream):
    """Scores arriving rows against the statistics of the rows of their series before them.

    A row never counts towards its own mean: earlier batches come first, and within a batch ``order_by``, which must
    be unique in a series. State is one row per series: a count, a fixed point near the series' mean, and the first and
    second sums of the distances from it, which add up over any cut of the rows. So a series that holds most rows of
    a batch is not scanned by one task: its rows are cut into sorted slices (``positions.sums_before``). Rows without
    a value get no score and leave the state as it is; a null series is a series.
    """

    def __init__(
        self,
        spark: SparkSession,
        incoming: str,
        root: str,
        schema: StructType,
        *,
        series: Sequence[str],
        value: str,
        order_by: Sequence[str],
        z: float = 3.0,
        min_rows: int = 5,
        files_per_batch: int | None = None,
        group_rows: int = GROUP_ROWS,
    ):
        super().__init__(spark, incoming, root, schema, files_per_batch)
        self.series, self.value, self.order_by = list(series), value, list(order_by)
        self.z, self.min_rows, self.group_rows = z, min_rows, group_rows

    def _state(self, batch: int) -> str:
        """A batch reads the state of the one before and replaces that of the one before it."""
        return f"{self.root}/state/{batch % 2}"

    def fold(self, rows: DataFrame, batch: int) -> None:
        rows = durable(rows.withColumn("__series", F.struct(*self.series)))
        means = rows.groupBy("__series").agg(F.avg(self.value).alias("__mean"))
        zero = {"__n": F.lit(0).cast("long"), "__point": F.lit(None).cast("double"), "__s1": F.lit(0.0), "__s2": F.lit(0.0)}
        if batch:
            known = self.spark.read.parquet(self._state(batch - 1))
        else:
            known = means.withColumns(zero).drop("__mean").limit(0)
        # A series without a state starts at its mean in this batch.
        started = known.join(means, "__series", "full").select(
            "__series",
            F.coalesce("__n", zero["__n"]).alias("__n"),
            F.coalesce("__point", "__mean").alias("__point"),
            F.coalesce("__s1", zero["__s1"]).alias("__s1"),
            F.coalesce("__s2", zero["__s2"]).alias("__s2"),
        )
        started = durable(started)
        placed = attach(rows, started.join(means.select("__series"), "__series", "left_semi"), ["__series"], how="inner")
        off = F.col(self.value) - F.col("__point")
        adds = {
            "__n_before": F.when(off.isNotNull(), 1).otherwise(0).cast("long"),
            "__s1_before": F.coalesce(off, F.lit(0.0)),
            "__s2_before": F.coalesce(off * off, F.lit(0.0)),
        }
        placed = sums_before(durable(placed), keys=self.series, order_by=self.order_by, sums=adds, group_rows=self.group_rows)
        n = F.col("__n") + F.col("__n_before")
        shift = (F.col("__s1") + F.col("__s1_before")) / n
        spread = F.sqrt(F.greatest((F.col("__s2") + F.col("__s2_before")) / n - shift * shift, F.lit(0.0)))
        z = F.when(n >= self.min_rows, (off - shift) / (spread + F.lit(SIGMA_FLOOR)))
        scored = placed.select(*[f.name for f in self.schema.fields], z.alias("z"))
        scored.write.mode("overwrite").parquet(f"{self.root}/scored/batch={batch}")
        fresh = placed.groupBy("__series").agg(*[F.sum(c).alias(name) for name, c in adds.items()])
        after = started.join(fresh, "__series", "left").select(
            "__series",
            (F.col("__n") + F.coalesce("__n_before", F.lit(0))).alias("__n"),
            "__point",
            (F.col("__s1") + F.coalesce("__s1_before", F.lit(0.0))).alias("__s1"),
            (F.col("__s2") + F.coalesce("__s2_before", F.lit(0.0))).alias("__s2"),
        )
        after.write.mode("overwrite").parquet(self._state(batch))

    def scored(self) -> DataFrame:
        """All rows so far with ``z`` (null before ``min_rows``) and the ``batch`` that brought them."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        return self.spark.read.schema(f"{columns}, z double, batch long").parquet(f"{self.root}/scored")

    def anomalies(self) -> DataFrame:
        return self.scored().where(F.abs("z") > self.z)


class StateStream(_BatchStream):
    """Keyed writes arriving as files, folded into a snapshot with the last write per key.

    The snapshot is cut into buckets of keys. A batch is first reduced to its last write per key, then only the
    buckets it touches are read, merged and replaced (dynamic partition overwrite). Merging keeps the larger of
    ``order_by``, so a batch folded twice, or in part before a crash, leaves the same snapshot. A null key is a key.
    """

    def __init__(
        self,
        spark: SparkSession,
        incoming: str,
        root: str,
        schema: StructType,
        *,
        key: str,
        order_by: Sequence[str],
        buckets: int = 64,
        files_per_batch: int | None = None,
    ):
        super().__init__(spark, incoming, root, schema, files_per_batch)
        self.key, self.order_by, self.buckets = key, list(order_by), buckets

    def fold(self, rows: DataFrame, batch: int) -> None:
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        fresh = durable(state.latest(rows, key=self.key, order_by=self.order_by).withColumn("bucket", bucket))
        touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]
        # The first batch makes an empty snapshot, so that later ones need not ask whether there is one.
        if batch == 0:
            fresh.limit(0).write.mode("append").partitionBy("bucket").parquet(f"{self.root}/snapshot")
        kept = self._snapshot().where(F.col("bucket").isin(touched))
        merged = state.latest(kept.unionByName(fresh), key=self.key, order_by=self.order_by).withColumn("bucket", bucket)
        writer = durable(merged.repartition("bucket")).write.partitionBy("bucket").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.root}/snapshot")

    def _snapshot(self) -> DataFrame:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        return self.spark.read.schema(f"{columns}, bucket int").parquet(f"{self.root}/snapshot")

    def latest(self) -> DataFrame:
        """The snapshot: nothing else is read."""
        return self._snapshot().drop("bucket").select([f.name for f in self.schema.fields])
