"""Reading, sampling, splitting and publishing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "orc", "csv", "json", "text")


def load_dataset(
    spark: SparkSession,
    path: str,
    *,
    fmt: str | None = None,
    schema=None,
    split_col: str | None = None,
    split: str | None = None,
) -> DataFrame:
    """A lazy table; the format follows the file ending unless given.

    ``split`` filters on ``split_col``, which prunes folders when the table is
    partitioned by it.
    """
    kind = fmt or next((f for f in FORMATS if path.rstrip("/").endswith(f".{f}")), "parquet")
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind!r}; expected one of {', '.join(FORMATS)}")
    reader = spark.read.format(kind)
    if schema is not None:
        reader = reader.schema(schema)
    elif kind == "csv":
        reader = reader.option("inferSchema", True)
    if kind == "csv":
        reader = reader.option("header", True)
    df = reader.load(path)
    if split is not None:
        if not split_col:
            raise ValueError("split needs split_col")
        df = df.where(F.col(split_col) == split)
    return df


def spread(df: DataFrame, *, max_bytes: int = 1 << 30) -> DataFrame:
    """A small table over all cores, for work that is heavy per row.

    One row group is one task, however heavy its rows. Tables above ``max_bytes`` have
    splits enough and stay as they are: they are never shuffled for this.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) > max_bytes:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def load_csv(spark: SparkSession, path: str, *, schema=None) -> DataFrame:
    """A CSV table with a header row; types are inferred when no schema is given."""
    return load_dataset(spark, path, fmt="csv", schema=schema)


def peek(df: DataFrame, *, order_by: Sequence[str], rows: int = 3) -> DataFrame:
    """The first rows by an explicit order, without counting the table."""
    return df.orderBy(*order_by).limit(rows)


def summarize(df: DataFrame, *, order_by: Sequence[str], rows: int = 3) -> DataFrame:
    """Row and column counts next to the first rows, as JSON lines in order."""
    counted = df.count()
    first = F.array_sort(
        F.collect_list(F.struct(*order_by, F.to_json(F.struct(*df.columns)).alias("row")))
    )
    return peek(df, order_by=order_by, rows=rows).agg(
        F.lit(counted).alias("num_rows"),
        F.lit(len(df.columns)).alias("num_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.array_join(F.transform(first, lambda r: r["row"]), "\n").alias("sample"),
    )


def sft_sample(
    df: DataFrame,
    *,
    order_by: Sequence[str],
    text_col: str,
    max_samples: int | None = 1000,
) -> DataFrame:
    """The first ``max_samples`` rows by ``order_by``; ``None`` or 0 keeps all."""
    if text_col not in df.columns:
        raise ValueError(f"no column {text_col!r}; have {', '.join(df.columns)}")
    return df.orderBy(*order_by).limit(max_samples) if max_samples else df


def search_catalog(
    df: DataFrame,
    *,
    search_in: str,
    query: str = "",
    facets: dict[str, object] | None = None,
    sort_by: str,
    key: str,
    limit: int = 10,
) -> DataFrame:
    """Case-insensitive containment and equality facets, largest ``sort_by`` first."""
    kept = df
    if query:
        kept = kept.where(F.contains(F.lower(search_in), F.lit(query.lower())))
    for column, wanted in (facets or {}).items():
        kept = kept.where(F.col(column) == F.lit(wanted))
    return kept.orderBy(F.desc(sort_by), F.asc(key)).limit(limit)


def card(df: DataFrame, *, key: str, wanted, tags: str | None = None, text: str | None = None):
    """Point lookup with the tag list cut to 20 and the card text to 500 characters."""
    found = df.where(F.col(key) == F.lit(wanted))
    if tags:
        found = found.withColumn(tags, F.slice(tags, 1, 20))
    if text:
        found = found.withColumn(text, F.substring(text, 1, 500))
    return found


def filter_dataset(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Rows for which a SQL expression holds; it reaches the scan when it can."""
    return df.where(predicate)


def map_dataset(df: DataFrame, columns: dict[str, str | Column]) -> DataFrame:
    """Add or replace columns by SQL expressions."""
    return df.withColumns(
        {n: F.expr(e) if isinstance(e, str) else e for n, e in columns.items()}
    )


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """Apply a Python function to Arrow record batches."""
    return df.mapInArrow(fn, schema)


def publish(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    fmt: str = "parquet",
) -> DataFrame:
    """Write a table and return its one-row manifest, computed from the written copy.

    The content hash adds up row hashes, so it does not depend on row order.
    """
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    written = load_dataset(df.sparkSession, path, fmt=fmt, schema=df.schema)
    return manifest(written.select(*df.columns))


def manifest(df: DataFrame) -> DataFrame:
    row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in df.columns]))
    part = F.conv(F.substring(row, 1, 8), 16, 10).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"), F.coalesce(F.sum(part), F.lit(0)).alias("content_hash")
    ).withColumn("columns", F.lit(",".join(df.columns)))
