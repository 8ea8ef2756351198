"""Similarity search over tables of vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from marlstone.functions import vectors as V
from marlstone.plans import neighbors
from marlstone.plans.durable import durable
from marlstone.plans.positions import with_position

SEED = 42
# Rows on which the centroids of inverted lists are fitted at most.
SAMPLE_ROWS = 1_000_000


def cosine_pairs(pairs: DataFrame, *, left: str, right: str, name: str = "cosine") -> DataFrame:
    """Add the cosine of two vector columns; row-local."""
    return pairs.withColumn(name, V.cosine(F.col(left), F.col(right)))


def normalize(df: DataFrame, *, vec: str) -> DataFrame:
    return df.withColumn(vec, V.normalize(F.col(vec)))


def add_vectors(
    index: DataFrame | None,
    batch: DataFrame,
    *,
    order_by: Sequence[str],
    vec: str,
    dim: int,
) -> DataFrame:
    """Append a batch at the next positions; every vector must have ``dim`` entries.

    The first free position is one past the largest used one, a bounded fact.
    """
    last = index.agg(F.max("pos")).first()[0] if index is not None else None
    placed = at_positions(
        batch, order_by=order_by, vec=vec, dim=dim, start=-1 if last is None else last
    )
    return placed if index is None else index.unionByName(placed)


def at_positions(
    batch: DataFrame, *, order_by: Sequence[str], vec: str, dim: int, start: int
) -> DataFrame:
    """Number a batch from ``start + 1`` on, refusing vectors of another length."""
    wrong = F.raise_error(F.lit(f"expected vectors of length {dim}")).cast("array<float>")
    checked = batch.withColumn(vec, F.when(F.size(vec) == dim, F.col(vec)).otherwise(wrong))
    placed = with_position(checked, order_by=order_by, name="pos")
    return placed.withColumn("pos", F.col("pos") + F.lit(start + 1))


def nlist_for(dim: int) -> int:
    """Number of inverted lists for vectors of length ``dim`` where none is asked for."""
    return min(100, max(1, dim // 4))


def train_cells(
    base: DataFrame, *, vec: str, nlist: int | None = None, seed: int = SEED, sample_rows: int = SAMPLE_ROWS
) -> np.ndarray:
    """Centroids of a coarse quantizer, one row each.

    They are fitted on at most ``sample_rows`` rows, those with the smallest hash; every row is indexed. Null vectors
    take no part. With fewer distinct rows than ``nlist`` there are fewer centroids.
    """
    held = base.where(F.col(vec).isNotNull()).select(F.col(vec).cast("array<double>").alias("v"))
    rows = held.count()
    if not rows:
        raise ValueError("no vectors to train on")
    share = F.xxhash64("v").bitwiseAND(F.lit((1 << 30) - 1)) < F.lit(int((1 << 30) * min(1.0, sample_rows / rows)))
    features = durable((held.where(share) if rows > sample_rows else held).select(array_to_vector("v").alias("features")))
    lists = nlist or nlist_for(len(held.first()[0]))
    model = KMeans(k=min(lists, rows), seed=seed, maxIter=10, distanceMeasure="euclidean").fit(features)
    return np.array(model.clusterCenters())


def assign_cells(df: DataFrame, centers: np.ndarray, *, vec: str, nprobe: int = 1, name: str = "cell") -> DataFrame:
    """One row per vector and each of its ``nprobe`` nearest centroids, found by one matrix product per batch.

    Equal distances go to the smaller list. The centroids are broadcast once; their number is a parameter.
    """
    known = df.sparkSession.sparkContext.broadcast(np.asarray(centers, float))
    many = min(nprobe, len(centers))

    @F.pandas_udf("array<int>")
    def nearest(vectors: pd.Series) -> pd.Series:
        lists = known.value
        if not len(vectors):
            return pd.Series([], dtype=object)
        x = np.stack(vectors.to_numpy()).astype(float)
        gap = np.round((lists**2).sum(1)[None, :] - 2 * x @ lists.T, 9)
        return pd.Series(list(np.argsort(gap, axis=1, kind="stable")[:, :many].astype(np.int32)))

    return df.where(F.col(vec).isNotNull()).withColumn(name, F.explode(nearest(F.col(vec))))


def search(
    base: DataFrame,
    queries: DataFrame,
    *,
    id: str,
    vec: str,
    query_id: str,
    query_vec: str | None = None,
    k: int = 5,
    metric: str = "ip",
    method: str = "exact",
    nprobe: int = 1,
    nlist: int | None = None,
    centers: np.ndarray | None = None,
    tables: int = 8,
    bucket_length: float = 0.5,
    carry: Sequence[str] = (),
    **limits,
) -> DataFrame:
    """The ``k`` nearest base rows of every query: query id, rank, id, score, carried columns.

    ``score`` is the inner product, the cosine, or the squared distance. Equal scores
    go to the smaller id; ids are of any type that can be ordered. ``method`` is ``exact``, ``ivf`` (``nlist``
    inverted lists, ``nprobe`` of them per query) or ``lsh`` (random projections, ``tables`` hash tables).
    """
    if metric not in neighbors.METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    if k < 1:
        raise ValueError("k must be at least 1")
    rows, known = _numbered(base.select(F.col(id).alias("id"), F.col(vec).alias("vec")))
    asked, named = _numbered(queries.select(F.col(query_id).alias("id"), F.col(query_vec or vec).alias("vec")))
    if method == "exact":
        hits = neighbors.exact(rows, asked, k, metric, **limits)
    elif method == "ivf":
        cells = train_cells(rows, vec="vec", nlist=nlist) if centers is None else centers
        hits = neighbors.within_cells(
            assign_cells(rows, cells, vec="vec"),
            assign_cells(asked, cells, vec="vec", nprobe=nprobe),
            k,
            metric,
            **limits,
        )
    elif method == "lsh":
        lsh = BucketedRandomProjectionLSH(
            inputCol="features",
            outputCol="hashes",
            bucketLength=bucket_length,
            numHashTables=tables,
            seed=SEED,
        )
        hasher = lsh.fit(_features(rows))
        hits = neighbors.within_cells(
            _buckets(hasher, rows), _buckets(hasher, asked), k, metric, **limits
        )
    else:
        raise ValueError(f"unknown method {method!r}")
    score = -F.col("score") if metric == "l2" else F.col("score")
    found = hits.select("query_id", "rank", "id", score.alias("score"))
    if known is not None:
        found = found.withColumnRenamed("id", "__at").join(known, "__at").drop("__at")
    if named is not None:
        found = found.withColumnRenamed("query_id", "__at").join(named.withColumnRenamed("id", "query_id"), "__at")
    if carry:
        details = base.select(F.col(id).alias("id"), *carry)
        found = found.join(details, "id")
    return found.select("query_id", "rank", "id", "score", *carry)


def _numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` (``id``, ``vec``) with whole numbers as ids, and the ids by number (``__at``) where they are something else.

    Rows without a vector or an id take no part. Numbers follow the order of the ids, so ties stay with the smaller.
    """
    sound = rows.where(F.col("vec").isNotNull() & F.col("id").isNotNull())
    if isinstance(rows.schema["id"].dataType, IntegralType):
        return sound.withColumn("id", F.col("id").cast("long")), None
    known = durable(with_position(sound.select("id").distinct(), order_by=["id"], name="__at"))
    return durable(sound.join(known, "id").select(F.col("__at").alias("id"), "vec")), known


def _features(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col("vec").cast("array<double>")))


def _buckets(hasher, df: DataFrame) -> DataFrame:
    """One row per vector and hash table; the cell is the table with its bucket."""
    from pyspark.ml.functions import vector_to_array

    hashed = hasher.transform(_features(df)).select("id", "vec", F.posexplode("hashes").alias("t", "h"))
    bucket = F.get(vector_to_array("h"), F.lit(0)).cast("long")
    return hashed.select("id", "vec", F.xxhash64("t", bucket).alias("cell"))


def save_index(index: DataFrame, path: str, *, cell: str | None = None) -> None:
    """Write an index as Parquet, one folder per inverted list when it has them."""
    writer = index.write
    if cell:
        index = index.repartition(cell, F.pmod(F.xxhash64("pos"), F.lit(16)))
        writer = index.write.partitionBy(cell)
    writer.parquet(path)


def load_index(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def index_info(index: DataFrame, *, vec: str, cell: str, metric: str, kind: str) -> DataFrame:
    """Total, dimension, metric, type and the size of every inverted list."""
    lists = index.groupBy(cell).agg(
        F.count(F.lit(1)).alias("in_list"), F.max(F.size(vec)).alias("dim")
    )
    totals = lists.agg(F.sum("in_list")).first()[0] or 0
    return lists.select(
        F.lit(totals).cast("long").alias("total"),
        "dim",
        F.lit(metric).alias("metric"),
        F.lit(kind).alias("kind"),
        F.col(cell).alias("list_id"),
        "in_list",
    )


def label_centers(df: DataFrame, *, vec: str, label: str) -> DataFrame:
    """Mean vector of every label, summed per (label, position) so no group is collected."""
    long = df.select(F.col(label).alias("label"), F.posexplode(vec).alias("at", "x"))
    means = long.groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    return means.groupBy("label").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("at", "mean"))), lambda s: s["mean"]
        ).alias("vec")
    )


def label_scores(
    df: DataFrame, centers: DataFrame, *, id: str, vec: str, k: int = 5
) -> DataFrame:
    """The ``k`` labels whose centers (label, vec) are closest in cosine to each vector."""
    return search(
        centers, df, id="label", vec="vec", query_id=id, query_vec=vec, k=k, metric="cosine"
    ).select(F.col("query_id").alias(id), F.col("id").alias("label"), "score")
