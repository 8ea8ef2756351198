"""Document collections: batches, metadata filters, statistics and a Parquet store.

A collection is rows ``(id, document, metadata map<string,string>, ...)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.plans.durable import durable
from marlstone.sources.batches import BatchTable


def with_default_ids(batch: DataFrame, *, document: str, order_by: Sequence[str], id: str = "id"):
    """Missing ids become the text's hash plus its occurrence, so reruns agree."""
    from marlstone.plans.positions import with_position

    digest = F.sha2(F.col(document), 256)
    named = batch.withColumn("__digest", digest)
    counted = with_position(named, keys=["__digest"], order_by=order_by, name="__copy")
    made = F.concat_ws("-", "__digest", F.col("__copy").cast("string"))
    current = F.col(id) if id in batch.columns else F.lit(None).cast("string")
    return counted.withColumn(id, F.coalesce(current, made)).drop("__digest", "__copy")


def first_of_each(batch: DataFrame, *, id: str, order_by: Sequence[str]) -> DataFrame:
    """The earliest row of every id: a combined aggregate, not a window."""
    return _one_of_each(batch, id, F.min_by, order_by)


def last_of_each(batch: DataFrame, *, id: str, order_by: Sequence[str]) -> DataFrame:
    return _one_of_each(batch, id, F.max_by, order_by)


def _one_of_each(batch: DataFrame, id: str, pick, order_by: Sequence[str]) -> DataFrame:
    whole = F.struct(*batch.columns)
    chosen = batch.groupBy(F.col(id).alias("__id")).agg(
        pick(whole, F.struct(*order_by)).alias("row")
    )
    return chosen.select("row.*")


def add(old: DataFrame, new: DataFrame, *, id: str = "id", order_by: Sequence[str]) -> DataFrame:
    """Append documents whose id is not there yet; the first of a batch's repeats stays."""
    fresh = first_of_each(new, id=id, order_by=order_by).join(old.select(id), id, "left_anti")
    return old.unionByName(fresh)


def update(old: DataFrame, new: DataFrame, *, id: str = "id", order_by: Sequence[str]) -> DataFrame:
    """Insert or replace by id; the last of a batch's repeats wins."""
    incoming = last_of_each(new, id=id, order_by=order_by)
    return old.join(incoming.select(id), id, "left_anti").unionByName(incoming)


def where(conditions: dict, metadata: Column | str = "metadata") -> Column:
    """A metadata filter as a column: equality, ``$ne $gt $gte $lt $lte $in $nin $and $or``.

    Numbers compare as numbers. As in a document store, ``$ne`` and ``$nin`` also keep
    rows that lack the key.
    """
    source = F.col(metadata) if isinstance(metadata, str) else metadata
    parts = []
    for name, wanted in conditions.items():
        if name in ("$and", "$or"):
            branches = [where(c, source) for c in wanted]
            joined = reduce(Column.__and__ if name == "$and" else Column.__or__, branches)
            parts.append(joined)
        elif isinstance(wanted, dict):
            parts.extend(_compare(source, name, op, value) for op, value in wanted.items())
        else:
            parts.append(_compare(source, name, "$eq", wanted))
    if not parts:
        return F.lit(True)
    return reduce(Column.__and__, parts)


def _compare(source: Column, key: str, op: str, value) -> Column:
    sample = value[0] if isinstance(value, (list, tuple)) and value else value
    text = F.try_element_at(source, F.lit(key))
    if isinstance(sample, bool):
        found = F.lower(text)
        value = [str(v).lower() for v in value] if isinstance(value, (list, tuple)) else str(value).lower()
    elif isinstance(sample, (int, float)):
        found = text.try_cast("double")
    else:
        found = text
    tests = {
        "$eq": lambda: found == value,
        "$ne": lambda: found != value,
        "$gt": lambda: found > value,
        "$gte": lambda: found >= value,
        "$lt": lambda: found < value,
        "$lte": lambda: found <= value,
        "$in": lambda: found.isin(list(value)),
        "$nin": lambda: ~found.isin(list(value)),
    }
    if op not in tests:
        raise ValueError(f"unknown filter operator {op!r}")
    return F.coalesce(tests[op](), F.lit(op in ("$ne", "$nin")))


def query(
    collection: DataFrame,
    queries: DataFrame,
    *,
    id: str,
    vec: str,
    query_id: str,
    query_vec: str | None = None,
    k: int = 5,
    conditions: dict | None = None,
    carry: Sequence[str] = (),
    **how,
) -> DataFrame:
    """Nearest documents by squared distance among those that pass the filter."""
    from marlstone.operators.vectors import search

    kept = collection.where(where(conditions)) if conditions else collection
    return search(
        kept,
        queries,
        id=id,
        vec=vec,
        query_id=query_id,
        query_vec=query_vec,
        k=k,
        metric="l2",
        carry=carry,
        **how,
    )


def counts(registry: DataFrame, documents: DataFrame) -> DataFrame:
    """Every registered collection with its number of documents, zero included."""
    held = documents.groupBy("collection").agg(F.count(F.lit(1)).alias("n"))
    return registry.join(held, "collection", "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )


def without(documents: DataFrame, name: str) -> DataFrame:
    """All documents but those of one collection."""
    return documents.where(F.col("collection") != name)


def stats(documents: DataFrame, *, document: str = "document") -> DataFrame:
    """Documents, distinct ids, text lengths and metadata keys and values per collection."""
    length = F.length(document)
    base = documents.groupBy("collection").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(length).alias("avg_length"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
    )
    # Distinct values go through their own two-step aggregate, combined before the shuffle.
    ids = _distinct(documents.select("collection", "id"), "ids")
    tags = documents.select("collection", F.explode("metadata").alias("key", "value"))
    keys = _distinct(tags.select("collection", "key"), "metadata_keys")
    values = _distinct(tags, "metadata_values")
    joined = base.join(ids, "collection", "left")
    for extra in (keys, values):
        joined = joined.join(extra, "collection", "left")
    return joined.fillna(0, ["ids", "metadata_keys", "metadata_values"])


def _distinct(df: DataFrame, name: str) -> DataFrame:
    return df.distinct().groupBy("collection").agg(F.count(F.lit(1)).alias(name))


class CollectionStore:
    """Named collections below one folder, each a set of batches (``batches.BatchTable``)."""

    DOCUMENTS = "id string, document string, metadata map<string,string>, embedding array<float>"

    def __init__(self, spark: SparkSession, root: str):
        root = root.rstrip("/")
        self.names = BatchTable(spark, f"{root}/names", "info map<string,string>")
        self.batches = BatchTable(spark, f"{root}/documents", self.DOCUMENTS)
        self.spark = spark

    def create(self, name: str, metadata: dict | None = None) -> None:
        """Get or create: an existing collection keeps its metadata."""
        if self.names.rows(name).isEmpty():
            info = self.spark.createDataFrame([(metadata or {},)], "info map<string,string>")
            self.names.write(name, info, batch="info")

    def delete(self, name: str) -> None:
        """Forget a collection and remove its files."""
        self.names.clear(name)
        self.batches.clear(name)

    def documents(self, name: str | None = None) -> DataFrame:
        """Live documents, of one collection or of all: of an id, the row of its last batch."""
        keys = ["id"] if name is not None else ["name", "id"]
        rows = self.batches.rows(name)
        rest = [c for c in rows.columns if c not in (*keys, "batch")]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("last")).select(*keys, "last.*")
        return last.withColumnRenamed("name", "collection") if name is None else last.withColumn("collection", F.lit(name))

    def add(self, name: str, batch: DataFrame, *, order_by: Sequence[str] = ("id",), batch_id: str | None = None) -> int:
        """Add documents whose id the collection does not hold; the new total.

        The same ``batch_id`` again replaces what it wrote before, so a repeated job adds nothing twice.
        """
        self.create(name)
        held = self.batches.rows(name)
        if batch_id:
            held = held.where(F.col("batch") != batch_id)
        fresh = first_of_each(batch, id="id", order_by=order_by).join(held.select("id").distinct(), "id", "left_anti")
        return self._write(name, fresh, batch_id)

    def update(self, name: str, batch: DataFrame, *, order_by: Sequence[str] = ("id",), batch_id: str | None = None) -> int:
        """Add documents or replace those of the same id; the new total."""
        self.create(name)
        return self._write(name, last_of_each(batch, id="id", order_by=order_by), batch_id)

    def add_to_each(self, batch: DataFrame, *, order_by: Sequence[str] = ("id",), batch_id: str | None = None) -> None:
        """Add documents to the collections that their column ``collection`` names, all in one job."""
        held = self.batches.rows().withColumnRenamed("name", "collection")
        if batch_id:
            held = held.where(F.col("batch") != batch_id)
        both = F.struct(F.col("collection"), F.col("id").cast("string").alias("id"))
        keyed = batch.where("collection is not null and id is not null").withColumn("__key", both)
        first = first_of_each(keyed, id="__key", order_by=order_by).drop("__key")
        fresh = durable(first.join(held.select("collection", "id").distinct(), ["collection", "id"], "left_anti"))
        known = self.names.rows().select(F.col("name").alias("collection"))
        new = fresh.select("collection").distinct().join(known, "collection", "left_anti")
        self.names.write(F.col("collection"), durable(new).withColumn("info", F.create_map().cast("map<string,string>")), "info")
        self.batches.write(F.col("collection"), self._whole(fresh, "collection"), batch_id)

    def _write(self, name: str, rows: DataFrame, batch_id: str | None) -> int:
        # Written apart first: a batch may be made from the collection it goes to.
        self.batches.write(name, durable(self._whole(rows)), batch_id)
        return self.documents(name).count()

    @staticmethod
    def _whole(rows: DataFrame, *also: str) -> DataFrame:
        blank = {
            "document": F.lit(""),
            "metadata": F.create_map().cast("map<string,string>"),
            "embedding": F.lit(None).cast("array<float>"),
        }
        return rows.select(
            F.col("id").cast("string").alias("id"),
            *[(F.col(c) if c in rows.columns else v).alias(c) for c, v in blank.items()],
            *also,
        )

    def query(
        self,
        name: str,
        queries: DataFrame,
        *,
        query_id: str,
        text: str | None = None,
        vec: str | None = None,
        k: int = 5,
        conditions: dict | None = None,
        **how,
    ) -> DataFrame:
        """The ``k`` nearest documents: by the words of ``text``, or by squared distance of ``vec``; with id and document.

        Result: ``query_id``, ``rank``, ``id``, ``score``, ``document``, ``metadata``.
        """
        if (text is None) == (vec is None):
            raise ValueError("a query is by text or by vector")
        held = self.documents(name)
        kept = durable(held.where(where(conditions)) if conditions else held)
        if vec is not None:
            found = query(
                kept.where("embedding is not null"), queries, id="id", vec="embedding", query_id=query_id, query_vec=vec, k=k,
                carry=["document", "metadata"], **how,
            )
            return found
        from marlstone.operators import lexical

        index = lexical.TextIndex.build(kept, key="id", text_col="document")
        hits = index.search(index.vectors(queries, key=query_id, text_col=text), k=k)
        details = kept.select("id", "document", "metadata")
        return hits.join(details, "id").select(F.col("query").alias("query_id"), "rank", "id", "score", "document", "metadata")

    def list(self) -> DataFrame:
        registry = self.names.rows().select(F.col("name").alias("collection"), F.col("info").alias("metadata"))
        return counts(registry, self.documents())

    def stats(self) -> DataFrame:
        return stats(self.documents())
