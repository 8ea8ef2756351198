"""Sparse text vectors and their search by an inverted index.

A text's vector has one component per distinct word: its count times the inverse document frequency, scaled to unit
length. Components are kept as whole numbers (*impacts*, ``SCALE`` for 1), so that scores are sums of integers and do
not depend on the order in which Spark adds them up. Every word counts, of any script and length, numbers too;
no weight is zero, so no text with a word has a zero vector.

Searching never multiplies all queries with all texts. A posting list per word has the texts with their impacts and the
largest impact as its bound. Texts that lead some list of a query are scored first; the k-th best of these
scores is a threshold that the answer must reach. Words whose bounds together stay below it cannot lift a text into
the answer alone, so only the lists of the others are read for candidates (MaxScore), and of those only the
ones that could still reach the threshold are looked up in the remaining lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions import arrow
from marlstone.plans.durable import durable
from marlstone.plans.joins import BROADCAST_ROWS, attach, fits_broadcast

SCALE = 1 << 20
LEADERS = 4
WORD = r"[\p{L}\p{M}\p{N}_]+"
NO_WORD = r"[^\p{L}\p{M}\p{N}_]+"


def words(text: Column) -> Column:
    """Lower-case runs of letters, marks, digits and underscores, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_counts(df: DataFrame, *, key: str, text_col: str) -> DataFrame:
    """``id``, ``term``, ``n`` for the distinct words of every text, counted inside its row."""
    apart = F.regexp_replace(F.lower(F.col(text_col)), NO_WORD, " ")
    rows = df.select(F.col(key).alias("id"), apart.alias("words"))
    schema = T.StructType([rows.schema["id"], T.StructField("term", T.StringType()), T.StructField("n", T.IntegerType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in arrow.pieces(batch.column("words")):
                row, code, terms = arrow.split_words(part)
                found, n = np.unique(row * max(len(terms), 1) + code, return_counts=True)
                row, code = np.divmod(found, max(len(terms), 1))
                columns = [batch.column("id").take(pa.array(row + at)), terms.take(pa.array(code)), pa.array(n, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(count, schema)


def rarity(texts: Column, with_term: Column) -> Column:
    """Inverse document frequency, smoothed so that it is at least 1."""
    return F.ln((1 + texts) / (1 + with_term)) + F.lit(1.0)


def _impacts(weighted: DataFrame) -> DataFrame:
    """``id``, ``term``, ``impact`` of unit vectors from ``id``, ``term``, ``w``."""
    weighted = durable(weighted)
    norms = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    whole = F.round(F.col("w") / F.col("norm") * F.lit(SCALE)).cast("long")
    return attach(weighted, norms, ["id"], how="inner").select("id", "term", whole.alias("impact"))


@dataclass
class TextIndex:
    """Postings (``id``, ``term``, ``impact``) and lists (``term``, ``df``, ``bound``) of ``texts`` texts."""

    postings: DataFrame
    lists: DataFrame
    texts: int

    @classmethod
    def build(cls, df: DataFrame, *, key: str, text_col: str) -> TextIndex:
        """The index of all rows; null and empty texts have no postings but count as texts.

        ``key`` is any type that can be compared, and names one row.
        """
        return cls.of_counts(durable(word_counts(df, key=key, text_col=text_col)), df.count())

    @classmethod
    def of_counts(cls, counted: DataFrame, texts: int) -> TextIndex:
        """The index of ``texts`` rows whose words are counted already as ``word_counts`` gives them."""
        frequency = durable(counted.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
        weighted = attach(counted, frequency, ["term"], how="inner")
        weighted = weighted.select("id", "term", (F.col("n") * rarity(F.lit(texts), F.col("df"))).alias("w"))
        postings = durable(_impacts(weighted))
        lists = durable(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("impact").alias("bound")))
        return cls(postings, lists, texts)

    def vectors(self, df: DataFrame, *, key: str, text_col: str) -> DataFrame:
        """Vectors of other texts in this index's weights; a word it does not hold is rarer than all it holds."""
        return self.weighted(word_counts(df, key=key, text_col=text_col))

    def weighted(self, counted: DataFrame) -> DataFrame:
        """Vectors of whatever has the counts ``id``, ``term``, ``n``."""
        known = attach(counted, self.lists.select("term", "df"), ["term"])
        weight = F.col("n") * rarity(F.lit(self.texts), F.coalesce("df", F.lit(0)))
        return durable(_impacts(known.select("id", "term", weight.alias("w"))))

    def search(self, queries: DataFrame, *, k: int) -> DataFrame:
        """``query``, ``rank``, ``id``, ``score`` (cosine) of the ``k`` best texts of each query (``id``, ``term``, ``impact``).

        Equal scores go to the smaller id. Texts that share no word with a query are no hits, so a query may have fewer.
        """
        asked = queries.select(F.col("id").alias("query"), "term", F.col("impact").alias("own"))
        asked = durable(attach(asked, self.lists, ["term"], how="inner").withColumn("most", F.col("own") * F.col("bound")))
        # Only the lists of words some query holds can add to a score: they are read once, not every list each time.
        postings = durable(self.postings.join(asked.select("term").distinct(), "term", "left_semi"))
        threshold = self._threshold(asked, k, postings)

        # Words in the order of what they can add at most; those before the threshold is reached are left for later.
        upto = Window.partitionBy("query").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)
        split = asked.join(threshold, "query", "left").withColumn("least", F.coalesce("least", F.lit(0)))
        split = split.withColumn("reach", F.sum("most").over(upto))
        split = durable(split.withColumn("needed", F.col("reach") >= F.col("least")))
        spare = F.coalesce(F.max(F.when(~F.col("needed"), F.col("reach"))), F.lit(0)).alias("spare")
        bounds = durable(split.groupBy("query").agg(F.first("least").alias("least"), spare))
        met = split.where("needed").select("query", "term", "own").join(postings, "term")
        partial = met.groupBy("query", "id").agg(F.sum(F.col("own") * F.col("impact")).alias("got"))
        open_ = partial.join(bounds, "query").where(F.col("got") + F.col("spare") >= F.col("least"))
        rest = split.where(~F.col("needed")).select("query", "term", "own", "df")
        scored = self._completed(durable(open_.select("query", "id", "got")), rest, postings)
        best = Window.partitionBy("query").orderBy(F.desc("total"), "id")
        ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return ranked.select("query", "rank", "id", (F.col("total") / F.lit(float(SCALE) ** 2)).alias("score"))

    def _completed(self, pairs: DataFrame, words_left: DataFrame, postings: DataFrame) -> DataFrame:
        """``pairs`` (``query``, ``id``, ``got``) with ``total``, what the words left (with the ``df`` of their lists) add from ``postings``."""
        wanted = pairs.select("query", "id")
        # Either each pair looks its words up, or the words' lists are read and only the pairs kept, whichever is fewer rows.
        asked = words_left.groupBy("query").agg(F.count(F.lit(1)).alias("words"), F.sum("df").alias("listed"))
        paired = wanted.groupBy("query").agg(F.count(F.lit(1)).alias("pairs"))
        looked, listed = asked.join(paired, "query").agg(F.sum(F.col("words") * F.col("pairs")), F.sum("listed")).first()
        words_left = words_left.select("query", "term", "own")
        if (listed or 0) < (looked or 0):
            small = durable(words_left.join(wanted.select("query").distinct(), "query", "left_semi"))
            met = postings.join(F.broadcast(small) if fits_broadcast(small) else small, "term")
            met = met.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, ["query", "id"], "left_semi")
        else:
            met = wanted.join(words_left, "query").join(postings, ["id", "term"])
        added = met.groupBy("query", "id").agg(F.sum(F.col("own") * F.col("impact")).alias("more"))
        both = pairs.join(added, ["query", "id"], "left")
        return both.withColumn("total", F.col("got") + F.coalesce("more", F.lit(0)))

    def _threshold(self, asked: DataFrame, k: int, postings: DataFrame) -> DataFrame:
        """``query`` and ``least``, the k-th best score among the texts that lead the query's lists in ``postings``."""
        lead = Window.partitionBy("term").orderBy(F.desc("impact"), "id")
        leaders = postings.withColumn("nth", F.row_number().over(lead)).where(F.col("nth") <= LEADERS * k)
        met = asked.select("query", "term", "own").join(leaders, "term")
        partial = met.groupBy("query", "id").agg(F.sum(F.col("own") * F.col("impact")).alias("part"))
        front = Window.partitionBy("query").orderBy(F.desc("part"), "id")
        some = partial.withColumn("nth", F.row_number().over(front)).where(F.col("nth") <= LEADERS * k)
        pairs = durable(some.select("query", "id", F.lit(0).cast("long").alias("got")))
        scored = self._completed(pairs, asked.select("query", "term", "own", "df"), postings)
        nth = Window.partitionBy("query").orderBy(F.desc("total"), "id")
        return durable(scored.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") == k).select("query", F.col("total").alias("least")))


def bucket(term: Column, dim: int) -> Column:
    """A component for a word: 32 bits of its md5, modulo ``dim``."""
    return (F.conv(F.substring(F.md5(term.cast("binary")), 1, 8), 16, 10).cast("long") % dim).cast("int")


def embed(df: DataFrame, *, key: str, text_col: str, dim: int) -> DataFrame:
    """``id`` and ``cells``, the unit vector of every text in ``dim`` buckets of words: ``(cell, impact)`` in ascending order.

    A text without words has no cells; every other has one at least.
    """
    counted = durable(word_counts(df, key=key, text_col=text_col))
    frequency = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighted = attach(counted, frequency, ["term"], how="inner")
    weight = F.col("n") * rarity(F.lit(df.count()), F.col("df"))
    summed = weighted.groupBy("id", bucket(F.col("term"), dim).alias("term")).agg(F.sum(weight).alias("w"))
    cells = F.sort_array(F.collect_list(F.struct(F.col("term").alias("cell"), "impact"))).alias("cells")
    known = _impacts(summed).groupBy("id").agg(cells)
    none = F.array().cast("array<struct<cell:int,impact:long>>")
    return df.select(F.col(key).alias("id")).join(known, "id", "left").withColumn("cells", F.coalesce("cells", none))


def dense(dim: int):
    """A function of a ``cells`` column: the vector as ``array<float>``."""

    @F.pandas_udf("array<float>")
    def spread(cells: pd.Series) -> pd.Series:
        rows = np.zeros((len(cells), dim), np.float32)
        for row, own in zip(rows, cells, strict=True):
            if len(own):
                row[[c["cell"] for c in own]] = [c["impact"] / SCALE for c in own]
        return pd.Series(list(rows))

    return spread
