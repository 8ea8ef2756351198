"""Near-equal lines across documents by a deletion-neighbourhood join.

Lines of at least ``least`` characters are compared without case and with single blanks. Two lines one edit apart
have a variant in common when each may lose one character, at the same place or only one of them; all variants are
emitted as hashes with that place, equal ones join the earliest line that has them, and the edit distance is verified. A line with such a partner shares one of its halves with it, so lines that share
none are set aside before any variants are made. A line goes when an equal or near-equal line occurs earlier, in
order of ``doc_id`` and place, whether or not that one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.arrays import let
from marlstone.llm.graphs import sized
from marlstone.llm.memo import turn_to
from marlstone.llm.textarrays import mix
from marlstone.plans.durable import durable

LEAST = 20
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_KEY = ["k1", "k2"]


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """One row per line to compare: document, place, compared form and its 128-bit key."""
    rows = docs.select("doc_id", row_key().alias("rk"), F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    plain = F.trim(F.regexp_replace(F.lower("raw"), r"[ \t\r\f\x0B]+", " ")).alias("plain")
    rows = rows.select("doc_id", "rk", "line", plain).where(F.char_length("plain") >= least)
    return rows.withColumns({"k1": F.xxhash64("plain"), "k2": F.xxhash64(F.lit(1), "plain")})


def _halves() -> Column:
    """Keys of which two lines one edit apart share at least one: a half and the length of the longer line."""
    n, keys = F.char_length("plain"), []
    for longer in (n, n + 1):
        cut = F.floor(longer / 2).cast("int")
        keys.append(F.xxhash64(F.lit("head"), longer, F.substr("plain", F.lit(1), cut)))
        keys.append(F.xxhash64(F.lit("tail"), longer, F.substr("plain", cut - longer, longer - cut)))
    return F.array(*keys)


def variant_hashes(line: str) -> np.ndarray:
    """Hashes of the line and of what is left without its first, second ... last character."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        powers = np.full(len(codes), _BASE, np.uint64)
        powers[:1] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes + np.uint64(1)) * powers, out=sums[1:])
        without = sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(_INVERSE)
        sizes = np.array([len(codes), *[len(codes) - 1] * len(codes)], np.uint64)
        return mix(np.concatenate([sums[-1:], without]) + mix(sizes)).view(np.int64)


def _near(docs: DataFrame, firsts: DataFrame, least: int) -> DataFrame:
    """For distinct lines with an earlier line one edit away: ``k1``, ``k2`` and that line's first place ``earlier``."""
    keyed = firsts.select(*_KEY, "first", F.explode("halves").alias("half"))
    shared = keyed.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    likely = durable(keyed.join(shared, "half").select(*_KEY, "first").distinct())
    # Their texts come from the documents where each occurs first.
    where = likely.select(F.col("first.rk").alias("__rk")).distinct()
    texts = docs.join(sized(durable(where)), row_key() == F.col("__rk"), "left_semi")
    lines = _lines(texts, least).select(*_KEY, "plain").distinct()
    known = durable(lines.join(sized(likely), _KEY))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to("lines")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [variant_hashes(t) for t in part.column("plain").to_pylist()]
                rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                columns = [part.column("k1").take(rows), part.column("k2").take(rows), pa.array(np.concatenate(found))]
                columns.append(pa.array(np.concatenate([np.arange(-1, len(f) - 1, dtype=np.int32) for f in found])))
                yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "variant", "lost"])

    emitted = durable(known.select(*_KEY, "plain").mapInArrow(spread, "k1 long, k2 long, variant long, lost int"))
    # Only variants that two lines have lead anywhere.
    met = emitted.groupBy("variant").agg((F.min("k1") != F.max("k1")).alias("shared")).where("shared").select("variant")
    ranked = known.select(*_KEY, "first")
    variants = durable(emitted.join(met, "variant").join(ranked, _KEY))
    line = F.struct("first", *_KEY)
    whole = variants.where("lost = -1").select("variant", line.alias("other"))
    shorter = variants.where("lost >= 0")
    # Another character at one place: the earliest line of each (variant, place) is a partner of all others.
    same_place = shorter.groupBy("variant", "lost").agg(F.min(line).alias("other"))
    one_less = shorter.groupBy("variant").agg(F.min(line).alias("other"))
    pairs = shorter.join(same_place, ["variant", "lost"]).select(*_KEY, "first", "other")
    # A character more or less: a line and those that become it.
    pairs = pairs.unionByName(shorter.join(whole, "variant").select(*_KEY, "first", "other"))
    pairs = pairs.unionByName(
        variants.where("lost = -1").join(one_less, "variant").select(*_KEY, "first", "other")
    )
    pairs = pairs.where(F.col("other.first") < F.col("first")).distinct()
    named = pairs.select(*_KEY, F.col("other.k1").alias("k1_b"), F.col("other.k2").alias("k2_b"), F.col("other.first").alias("earlier"))
    texts_b = known.select(F.col("k1").alias("k1_b"), F.col("k2").alias("k2_b"), F.col("plain").alias("plain_b"))
    both = named.join(known.select(*_KEY, "plain"), _KEY).join(texts_b, ["k1_b", "k2_b"])
    found = both.where(F.levenshtein("plain", "plain_b", 1) >= 0)
    return found.groupBy(*_KEY).agg(F.min("earlier").alias("earlier"))


def repeated_lines(docs: DataFrame, *, least: int = LEAST) -> DataFrame:
    """One row per line that goes: ``doc_id``, ``rk``, ``line`` and the earliest line it repeats (``keep_id``, ``keep_line``).

    Only ``doc_id`` and ``text`` are read. Null and empty texts have no lines; a null ``doc_id`` comes first; rows
    that repeat in both columns share their places, so neither repeats the other. Hot lines meet as one row per
    task; what is known of repeated lines is broadcast only after it was counted.
    """
    docs = docs.select("doc_id", "text")
    lines = durable(_lines(docs, least).withColumn("halves", _halves()).drop("plain"))
    place = F.struct("doc_id", "rk", "line")
    firsts = durable(lines.groupBy(*_KEY).agg(
        F.min(place).alias("first"), F.min("halves").alias("halves"), F.count(F.lit(1)).alias("n")
    ))
    near = durable(_near(docs, firsts, least))
    known = firsts.select(*_KEY, "first", "n").join(near, _KEY, "left").where("n > 1 or earlier is not null")
    known = sized(durable(known.select(*_KEY, "first", "earlier")))
    met = lines.select("doc_id", "rk", "line", *_KEY).join(known, _KEY)
    is_first = (F.col("first.rk") == F.col("rk")) & (F.col("first.line") == F.col("line"))
    source = F.coalesce("earlier", "first")
    return met.where(~is_first | F.col("earlier").isNotNull()).select(
        "doc_id", "rk", "line", source["doc_id"].alias("keep_id"), source["line"].alias("keep_line")
    )


def drop_repeated(docs: DataFrame, *, least: int = LEAST) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` and their number as ``lines_dropped``; rows stay as they are.

    A document of which nothing stays has an empty text. An input column named ``lines_dropped`` is replaced; other
    columns pass through whatever their names.
    """
    gone = repeated_lines(docs, least=least)
    key, own = (_free(docs, n) for n in ("__rk", "__gone"))
    # A document's list is at most as long as its lines.
    lists = durable(gone.groupBy(F.col("rk").alias(key)).agg(F.collect_set("line").alias(own)))
    plain = docs.drop("lines_dropped")
    joined = plain.join(sized(lists), row_key() == F.col(key), "left")

    def left(lines: Column) -> Column:
        # The places that stay, by a hash set: linear in the lines of a text.
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(own))
        return F.array_join(F.transform(stay, lambda at: F.get(lines, at)), "\n")

    text = F.when(F.col(own).isNull(), F.col("text")).otherwise(let(F.split("text", "\n"), left))
    dropped = F.coalesce(F.when(F.col(own).isNotNull(), F.size(own)), F.lit(0))
    return joined.withColumns({"text": text, "lines_dropped": dropped}).select(*plain.columns, "lines_dropped")


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name
