"""Perplexity under an interpolated modified Kneser-Ney model of character n-grams, trained on trusted text.

Counts are gathered per language over all trusted text: tasks count, Spark adds up. Each lower order counts the
different characters before its n-grams; discounts follow from how many n-grams were met once to four times. The
joins of counts with their contexts and with the next lower order give, for each n-gram, its whole probability and,
for each context, the weight of the lower order. The finished model is read in shards of bounded size; an n-gram,
its shorter forms and its contexts share a shard, so each shard scores its part of every document and the
parts add up.

An n-gram is two numbers of 21 bits a character, so every character counts as itself: ``g`` has the last three, ``f``
those before them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.graphs import sized
from marlstone.llm.textarrays import bounded, mix
from marlstone.plans.durable import durable

ORDER = 5
SHARD_ROWS = 1_500_000
_BITS = 21
_NEAR = 3
_PACKED = 12


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all characters, each text after ``ORDER`` - 1 zeros, and the number of characters of each text."""
    pad = "\0" * (ORDER - 1)
    raw = np.frombuffer((pad + pad.join(t or "" for t in texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    return raw.astype(np.int64), np.array([len(t or "") for t in texts], np.int64)


def _ends(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of the runs of ``ORDER`` characters end at a character of a text, not at one before it."""
    ends = np.cumsum(sizes) + (ORDER - 1) * np.arange(len(sizes))
    real = np.zeros(len(points) + 1, bool)
    real[: ends[-1] if len(ends) else 0] = True
    for at in ends[:-1].tolist():
        real[at : at + ORDER - 1] = False
    return real[: len(points) - ORDER + 1]


def _runs(points: np.ndarray, first: int, many: int, bits: int) -> np.ndarray:
    """For each run of ``ORDER`` characters ``many`` of them from ``first`` on as one number."""
    n = len(points) - ORDER + 1
    out = np.zeros(n, np.int64)
    for k in range(first, first + many):
        out = (out << bits) | points[k : k + n]
    return out


def grams(points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``f`` and ``g`` of the n-gram of order ``ORDER`` that ends at each character, text by text."""
    real = _ends(points, sizes)
    return _runs(points, 0, ORDER - _NEAR, _BITS)[real], _runs(points, ORDER - _NEAR, _NEAR, _BITS)[real]


def _counted(points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``f``, ``g`` and the count of each different n-gram of order ``ORDER``."""
    met, places = np.unique(points, return_inverse=True)
    if len(met) > 1 << _PACKED:
        f, g = grams(points, sizes)
        order = np.lexsort((g, f))
        f, g = f[order], g[order]
        first = np.flatnonzero(np.concatenate([[True], (f[1:] != f[:-1]) | (g[1:] != g[:-1])])[: len(g)])
        return f[first], g[first], np.diff(np.append(first, len(g)))
    # Few enough different characters in a block to put all five into one number while counting.
    found, many = np.unique(_runs(places.astype(np.int64), 0, ORDER, _PACKED)[_ends(points, sizes)], return_counts=True)
    each = [met[(found >> _PACKED * k) & ((1 << _PACKED) - 1)] for k in range(ORDER)]
    f, g = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    for k in range(ORDER - 1, -1, -1):
        if k >= _NEAR:
            f = (f << _BITS) | each[k]
        else:
            g = (g << _BITS) | each[k]
    return f, g, many


def _count(texts: DataFrame) -> DataFrame:
    """``lang``, ``f``, ``g`` and ``c``: how often each n-gram of the highest order occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in bounded(batch.column("text")):
                langs = np.array(batch.column("lang").slice(at, len(part)).to_pylist(), object)
                values = np.array(part.to_pylist(), object)
                for lang in dict.fromkeys(langs.tolist()):
                    f, g, many = _counted(*codes(values[langs == lang].tolist()))
                    columns = [pa.array([lang] * len(g), pa.string()), pa.array(f), pa.array(g), pa.array(many)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "f", "g", "c"])

    counted = texts.mapInArrow(count, "lang string, f long, g long, c long")
    return counted.groupBy("lang", "f", "g").agg(F.sum("c").alias("c"))


def _masks(order: int) -> tuple[int, int]:
    """What keeps the last ``order`` characters, of ``f`` and of ``g``."""
    return (1 << _BITS * max(0, order - _NEAR)) - 1, (1 << _BITS * min(order, _NEAR)) - 1


def _last(order: int) -> list[Column]:
    return [F.col(c).bitwiseAND(F.lit(m).cast("long")) for c, m in zip("fg", _masks(order), strict=True)]


def _context() -> list[Column]:
    """``f`` and ``g`` without the last character."""
    carried = F.shiftleft(F.col("f").bitwiseAND(F.lit((1 << _BITS) - 1)), _BITS * (_NEAR - 1))
    return [F.shiftright("f", _BITS), F.shiftright("g", _BITS).bitwiseOR(carried)]


def train(texts: DataFrame) -> DataFrame:
    """The model over ``lang`` and ``text``: ``lang``, ``n`` (order), ``f``, ``g``, ``logp``, ``logb`` (weight of lower orders after g).

    Order 0 has one row per language, the probability of a character never met. Languages without text have no rows.
    """
    tables = {ORDER: durable(_count(texts))}
    for n in range(ORDER - 1, 0, -1):
        f, g = _last(n)
        shorter = tables[n + 1].select("lang", f.alias("f"), g.alias("g"))
        tables[n] = durable(shorter.groupBy("lang", "f", "g").agg(F.count(F.lit(1)).alias("c")))
    size = tables[1].groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("v"))  # rows: languages
    none = [F.lit(0).cast("long").alias(c) for c in "fg"]
    lower = size.select("lang", *none, (1 / F.col("v")).alias("p"))
    probabilities, weights = [], []
    for n in range(1, ORDER + 1):
        times = [F.count_if(F.col("c") == k).cast("double") for k in (1, 2, 3, 4)]
        share = times[0] / F.greatest(times[0] + 2 * times[1], F.lit(1.0))

        def discount(k: int, times=times, share=share) -> Column:
            held = k - (k + 1) * share * times[k] / F.greatest(times[k - 1], F.lit(1.0))
            return F.least(F.greatest(held, F.lit(0.1)), F.lit(k - 0.05)).alias(f"d{k}")

        cuts = tables[n].groupBy("lang").agg(*[discount(k) for k in (1, 2, 3)])  # rows: languages
        less = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        (f, g), (hf, hg) = _last(n - 1), _context()
        held = tables[n].join(F.broadcast(cuts), "lang").select(
            "lang", "f", "g", (F.col("c") - less).alias("kept"), "c", less.alias("less"),
            hf.alias("hf"), hg.alias("h"), f.alias("shortf"), g.alias("short"),
        )
        contexts = durable(held.groupBy("lang", "hf", "h").agg((F.sum("less") / F.sum("c")).alias("weight"), F.sum("c").alias("total")))
        below = lower.select("lang", F.col("f").alias("shortf"), F.col("g").alias("short"), F.col("p").alias("low"))
        found = held.join(contexts, ["lang", "hf", "h"]).join(below, ["lang", "shortf", "short"])
        lower = durable(found.select("lang", "f", "g", (F.col("kept") / F.col("total") + F.col("weight") * F.col("low")).alias("p")))
        probabilities.append(lower.select("lang", F.lit(n).alias("n"), "f", "g", F.log("p").alias("logp")))
        weights.append(contexts.select("lang", F.lit(n - 1).alias("n"), F.col("hf").alias("f"), F.col("h").alias("g"), F.log("weight").alias("logb")))
    unseen = size.select("lang", F.lit(0).alias("n"), *none, F.log(1 / F.col("v")).alias("logp"))
    rows = unseen.withColumn("logb", F.lit(None).cast("double"))
    for table in probabilities:
        rows = rows.unionByName(table.withColumn("logb", F.lit(None).cast("double")))
    for table in weights:
        rows = rows.unionByName(table.withColumn("logp", F.lit(None).cast("double")))
    return durable(rows.groupBy("lang", "n", "f", "g").agg(F.max("logp").alias("logp"), F.max("logb").alias("logb")))


def _salts(langs: np.ndarray) -> np.ndarray:
    return mix(langs.astype(np.uint64) + np.uint64(1))


def _keys(salt: np.ndarray, n: np.ndarray | int, f: np.ndarray, g: np.ndarray) -> np.ndarray:
    level = (np.asarray(n).astype(np.uint64) + np.uint64(1)) << np.uint64(60)
    return mix(mix((f.astype(np.uint64) ^ level) + salt) + g.astype(np.uint64))


class Table:
    """Values of n-grams by open addressing; lookups go in step for whole arrays."""

    def __init__(self, keys: np.ndarray, logp: np.ndarray, logb: np.ndarray):
        size = 1 << max(4, int(2 * len(keys) - 1).bit_length())
        self.last = np.uint64(size - 1)
        self.row = np.full(size, -1, np.int32)
        self.keys, self.logp, self.logb = keys, logp.astype(np.float32), logb.astype(np.float32)
        todo, place = np.arange(len(keys)), keys & self.last
        while len(todo):
            free = self.row[place] < 0
            self.row[place[free]] = todo[free]
            lost = self.row[place] != todo
            todo, place = todo[lost], (place[lost] + np.uint64(1)) & self.last

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 for none."""
        out = np.full(len(keys), -1, np.int64)
        todo, place = np.arange(len(keys)), keys & self.last
        while len(todo):
            row = self.row[place]
            met = row >= 0
            same = met & (self.keys[row] == keys[todo])
            out[todo[same]] = row[same]
            on = met & ~same
            todo, place = todo[on], (place[on] + np.uint64(1)) & self.last
        return out


def _log_probabilities(table: Table, salt: np.ndarray, f: np.ndarray, g: np.ndarray) -> np.ndarray:
    """log p of the last character of each n-gram: its longest form that is known, weighted for the longer ones."""
    out = np.zeros(len(g))
    todo = np.arange(len(g))
    for n in range(ORDER, -1, -1):
        far, near = _masks(n)
        far, near = f[todo] & far, g[todo] & near
        row = table.find(_keys(salt[todo], n, far, near))
        met = row >= 0
        met[met] = ~np.isnan(table.logp[row[met]])
        out[todo[met]] += table.logp[row[met]]
        todo, far, near = todo[~met], far[~met], near[~met]
        if not len(todo) or n == 0:
            break
        carried = (far & ((1 << _BITS) - 1)) << _BITS * (_NEAR - 1)
        context = table.find(_keys(salt[todo], n - 1, far >> _BITS, (near >> _BITS) | carried))
        known = np.where(context >= 0, table.logb[context], 0)
        out[todo] += np.where(np.isnan(known), 0, known)
    return out


def _shard_of(g, shards: int):
    """Shard of an n-gram of the highest order, by the two characters before its last."""
    pair = (g >> _BITS) & _masks(2)[1]
    return (mix(pair.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _shards(model: DataFrame, shard_rows: int) -> Iterator[tuple[int, int, dict]]:
    """(shard, shards, arrays): rows of order three and more belong to one shard, shorter ones to all."""
    rows = model.where("n > 2").count()
    shards = max(1, -(-rows // shard_rows))
    # A context of n characters is looked up by its last two, an n-gram by the two before its last.

    @F.pandas_udf("array<long>")
    def belongs(n, g):
        number, value = n.to_numpy(), g.to_numpy()
        as_gram = (mix(((value >> _BITS) & _masks(2)[1]).astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
        as_context = (mix((value & _masks(2)[1]).astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
        return pd.Series([list(range(shards)) if k <= 2 else sorted({a, b}) for k, a, b in zip(number, as_gram, as_context, strict=True)])

    spread = model if shards == 1 else durable(model.withColumn("shard", F.explode(belongs("n", "g"))))
    for shard in range(shards):
        part = spread if shards == 1 else spread.where(F.col("shard") == shard)
        yield shard, shards, part.select("lang", "n", "f", "g", "logp", "logb")


def perplexities(docs: DataFrame, model: DataFrame, *, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``doc_id``, ``lang``, ``th`` (hash of the text), ``n_chars`` and ``perplexity`` of every row of ``docs``.

    Null and empty texts, and those of a language without a model, have none; a null language is one of its own.
    At most about ``shard_rows`` n-grams reach the driver and the tasks at a time.
    """
    spark = docs.sparkSession
    source = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.xxhash64("text").alias("th"), "text")
    langs = sorted(r[0] for r in model.select("lang").distinct().collect())  # rows: languages
    numbers = {lang: k for k, lang in enumerate(langs)}
    id_field = docs.schema["doc_id"]
    parts = None
    for shard, shards, rows in _shards(model, shard_rows) if langs else ():
        number = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1
        values = [F.col(c).cast("float").alias(c) for c in ("logp", "logb")]
        found = rows.select(number.cast("int").alias("lang"), "n", "f", "g", *values).toArrow()
        n, f, g, logp, logb = (found.column(c).to_numpy() for c in ("n", "f", "g", "logp", "logb"))
        keys = _keys(_salts(found.column("lang").to_numpy()), n, f, g)
        arrays = spark.sparkContext.broadcast((keys, logp, logb))
        del found, n, f, g, logp, logb, keys

        def score(batches, shard=shard, shards=shards, arrays=arrays) -> Iterator[pa.RecordBatch]:
            table = Table(*arrays.value)
            for batch in batches:
                for at, part in bounded(batch.column("text"), 1 << 20):
                    points, sizes = codes(part.to_pylist())
                    own = [numbers.get(x, -1) for x in batch.column("lang").slice(at, len(part)).to_pylist()]
                    f, g = grams(points, sizes)
                    spread = np.repeat(np.array(own, np.int64), sizes)
                    counted = spread >= 0
                    if shards > 1:
                        counted &= _shard_of(g, shards) == shard
                    logs = np.zeros(len(g))
                    logs[counted] = _log_probabilities(table, _salts(spread[counted]), f[counted], g[counted])
                    ends = np.cumsum(sizes)
                    sums = np.diff(np.concatenate([[0.0], np.cumsum(logs)])[np.concatenate([[0], ends])])
                    known = np.where(np.array(own) >= 0, sizes, 0)
                    columns = [batch.column(c).slice(at, len(part)) for c in ("doc_id", "lang", "th")]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(sizes), pa.array(known), pa.array(sums)], ["doc_id", "lang", "th", "n_chars", "scored", "logs"]
                    )

        kind = id_field.dataType.simpleString()
        part = source.mapInArrow(score, f"doc_id {kind}, lang string, th long, n_chars long, scored long, logs double")
        if shards > 1:
            part = durable(part.withColumn("shard", F.lit(shard)))
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        nothing = [F.lit(0).cast(t).alias(c) for c, t in (("scored", "long"), ("logs", "double"))]
        parts = source.select("doc_id", "lang", "th", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"), *nothing)
    perplexity = F.when(F.col("scored") > 0, F.exp(-F.col("logs") / F.col("scored"))).alias("perplexity")
    if "shard" in parts.columns:
        # Repeated rows add up as often in every shard, so their mean is that of one.
        parts = parts.groupBy("doc_id", "lang", "th", "n_chars", "scored").agg(
            (F.sum("logs") / F.count_if(F.col("shard") == 0)).alias("logs"), F.count_if(F.col("shard") == 0).alias("copies")
        )
        parts = parts.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "__copy")
    return parts.select("doc_id", "lang", "th", "n_chars", perplexity)


def classify(docs: DataFrame, trusted: DataFrame, *, quantile: float = 0.995, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``doc_id``, ``lang``, ``n_chars``, ``perplexity``, ``threshold`` and ``kept`` of every document.

    ``trusted`` names documents by ``doc_id``. Four fifths of them train the model, the rest set each language's
    threshold: the ``quantile`` of their perplexities. Documents without a perplexity, and languages without a
    threshold, are kept. ``docs`` has ``doc_id``, ``lang`` and ``text``; other columns are not read.
    """
    names = sized(durable(trusted.select("doc_id").where("doc_id is not null").distinct()))
    fifth = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    learned = docs.where(~fifth).join(names, "doc_id", "left_semi")
    model = train(learned.select(F.coalesce("lang", F.lit("")).alias("lang"), "text"))
    scored = durable(perplexities(docs, model, shard_rows=shard_rows))
    known = scored.where(fifth).join(names, "doc_id", "left_semi").where("perplexity is not null")
    limits = known.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))  # rows: languages
    judged = scored.join(F.broadcast(limits), "lang", "left")
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept")
    return judged.select("doc_id", "lang", "n_chars", "perplexity", "threshold", kept)
