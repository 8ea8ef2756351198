"""Benchmark passages in documents, by a prefix-filtered join of word shingles.

Every window of ``window`` consecutive item words has to occur whole, so one of its shingles is a necessary
prefix; the rarest over all documents is taken. Documents meet these anchors word by word against bounded blocks
of the benchmark; length and position bound each candidate, and the words of the window confirm it. Built-in
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.plans.durable import durable

WINDOW = 13
SHINGLE = 3
BLOCK_ROWS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of lower-cased (A-Z) text: runs of 0-9, a-z and all characters beyond ASCII; null has none."""
    # Where no other letters occur, the quick way to lower case is the same.
    lower = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))
    return F.coalesce(F.array_remove(F.split(lower, _BETWEEN), ""), F.array().cast("array<string>"))


def _key(first: Column, next_word, width: int) -> Column:
    return F.xxhash64(first, *[next_word(k) for k in range(1, width)])


def _at_every_word(docs: DataFrame, width: int) -> DataFrame:
    """One row per word with the key of the shingle that begins there, and one with ``pos`` 0 for the document."""
    marked = F.concat(F.array(F.lit("")), F.col("__words"))
    spread = docs.select("*", F.posexplode(marked).alias("pos", "__word"))
    key = _key(F.col("__word"), lambda k: F.get("__words", F.col("pos") + (k - 1)), width)
    return spread.withColumn("key", F.when(F.col("pos") > 0, key))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (``window_id``, ``wanted``) and which items have each (``window_id``, ``item_id``)."""
    listed = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    cut = listed.select("item_id", "w", F.explode(starts).alias("at"))
    cut = cut.select("item_id", F.slice("w", F.col("at"), window).alias("wanted"))
    # Words hold no space, so the joined text names the window exactly.
    of_items = durable(cut.select(F.array_join("wanted", " ").alias("window_id"), "wanted", "item_id").distinct())
    return of_items.select("window_id", "wanted").distinct(), of_items.select("window_id", "item_id")


def _anchors(docs: DataFrame, windows: DataFrame, shingle: int, block_rows: int) -> DataFrame:
    """Of each window the rarest shingle: its ``width``, ``key`` and place ``off``. Windows with one that no document has are left out."""
    width = F.least(F.size("wanted"), F.lit(shingle)).alias("width")
    places = windows.select("window_id", "wanted", width)
    places = places.withColumn("off", F.explode(F.sequence(F.lit(0), F.size("wanted") - F.col("width"))))
    by_width = [
        places.where(F.col("width") == k).withColumn(
            "key", _key(F.get("wanted", F.col("off")), lambda j: F.get("wanted", F.col("off") + j), k)
        )
        for k in range(1, shingle + 1)
    ]
    keyed = by_width[0]
    for part in by_width[1:]:
        keyed = keyed.unionByName(part)
    keyed = durable(keyed)
    counts = None
    for k, block in _blocks(keyed.select("width", "key").distinct(), block_rows):
        met = _at_every_word(docs, k).select("key").join(F.broadcast(block.select("key")), "key")
        found = met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("width", F.lit(k))
        counts = found if counts is None else counts.unionByName(found)
    if counts is None:
        return keyed.withColumn("n", F.lit(0)).limit(0)
    ranked = keyed.join(durable(counts), ["width", "key"], "left").fillna(0, ["n"])
    best = F.min_by(F.struct("width", "key", "off", "wanted"), F.struct("n", "off")).alias("a")
    rarest = ranked.groupBy("window_id").agg(best, F.min("n").alias("n")).where("n > 0")
    return rarest.select("window_id", "a.*")


def _blocks(table: DataFrame, block_rows: int):
    """(width, rows) blocks of at most about ``block_rows`` rows, by key."""
    table = durable(table)
    for width, rows in sorted(table.groupBy("width").count().collect()):  # a row per width
        blocks = -(-rows // block_rows)
        for b in range(blocks):
            part = table.where((F.col("width") == width) & (F.pmod(F.xxhash64("key"), F.lit(blocks)) == b))
            yield width, part


def find(
    docs: DataFrame, items: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash`` (xxhash64), ``n_words``, ``n_hit`` and ``item_ids`` (ascending as text).

    A word is hit if an occurrence of a window covers it. Null and empty texts have no words and no hits; repeated
    rows are returned as often as they occur; items without words match nothing; other columns of either table are
    not read. A block of anchors is broadcast, larger benchmarks take more blocks.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("__h"), words(F.col("text")).alias("__words"))
    windows, of_items = benchmark_windows(items, window)
    anchors = _anchors(texts, windows, shingle, block_rows)
    none = anchors.sparkSession.createDataFrame([], anchors.schema)
    passes = [*_blocks(anchors, block_rows)] or [(1, none)]
    rows = None
    for number, (width, block) in enumerate(passes):
        met = _at_every_word(texts, width).join(F.broadcast(block.drop("width")), "key", "left")
        begin, many = F.col("pos") - 1 - F.col("off"), F.size("wanted")
        inside = (begin >= 0) & (begin + many <= F.size("__words"))
        whole = F.when(inside, F.slice("__words", F.greatest(begin, F.lit(0)) + 1, many) == F.col("wanted"))
        is_hit = F.col("window_id").isNotNull() & F.coalesce(whole, F.lit(False))
        found = met.where(is_hit | (F.col("pos") == 0) if number == 0 else is_hit).select(
            "doc_id", "__h", F.when(F.col("pos") == 0, F.size("__words").cast("long")).alias("n_words"),
            F.when(F.col("pos") > 0, begin).alias("begin"), (begin + many).alias("end"), "window_id",
        )
        rows = found if rows is None else rows.unionByName(found)
    rows = durable(rows)
    per_doc = ["doc_id", "__h"]
    sizes = rows.where("n_words is not null").groupBy(*per_doc).agg(
        F.count(F.lit(1)).alias("copies"), F.max("n_words").alias("n_words")
    )
    hits = rows.where("n_words is null").select(*per_doc, "begin", "end", "window_id").distinct()
    so_far = Window.partitionBy(*per_doc).orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest("begin", F.coalesce(F.max("end").over(so_far), F.lit(0)))
    covered = hits.select(*per_doc, F.greatest(F.col("end") - reached, F.lit(0)).alias("new"))
    lengths = covered.groupBy(*per_doc).agg(F.sum("new").alias("n_hit"))
    # A document has at most as many items as the benchmark.
    named = hits.select(*per_doc, "window_id").distinct().join(of_items, "window_id")
    lists = named.groupBy(*per_doc).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    out = _beside(_beside(sizes, lengths), lists)
    return out.select(
        "doc_id", F.col("__h").alias("text_hash"), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy"),
    ).drop("__copy")


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.withColumnsRenamed({"doc_id": "__id2", "__h": "__h2"})
    same = F.col("doc_id").eqNullSafe(F.col("__id2")) & (F.col("__h") == F.col("__h2"))
    return left.join(other, same, "left").drop("__id2", "__h2")


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word and a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
