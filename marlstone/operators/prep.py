"""Splits, text blocks and prompt assembly."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.text import strip
from marlstone.plans.positions import hash_unit

UNIT = 1 << 32
BUCKET_HEX = 4


def split(
    df: DataFrame, *, key: str, train_ratio: float = 0.8, seed: int = 42, exact: bool = False
) -> DataFrame:
    """Mark each row ``train`` or ``test`` by a hash of its unique key.

    By default the share is met in expectation and no row moves. ``exact`` makes the
    test part ``ceil((1 - ratio) * n)`` rows: the boundary hash is found from a
    histogram of hash prefixes (65,536 counts) and the ranks inside one of its
    buckets, so the table itself is still only scanned.
    """
    if not 0 < train_ratio < 1:
        raise ValueError("train_ratio must lie between 0 and 1")
    if not exact:
        test = hash_unit(F.col(key), seed) >= F.lit(int(train_ratio * UNIT))
        return df.withColumn("split", F.when(test, "test").otherwise("train"))
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    place = F.struct(digest.alias("h"), F.col(key).alias("k"))
    bucket = F.substring(digest, 1, BUCKET_HEX)
    histogram = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    running = histogram.select(
        "bucket",
        F.sum("n").over(Window.orderBy("bucket")).alias("upto"),
        "n",
    )
    total = histogram.agg(F.sum("n")).first()[0] or 0
    wanted = math.ceil(round((1 - train_ratio) * total, 9))
    if wanted == 0:
        return df.withColumn("split", F.lit("train"))
    pivot = running.where(F.col("upto") >= wanted).orderBy("bucket").first()
    inside = wanted - (pivot["upto"] - pivot["n"])
    edge = (
        df.where(bucket == pivot["bucket"])
        .select(place.alias("place"))
        .orderBy("place")
        .offset(inside - 1)
        .limit(1)
        .first()["place"]
    )
    cut = F.struct(F.lit(edge["h"]).alias("h"), F.lit(edge["k"]).alias("k"))
    return df.withColumn("split", F.when(place <= cut, "test").otherwise("train"))


def text_blocks(df: DataFrame, *, key: str, text_col: str) -> DataFrame:
    """Non-empty trimmed lines of each text with their index in it."""
    lines = F.filter(F.transform(F.split(text_col, "\n"), strip), lambda s: s != "")
    return df.select(key, F.posexplode(lines).alias("block", "text"))


def assemble_prompts(df: DataFrame, *, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``role: text`` lines in turn order, closed by ``assistant:``; one row per conversation of any length."""
    line = F.concat(F.col(role), F.lit(": "), F.col(text))
    turns = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), line.alias("line"))))
    prompt = F.array_join(F.transform(turns, lambda r: r["line"]), "\n")
    return df.groupBy(conversation).agg(F.concat(prompt, F.lit("\nassistant:")).alias("prompt"))


def top_predictions(
    df: DataFrame,
    *,
    key: Sequence[str],
    label: str,
    score: str,
    k: int = 5,
    threshold: float | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """At most ``k`` labels per item, best score first, none under ``threshold``."""
    kept = df if threshold is None else df.where(F.col(score) >= threshold)
    best = Window.partitionBy(*key).orderBy(F.desc(score), F.asc(label))
    ranked = kept.withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select(*key, "rank", label, score, *carry)
