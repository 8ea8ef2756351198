"""Evaluation of predictions against references, one row per pair."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from marlstone.functions import arrays
from marlstone.functions import text as T

ORDERS = (1, 2, 3, 4)


def align(predictions: DataFrame, references: DataFrame, *, key: str) -> DataFrame:
    """One row per pair; a key on one side only is a length mismatch and raises."""
    joined = predictions.withColumn("__p", F.lit(True)).join(
        references.withColumn("__r", F.lit(True)), key, "full_outer"
    )
    odd = joined.where(F.col("__p").isNull() | F.col("__r").isNull()).take(1)
    if odd:
        raise ValueError(f"length mismatch: key {odd[0][key]!r} stands on one side only")
    return joined.drop("__p", "__r")


def accuracy(pairs: DataFrame, *, prediction: str, reference: str) -> DataFrame:
    """Exact match after stripping white space; 0 for an empty table."""
    same = T.strip(F.col(prediction)) == T.strip(F.col(reference))
    counted = pairs.agg(F.count_if(same).alias("correct"), F.count(F.lit(1)).alias("total"))
    share = F.coalesce(F.try_divide("correct", "total"), F.lit(0.0))
    return counted.select(share.alias("accuracy"), "correct", "total")


def bleu_counts(pairs: DataFrame, *, prediction: str, reference: str) -> DataFrame:
    """Per pair: token counts and, for n = 1..4, clipped matches and n-gram totals.

    Row-local; both token arrays are bound once.
    """
    tokens = F.struct(
        T.bleu_tokens(F.col(prediction)).alias("p"), T.bleu_tokens(F.col(reference)).alias("r")
    )

    def count(pair: Column) -> Column:
        fields = [F.size(pair["p"]).alias("pred_len"), F.size(pair["r"]).alias("ref_len")]
        for n in ORDERS:
            matched = arrays.overlap(arrays.grams(pair["p"], n), arrays.grams(pair["r"], n))
            fields.append(matched.alias(f"match_{n}"))
            fields.append(
                F.greatest(F.size(pair["p"]) - F.lit(n - 1), F.lit(0)).alias(f"total_{n}")
            )
        return F.struct(*fields)

    return pairs.withColumn("__b", arrays.let(tokens, count)).select("*", "__b.*").drop("__b")


def bleu(pairs: DataFrame, *, prediction: str, reference: str) -> DataFrame:
    """Corpus BLEU (0-100), the four precisions and the brevity penalty: one row.

    Orders without a match are smoothed by halving; no match at all scores 0.
    """
    counts = bleu_counts(pairs, prediction=prediction, reference=reference)
    names = ["pred_len", "ref_len", *[f"{k}_{n}" for n in ORDERS for k in ("match", "total")]]
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    halvings, precisions = F.lit(0), []
    for n in ORDERS:
        match, total = F.col(f"match_{n}"), F.col(f"total_{n}")
        halvings = halvings + F.when((match == 0) & (total > 0), 1).otherwise(0)
        smoothed = F.lit(100.0) / (F.pow(F.lit(2.0), halvings) * total)
        precisions.append(
            F.when(total == 0, F.lit(0.0))
            .when(match == 0, smoothed)
            .otherwise(F.lit(100.0) * match / total)
        )
    any_match = sum((F.col(f"match_{n}") for n in ORDERS[1:]), F.col("match_1")) > 0
    brevity = (
        F.when(F.col("pred_len") == 0, F.lit(0.0))
        .when(F.col("pred_len") >= F.col("ref_len"), F.lit(1.0))
        .otherwise(F.exp(1 - F.col("ref_len") / F.col("pred_len")))
    )
    out = sums.select(
        *[F.when(any_match, p).otherwise(0.0).alias(f"p{n}") for n, p in zip(ORDERS, precisions)],
        brevity.alias("bp"),
        "pred_len",
        "ref_len",
    )
    least = F.least(*[f"p{n}" for n in ORDERS])
    logs = sum((F.ln(f"p{n}") for n in ORDERS[1:]), F.ln("p1")) / F.lit(4.0)
    score = F.when(least > 0, F.col("bp") * F.exp(logs)).otherwise(F.lit(0.0))
    return out.select(score.alias("bleu"), *[f"p{n}" for n in ORDERS], "bp", "pred_len", "ref_len")


def _longest_common(left: list[str], right: list[str]) -> int:
    """Length of the longest common subsequence, a row of the table per machine word."""
    places: dict[str, int] = {}
    for i, token in enumerate(left):
        places[token] = places.get(token, 0) | (1 << i)
    full = (1 << len(left)) - 1
    row = full
    for token in right:
        hit = row & places.get(token, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(left) - row.bit_count()


@F.pandas_udf(S.IntegerType())
def longest_common(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([_longest_common(list(a), list(b)) for a, b in zip(left, right)], dtype="int32")


def _f_measure(match: Column, predicted: Column, wanted: Column) -> Column:
    """2PR/(P+R), written so that nothing divides by zero."""
    return F.coalesce(F.try_divide(F.lit(2.0) * match, predicted + wanted), F.lit(0.0))


def rouge(
    pairs: DataFrame,
    *,
    prediction: str,
    reference: str,
    stem: bool = True,
    kinds: Sequence[str] = ("rouge1", "rouge2", "rougeL"),
) -> DataFrame:
    """Mean F-measure over pairs, one column per kind; 0 for an empty table."""
    from marlstone.functions.stem import stem_tokens

    tokens = pairs.select(
        T.rouge_tokens(F.col(prediction)).alias("p"), T.rouge_tokens(F.col(reference)).alias("r")
    )
    if stem:
        tokens = tokens.select(stem_tokens("p").alias("p"), stem_tokens("r").alias("r"))
    scores = []
    for kind in kinds:
        if kind == "rougeL":
            match, n = longest_common("p", "r"), 1
        else:
            n = int(kind.removeprefix("rouge"))
            match = arrays.overlap(arrays.grams(F.col("p"), n), arrays.grams(F.col("r"), n))
        sizes = [F.greatest(F.size(c) - F.lit(n - 1), F.lit(0)) for c in ("p", "r")]
        scores.append(_f_measure(match, *sizes).alias(kind))
    return tokens.select(*scores).agg(
        *[F.coalesce(F.avg(k), F.lit(0.0)).alias(k) for k in kinds]
    )


def confusion(pairs: DataFrame, *, truth: str, prediction: str) -> DataFrame:
    return pairs.groupBy(F.col(truth).alias("t"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(pairs: DataFrame, *, truth: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per label seen on either side."""
    cells = confusion(pairs, truth=truth, prediction=prediction)
    # Each cell counts for its true and for its predicted label.
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("t").alias("label"), F.lit(True).alias("is_true")),
                F.struct(F.col("p").alias("label"), F.lit(False).alias("is_true")),
            )
        ),
        (F.col("t") == F.col("p")).alias("hit"),
        "n",
    )

    def total(test: Column) -> Column:
        return F.sum(F.when(test, F.col("n")).otherwise(0))

    counts = sides.groupBy("label").agg(
        total(F.col("is_true") & F.col("hit")).alias("tp"),
        total(F.col("is_true")).alias("support"),
        total(~F.col("is_true")).alias("predicted"),
    )

    def ratio(of: Column) -> Column:
        return F.coalesce(F.try_divide(F.col("tp").cast("double"), of), F.lit(0.0))

    rated = counts.select(
        "label",
        ratio(F.col("predicted")).alias("precision"),
        ratio(F.col("support")).alias("recall"),
        "support",
        "tp",
        "predicted",
    )
    p, r = F.col("precision"), F.col("recall")
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return rated.select("label", "precision", "recall", f1.alias("f1"), "support", "tp", "predicted")


def report_averages(pairs: DataFrame, *, truth: str, prediction: str) -> DataFrame:
    """Accuracy, macro and weighted averages of the per-class report, one row each."""
    rows = class_report(pairs, truth=truth, prediction=prediction)
    names = ("precision", "recall", "f1")
    total = F.sum("support")
    share = F.coalesce(F.try_divide(F.sum("tp").cast("double"), total), F.lit(0.0))

    def weighted(c: str) -> Column:
        return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), total), F.lit(0.0))

    averages = {
        "accuracy": [share, share, share],
        "macro avg": [F.coalesce(F.avg(c), F.lit(0.0)) for c in names],
        "weighted avg": [weighted(c) for c in names],
    }
    one = rows.agg(
        F.array(
            *[
                F.struct(
                    F.lit(label).alias("average"),
                    *[v.alias(c) for c, v in zip(names, values)],
                    F.coalesce(total, F.lit(0)).alias("support"),
                )
                for label, values in averages.items()
            ]
        ).alias("rows")
    )
    return one.select(F.inline("rows"))


def f1_scores(pairs: DataFrame, *, truth: str, prediction: str) -> DataFrame:
    """Macro, micro and weighted F1; micro F1 is the accuracy."""
    averages = report_averages(pairs, truth=truth, prediction=prediction)

    def pick(name: str, column: str) -> Column:
        return F.max(F.when(F.col("average") == name, F.col(column))).alias(column)

    return averages.agg(
        pick("macro avg", "f1").alias("macro_f1"),
        pick("accuracy", "f1").alias("micro_f1"),
        pick("weighted avg", "f1").alias("weighted_f1"),
    )


def regression(pairs: DataFrame, *, truth: str, prediction: str) -> DataFrame:
    """RMSE and R² from plain sums."""
    error = F.pow(F.col(truth) - F.col(prediction), F.lit(2.0))
    sums = pairs.agg(
        F.avg(error).alias("mse"), F.var_pop(truth).alias("variance"), F.count(F.lit(1)).alias("n")
    )
    r2 = 1 - F.try_divide(F.col("mse"), F.col("variance"))
    return sums.select(F.sqrt("mse").alias("rmse"), r2.alias("r2"), "n")
