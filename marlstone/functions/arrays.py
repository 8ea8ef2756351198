"""Row-local array algebra. Everything here stays inside one row: no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def grams(tokens: Column, n: int) -> Column:
    """The n-grams of a token array, joined by a space."""
    if n == 1:
        return tokens
    windows = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - F.lit(n - 1)),
        lambda i: F.array_join(F.slice(tokens, i, n), " "),
    )
    return F.when(F.size(tokens) >= n, windows).otherwise(
        F.array().cast("array<string>")
    )


def overlap(left: Column, right: Column) -> Column:
    """Size of the multiset intersection: both arrays are sorted, then merged once."""

    def merge(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        zero = F.lit(0)

        def step(state: Column, _: Column) -> Column:
            x, y = F.get(a, state["i"]), F.get(b, state["j"])
            equal = F.coalesce(x == y, F.lit(False))
            left_first = F.coalesce(x < y, F.lit(False))
            right_first = F.coalesce(y < x, F.lit(False))
            one = F.lit(1)
            return F.struct(
                (state["i"] + F.when(equal | left_first, one).otherwise(zero)).alias("i"),
                (state["j"] + F.when(equal | right_first, one).otherwise(zero)).alias("j"),
                (state["hits"] + F.when(equal, one).otherwise(zero)).alias("hits"),
            )

        start = F.struct(zero.alias("i"), zero.alias("j"), zero.alias("hits"))
        steps = F.size(a) + F.size(b)
        return F.when(
            (F.size(a) == 0) | (F.size(b) == 0), F.lit(0)
        ).otherwise(F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda s: s["hits"]))

    pair = F.struct(F.array_sort(left).alias("a"), F.array_sort(right).alias("b"))
    return let(pair, merge)


def ranked_counts(tokens: Column) -> Column:
    """Distinct tokens as ``(order, first, token)`` structs, most frequent first.

    ``order`` is minus the count, so the natural struct order is count
    descending, then first occurrence. Sort, then cut the runs: linear after the sort.
    """

    def cut_runs(entries: Column) -> Column:
        total = F.size(entries)
        starts = F.filter(
            F.sequence(F.lit(0), total - 1),
            lambda i: (i == 0)
            | (F.get(entries, i)["token"] != F.get(entries, i - F.lit(1))["token"]),
        )

        def runs(bounds: Column) -> Column:
            return F.transform(
                bounds,
                lambda s, j: F.struct(
                    (s - F.coalesce(F.get(bounds, j + 1), total)).alias("order"),
                    F.get(entries, s)["at"].alias("first"),
                    F.get(entries, s)["token"].alias("token"),
                ),
            )

        return F.sort_array(let(starts, runs))

    # sort_array compares in compiled code; array_sort calls its comparator as a lambda, per comparison.
    tagged = F.sort_array(
        F.transform(tokens, lambda t, i: F.struct(t.alias("token"), i.alias("at")))
    )
    empty = F.array().cast("array<struct<order:int,first:int,token:string>>")
    return let(tagged, lambda e: F.when(F.size(e) == 0, empty).otherwise(cut_runs(e)))
