"""How filters interact: what each removes at each step of every order, and its Shapley share.

A filter that runs after others removes what fails it and none of them, so a step depends only on the set of
filters before it, not on their order. These sets form a lattice: its states are the sets, an edge adds one
filter. Every document is first reduced to the set of conditions it fails, counted per part; a state's value is
the number of documents that fail none of its filters, an edge removes the difference of its two states. Counting
paths forward (orders that reach a state) and backward (orders that leave it) weights each edge by the orders that
pass it: the weighted sum of a filter's edges is its removal summed over all orders. The steps of an order are read
off the same edges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.plans.durable import durable

MOST_FILTERS = 8


def words(text: Column) -> Column:
    """Maximal runs of characters outside ``[\\x20\\x09-\\x0D]``."""
    return F.filter(F.split(text, "[ \t-\r]+"), lambda w: w != "")


def text_conditions(text: Column, found: Column) -> dict[str, Column]:
    """Failure conditions that a text shows by itself; ``found`` are its words."""
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": F.size(found) < 200,
        "B": 100 * F.size(F.array_distinct(found)) < 50 * F.size(found),
        "C": 100 * capitals.cast("long") > 2 * F.char_length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, *, copies: str = "E") -> DataFrame:
    """One row per document: ``doc_id``, ``part`` (its source, null as ``''``) and ``failed``, the set of failed
    conditions as bits in the order of their names.

    ``copies`` names the condition that the text is that of a smaller ``doc_id`` anywhere in the table. Texts are
    equal by SHA-256; null texts count as empty, and a null ``doc_id`` is neither smaller nor larger than another,
    so such rows never fail it. Repeated rows (same ``doc_id``, same text) do not fail by one another. Texts are
    read whole whatever their length; other columns are not read. The texts themselves are never shuffled, and the
    first document of a text is joined by text and ``doc_id``, so that many copies do not meet in one task.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    conditions = text_conditions(F.col("text"), F.col("words"))
    bits = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions.values())]
    rows = durable(
        read.withColumn("words", words(F.col("text"))).select(
            "doc_id", "part", sum(bits[1:], bits[0]).alias("failed"), F.unhex(F.sha2("text", 256)).alias("digest")
        )
    )
    known = rows.where("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    bit = F.when(F.col("first"), 0).otherwise(1 << len(conditions))
    marked = known.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", (F.col("failed") + bit).alias("failed"))
    return marked.unionByName(rows.where("doc_id is null").select("doc_id", "part", "failed"))


def labelled(rows: DataFrame, labels: DataFrame, traits: Mapping[str, Column]) -> DataFrame:
    """``rows`` with a boolean column per trait: whether any label row of the ``doc_id`` has it; false without labels."""
    named = labels.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(c).alias(n) for n, c in traits.items()])
    known = rows.where("doc_id is not null").join(named, "doc_id", "left")
    both = known.unionByName(rows.where("doc_id is null"), allowMissingColumns=True)
    return both.withColumns({n: F.coalesce(n, F.lit(False)) for n in traits})


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """For each of 2**n states the orders that reach it from the empty set, and that lead on to the full one."""
    full = (1 << n) - 1
    reach, leave = [1] + [0] * full, [0] * full + [1]
    for state in range(1, full + 1):
        reach[state] = sum(reach[state ^ 1 << k] for k in range(n) if state >> k & 1)
    for state in range(full - 1, -1, -1):
        leave[state] = sum(leave[state | 1 << k] for k in range(n) if not state >> k & 1)
    return reach, leave


def audit(rows: DataFrame, names: Sequence[str], traits: Sequence[str]) -> DataFrame:
    """One row per part, order of all filters and step, zeros included.

    ``rows`` has ``part``, ``failed`` (a bit per filter in the order of ``names``, one character each) and a boolean
    column per trait. Result: ``part``, ``filter_order``, ``step`` (from 1), ``kept``, ``removed``, ``redundant``
    (failed, but removed earlier), ``unique_fails`` (failed nothing else), ``{trait}_lost`` and ``shapley``. The table
    of a part is its counts by failed set (at most 2**n); orders only multiply these. An empty table gives no row.
    """
    if len(names) > MOST_FILTERS or any(len(n) != 1 for n in names):
        raise ValueError(f"up to {MOST_FILTERS} filters named by one character each: all their orders are reported")
    states, full = range(1 << len(names)), (1 << len(names)) - 1
    sets = rows.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("all"), *[F.count_if(t).alias(t) for t in traits]
    )
    free = [
        F.array(*[F.sum(F.when(F.col("failed").bitwiseAND(F.lit(s)) == 0, F.col(c)).otherwise(0)) for s in states]).alias(c)
        for c in ("all", *traits)
    ]
    reach, leave = path_counts(len(names))

    def at(column: str, state: Column | int) -> Column:
        return F.element_at(column, (state + 1) if isinstance(state, Column) else F.lit(state + 1))

    shares = []
    for k in range(len(names)):
        edges = [s for s in states if not s >> k & 1]
        shares.append(sum(F.lit(reach[s] * leave[s | 1 << k]) * (at("all", s) - at("all", s | 1 << k)) for s in edges))
    parts = sets.groupBy("part").agg(*free).withColumn("shares", F.array(*shares))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(names)])
    steps = parts.withColumn("filter_order", F.explode(orders))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(names)))))

    def bits(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(n)), 1 << k).otherwise(0) for k, n in enumerate(names)), F.lit(0))

    own = F.substring("filter_order", F.col("step"), F.lit(1))
    steps = steps.withColumns({
        "before": bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)),
        "own": bits(own),
        "filter": F.instr(F.lit("".join(names)), own),
    })
    after = F.col("before").bitwiseOR(F.col("own"))
    removed = at("all", F.col("before")) - at("all", after)
    others = F.lit(full).bitwiseXOR(F.col("own"))
    return steps.select(
        "part",
        "filter_order",
        "step",
        at("all", after).alias("kept"),
        removed.alias("removed"),
        (at("all", 0) - at("all", F.col("own")) - removed).alias("redundant"),
        (at("all", others) - at("all", full)).alias("unique_fails"),
        *[(at(t, F.col("before")) - at(t, after)).alias(f"{t}_lost") for t in traits],
        F.element_at("shares", F.col("filter")).alias("shapley"),
    )
