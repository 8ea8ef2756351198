"""Discounted returns and policy evaluation over logged episodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.arrays import let
from marlstone.plans.durable import durable
from marlstone.plans.positions import GROUP_ROWS, with_position

BLOCK = 2_000


def returns(
    df: DataFrame,
    *,
    episode: str,
    order_by: Sequence[str],
    reward: str,
    gamma: float = 0.99,
    block: int = BLOCK,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``G_t = r_t + gamma * G_(t+1)`` for every step.

    Episodes are cut into blocks of ``block`` steps. A block folds to one value and one
    discount; the same recursion over the blocks gives each block what follows it, and
    its steps are then folded on their own. Nothing divides by a power of gamma, so long
    episodes do not underflow, and no task holds more than a block.
    """
    if not 0 <= gamma <= 1:
        raise ValueError("gamma must lie between 0 and 1")
    if block < 2:
        raise ValueError("block must be at least 2")
    steps = with_position(
        df.select(episode, *order_by, F.col(reward).cast("double").alias(reward)),
        keys=[episode],
        order_by=order_by,
        name="__t",
        group_rows=group_rows,
    )
    last = steps.agg(F.max("__t")).first()[0] or 0
    # The step number comes back as "t" unless the order key has that name already.
    number = [] if "t" in order_by else [F.col("__t").alias("t")]
    items = steps.select(
        episode,
        F.col("__t").alias("at"),
        F.col(reward).alias("v"),
        F.lit(float(gamma)).alias("w"),
        F.struct(*number, *order_by, reward).alias("row"),
    )
    summed = _suffix_sums(items, episode, last, block)
    return summed.select(episode, "row.*", F.col("s").alias("discounted_return"))


def _suffix_sums(items: DataFrame, episode: str, last: int, block: int) -> DataFrame:
    """``s_i = v_i + w_i * s_(i+1)`` for items ``(episode, at, v, w, row)``, ``at <= last``.

    An item is an affine map of what follows. Within a block the maps are composed by a suffix scan that doubles its
    reach each turn; blocks are items of the next level.
    """
    blocks = items.groupBy(episode, F.expr(f"at div {block}").alias("b")).agg(
        F.array_sort(F.collect_list(F.struct("at", "v", "w", "row"))).alias("items")
    )
    if last < block:
        carried = blocks.withColumn("carry", F.lit(0.0))
    else:
        # Read twice, below and at the end: written once.
        blocks = durable(blocks)
        state = F.struct(F.lit(0.0).alias("v"), F.lit(1.0).alias("w"))
        whole = F.aggregate(
            F.reverse("items"),
            state,
            lambda a, x: F.struct(
                (x["v"] + x["w"] * a["v"]).alias("v"), (x["w"] * a["w"]).alias("w")
            ),
        )
        parts = blocks.select(episode, F.col("b").alias("at"), whole.alias("f")).select(
            episode, "at", "f.v", "f.w", F.lit(None).cast("int").alias("row")
        )
        after = _suffix_sums(parts, episode, last // block, block).select(
            episode, (F.col("at") - 1).alias("b"), F.col("s").alias("carry")
        )
        carried = blocks.join(after, [episode, "b"], "left").withColumn(
            "carry", F.coalesce("carry", F.lit(0.0))
        )

    def scanned(pair: Column) -> Column:
        maps = F.transform(pair["items"], lambda x: F.struct(x["v"].alias("v"), x["w"].alias("w")))
        for k in range((block - 1).bit_length()):
            maps = let(maps, _doubled(1 << k))
        values = F.transform(maps, lambda m: m["v"] + m["w"] * pair["carry"])
        return F.zip_with(
            pair["items"], values, lambda x, s: F.struct(x["at"].alias("at"), s.alias("s"), x["row"].alias("row"))
        )

    return carried.select(episode, F.inline(let(F.struct("items", "carry"), scanned)))


def _doubled(reach: int):
    """One turn of a suffix scan: maps that cover ``reach`` items take in those of the next ``reach``."""

    def turn(maps: Column) -> Column:
        def both(m: Column, i: Column) -> Column:
            after = F.get(maps, i + F.lit(reach))
            v, w = F.coalesce(after["v"], F.lit(0.0)), F.coalesce(after["w"], F.lit(1.0))
            return F.struct((m["v"] + m["w"] * v).alias("v"), (m["w"] * w).alias("w"))

        return F.transform(maps, both)

    return turn


def totals(df: DataFrame, *, episode: str, reward: str) -> DataFrame:
    """Undiscounted total and number of steps per episode."""
    return df.groupBy(episode).agg(
        F.sum(reward).alias("total"), F.count(F.lit(1)).alias("steps")
    )


def rollout(
    df: DataFrame,
    *,
    episode: str,
    order_by: Sequence[str],
    reward: str,
    max_steps: int | None = 500,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Steps and total reward per episode, at most ``max_steps`` steps each."""
    if max_steps is None:
        return totals(df, episode=episode, reward=reward)
    placed = with_position(
        df.select(episode, *order_by, reward), keys=[episode], order_by=order_by, group_rows=group_rows
    )
    return totals(placed.where(F.col("pos") < max_steps), episode=episode, reward=reward)


def evaluate(episodes: DataFrame, *, policy: Sequence[str] = (), total: str = "total") -> DataFrame:
    """Mean and population deviation of episode returns, per policy."""
    return episodes.groupBy(*policy).agg(
        F.avg(total).alias("mean_return"),
        F.stddev_pop(total).alias("std_return"),
        F.count(F.lit(1)).alias("episodes"),
    )
