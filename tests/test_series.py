import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import rl, state, timeseries
from marlstone.plans import joins, positions

KEYS = {"series": ["k"], "order_by": ["t"], "value": "v"}


def table(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "k string, t long, v double").repartition(partitions)


@pytest.fixture(scope="module")
def skewed(spark):
    """One series with most rows, next to short ones."""
    rng = random.Random(7)
    sizes = {"hot": 900, "a": 1, "b": 5, "c": 60}
    rows = [(k, t, rng.uniform(-5, 5)) for k, n in sizes.items() for t in range(n)]
    rng.shuffle(rows)
    return table(spark, rows).cache(), rows


def by_series(rows):
    series = {}
    for k, t, v in sorted(rows):
        series.setdefault(k, []).append(v)
    return series


@pytest.mark.parametrize("group_rows", [10_000, 50])
def test_positions(skewed, group_rows):
    df, rows = skewed
    placed = positions.with_position(df, keys=["k"], order_by=["t"], group_rows=group_rows)
    assert {(r.k, r.t): r.pos for r in placed.collect()} == {(k, t): t for k, t, _ in rows}


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_global_positions(spark, skewed, partitions):
    df, rows = skewed
    placed = positions.with_position(df.repartition(partitions), order_by=["k", "t"]).collect()
    want = {kt: i for i, kt in enumerate(sorted((k, t) for k, t, _ in rows))}
    assert {(r.k, r.t): r.pos for r in placed} == want


def test_positions_with_null_key(spark):
    df = table(spark, [(None, t, 0.0) for t in range(40)] + [("a", 0, 0.0)])
    placed = positions.with_position(df, keys=["k"], order_by=["t"], group_rows=5).collect()
    assert len(placed) == 41 and all(r.pos == r.t for r in placed)


@pytest.mark.parametrize("group_rows", [10_000, 50])
@pytest.mark.parametrize("window,spread", [(1, 0.0), (7, 2.0)])
def test_rolling_of_a_ramp(spark, group_rows, window, spread):
    """Seven whole numbers in a row have their middle as mean and a deviation of two."""
    df = table(spark, [("hot", t, float(t)) for t in range(400)] + [("a", t, float(t)) for t in range(8)])
    got = timeseries.rolling(df, **KEYS, window=window, group_rows=group_rows).collect()
    assert {(r.k, r.t) for r in got} == {(k, t) for k, n in (("hot", 400), ("a", 8)) for t in range(window - 1, n)}
    for r in got:
        assert (r.rolling_mean, r.rolling_std) == pytest.approx((r.t - (window - 1) / 2, spread), abs=1e-9)


def test_halo_blocks_hold_wide_windows(skewed):
    df, rows = skewed
    out = positions.over_trailing_rows(
        df,
        keys=["k"],
        order_by=["t"],
        width=30,
        group_rows=50,
        block_rows=40,
        columns=lambda w: {"s": F.sum("v").over(w.rowsBetween(-29, 0))},
    ).collect()
    series = by_series(rows)
    assert len(out) == len(rows)
    for r in out:
        assert r.s == pytest.approx(sum(series[r.k][max(0, r.pos - 29) : r.pos + 1]), abs=1e-9)


RESAMPLED = {
    "mean": {("s", 0): 4.0, ("s", 1): 6.25, ("z", 0): -1.0},
    "median": {("s", 0): 2.5, ("s", 1): 6.0, ("z", 0): 0.5},
    "other": {("s", 0): 4.0, ("s", 1): 6.25, ("z", 0): -1.0},
}


@pytest.mark.parametrize("method", list(RESAMPLED))
@pytest.mark.parametrize("group_rows", [10_000, 3])
def test_resample(spark, method, group_rows):
    long = [1.0, 2.0, 3.0, 10.0, 7.0, 5.0, 5.0, 8.0, 4.0]
    rows = [("s", t, v) for t, v in enumerate(long)] + [("z", t, v) for t, v in enumerate([1.0, 0.0, 3.0, -8.0])]
    out = timeseries.resample(table(spark, [*rows, ("short", 0, 9.0)]), **KEYS, factor=4, method=method, group_rows=group_rows)
    assert {(r.k, r.block): r.resampled for r in out.collect()} == pytest.approx(RESAMPLED[method])


FORECASTS = {"last": [4.0, 4.0, 4.0], "mean": [3.0, 3.0, 3.0], "drift": [5.0, 6.0, 7.0], "unknown": [4.0, 4.0, 4.0]}


@pytest.mark.parametrize("method", list(FORECASTS))
def test_forecast(spark, method):
    df = table(spark, [("s", 0, 2.0), ("s", 1, 3.0), ("s", 2, 4.0), ("one", 0, 6.0)])
    out = timeseries.forecast(df, **KEYS, horizon=3, method=method).orderBy("step").collect()
    assert [r.forecast for r in out if r.k == "s"] == pytest.approx(FORECASTS[method], abs=1e-9)
    assert [r.forecast for r in out if r.k == "one"] == pytest.approx([6.0, 6.0, 6.0], abs=1e-9)


def test_forecast_without_horizon(skewed):
    assert timeseries.forecast(skewed[0], **KEYS, horizon=0).count() == 0


def test_anomaly_threshold_is_strict(spark):
    values = [0.0] * 9 + [10.0]
    z = (10.0 - 1.0) / (3.0 + 1e-9)
    df = table(spark, [("a", t, v) for t, v in enumerate(values)] + [("flat", t, 2.0) for t in range(4)])
    how = {"series": ["k"], "value": "v", "carry": ["t"]}
    assert [r.t for r in timeseries.anomalies(df, **how, z=z - 1e-6).collect()] == [9]
    assert timeseries.anomalies(df, **how, z=z).count() == 0


def test_summary_of_nothing(spark):
    assert timeseries.summary(table(spark, []), series=["k"], value="v").count() == 0
    whole = timeseries.summary(table(spark, []), series=[], value="v").first()
    assert (whole.length, whole["mean"], whole["std"]) == (0, None, None)


@pytest.mark.parametrize("bad", [0, -1])
def test_bad_arguments(skewed, bad):
    with pytest.raises(ValueError):
        timeseries.rolling(skewed[0], **KEYS, window=bad)
    with pytest.raises(ValueError):
        timeseries.resample(skewed[0], **KEYS, factor=bad)


STEPS = {"episode": "k", "order_by": ["t"], "reward": "v"}


@pytest.mark.parametrize(
    "gamma,want", [(0.0, [8.0, 4.0, 0.0, 2.0]), (0.5, [10.25, 4.5, 1.0, 2.0]), (1.0, [14.0, 6.0, 2.0, 2.0])]
)
@pytest.mark.parametrize("block,group_rows", [(2_000, 10_000), (3, 10_000), (2, 3)])
def test_returns(spark, gamma, want, block, group_rows):
    rewards = [8.0, 4.0, 0.0, 2.0]
    df = table(spark, [("e", t, v) for t, v in enumerate(rewards)] + [("one", 0, 5.0)])
    out = rl.returns(df, **STEPS, gamma=gamma, block=block, group_rows=group_rows).collect()
    got = {(r.k, r.t): r.discounted_return for r in out}
    assert got == pytest.approx({**{("e", t): v for t, v in enumerate(want)}, ("one", 0): 5.0}, abs=1e-8)


def test_long_episode_does_not_underflow(spark):
    n = 100_000
    df = spark.range(n).select(F.lit("e").alias("k"), F.col("id").alias("t"), F.lit(1.0).alias("v"))
    out = rl.returns(df, **STEPS, gamma=0.5)
    assert out.count() == n
    low, high = out.agg(F.min("discounted_return"), F.max("discounted_return")).first()
    assert (low, high) == (1.0, pytest.approx(2.0))


def test_rollout_and_evaluate(skewed):
    df, rows = skewed
    out = {r.k: (r.total, r.steps) for r in rl.rollout(df, **STEPS, max_steps=10, group_rows=50).collect()}
    for k, v in by_series(rows).items():
        assert out[k] == (pytest.approx(sum(v[:10])), min(10, len(v)))
    everything = rl.rollout(df, **STEPS, max_steps=None)
    mean = rl.evaluate(everything).first()
    totals = [sum(v) for v in by_series(rows).values()]
    assert mean.mean_return == pytest.approx(np.mean(totals))
    assert mean.std_return == pytest.approx(np.std(totals))


@pytest.mark.parametrize("group_rows", [10_000, 50])
def test_trace(spark, skewed, group_rows):
    timed = skewed[0].withColumn("at", F.timestamp_seconds(F.col("t") * F.col("t")))
    out = state.trace(timed, actor="k", order_by=["t"], time="at", group_rows=group_rows)
    for r in out.collect():
        assert r.gap_seconds == (None if r.t == 0 else 2 * r.t - 1)


# --- keyed state ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        ("a", "1", ["x"], 1, 1),
        ("a", "2", None, 1, 2),
        ("b", "3", ["x", "y"], 2, 3),
        ("*", "clear", None, 3, 4),
        ("b", "4", ["y"], 3, 5),
    ]
    raw = spark.createDataFrame(rows, "key string, value string, tags array<string>, ts long, seq long")
    return state.write(None, raw)


def test_latest_breaks_ties_by_sequence(log):
    latest = {r.key: r for r in state.latest(log, key="key", order_by=["ts", "seq"]).collect()}
    assert (latest["a"].value, latest["a"].tags) == ("2", [])
    assert latest["b"].value == "4"


def test_lookup_and_tags(spark, log):
    latest = state.latest(log, key="key", order_by=["ts", "seq"])
    keys = spark.createDataFrame([("a",), ("nobody",)], "key string")
    found = {r.key: r.found for r in state.lookup(latest, keys, key="key").collect()}
    assert found == {"a": True, "nobody": False}
    assert [r.key for r in state.by_tag(latest, "y").collect()] == ["b"]
    assert state.by_tag(latest).count() == 3


def test_clear(log):
    cleared = F.col("value") == "clear"
    kept = state.after_clear(log, cleared=cleared, order_by=["ts", "seq"]).collect()
    assert [(r.key, r.value) for r in kept] == [("b", "4")]
    never = state.after_clear(log, cleared=F.lit(False), order_by=["ts", "seq"])
    assert never.count() == 5


def test_recent(log):
    last = state.recent(log, order_by=["seq"], limit=2).collect()
    assert [r.seq for r in last] == [4, 5]
    assert state.recent(log, order_by=["seq"], limit=0).count() == 0


def test_notes_default_role(spark):
    notes = spark.createDataFrame([(5, None), (9, "critic")], "id long, role string")
    out = {r.id: (r.role, r["index"]) for r in state.index_notes(notes, order_by=["id"]).collect()}
    assert out == {5: ("planner", 0), 9: ("critic", 1)}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize(("broadcast_rows", "heavy_rows"), [(100, 100), (0, 10_000), (0, 3)])
def test_attach_with_a_hot_key(spark, skewed, how, broadcast_rows, heavy_rows):
    df, rows = skewed
    known = spark.createDataFrame([("hot", 1), ("a", 2), ("unused", 3)], "k string, n int")
    out = joins.attach(df, known, ["k"], how=how, broadcast_rows=broadcast_rows, heavy_rows=heavy_rows)
    numbers = {"hot": 1, "a": 2}
    want = sorted((k, t, numbers.get(k, 0)) for k, t, _ in rows if how == "left" or k in numbers)
    assert sorted((r.k, r.t, r.n or 0) for r in out.collect()) == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_attach_with_maps_equal_rows_and_null_keys(spark, how):
    rows = [("hot", {"a": 1})] * 7 + [("b", None), ("b", None), (None, {"c": 2}), (None, None), ("none", {})]
    df = spark.createDataFrame(rows, "k string, m map<string,int>")
    known = spark.createDataFrame([("hot", [1]), ("b", [2])], "k string, v array<int>")
    out = joins.attach(df, known, ["k"], how=how, broadcast_rows=0, heavy_rows=4)
    numbers = {"hot": [1], "b": [2]}
    want = sorted(str((k, m, numbers.get(k))) for k, m in rows if how == "left" or k in numbers)
    assert out.columns == ["k", "m", "v"]
    assert sorted(str((r.k, r.m, r.v)) for r in out.collect()) == want


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.createDataFrame([("k", "x" * 1000)], "k string, v string")
    assert joins.fits_broadcast(wide) and not joins.fits_broadcast(wide, size=900) and not joins.fits_broadcast(wide, rows=0)


def test_sums_before_in_slices(spark):
    rows = [(k, t, float(t % 5)) for k in ("a", "b", None) for t in range(25 if k == "a" else 4)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(3)
    for group_rows in (100, 4):
        out = positions.sums_before(df, keys=["k"], order_by=["t"], sums={"s": F.col("v"), "n": F.lit(1)}, group_rows=group_rows)
        got = {(r.k, r.t): (r.s, r.n) for r in out.collect()}
        assert got == {(k, t): (sum(float(x % 5) for x in range(t)), t) for k, t, _ in rows}
