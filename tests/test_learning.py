import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators import inference, profile, tabular
from marlstone.sources import datasets
from marlstone.sources.models import ModelStore
from marlstone.streaming import streams


@pytest.fixture(scope="module")
def points(spark):
    """A class and a number that follow from x and y; z is noise, w is text."""
    unit = lambda salt: F.pmod(F.hash(F.col("id"), F.lit(salt)), F.lit(1000)) / 1000.0
    df = spark.range(600).select("id", unit(1).alias("x"), unit(2).alias("y"), unit(3).alias("z"))
    return df.select(
        "*",
        F.when(F.col("x") > 0.66, "high").when(F.col("x") > 0.33, "mid").otherwise("low").alias("class"),
        (3 * F.col("x") - 2 * F.col("y") + 1).alias("target"),
        F.lit("t").alias("w"),
    ).cache()


CLASSIFY = {"target": "class", "task": "classification", "key": "id", "features": ["x", "y", "z", "w"]}
REGRESS = {"target": "target", "task": "regression", "key": "id", "features": ["x", "y", "z"]}


@pytest.mark.parametrize("algorithm", ["random_forest", "logistic", "gradient_boosting", "unknown"])
def test_classifiers_beat_the_majority(points, algorithm):
    model, held = tabular.train(points, **CLASSIFY, algorithm=algorithm, trees=5, depth=5)
    assert model.features == ["x", "y", "z"]
    report = {r.average: r for r in tabular.scores(model, held).collect()}
    assert report["accuracy"].f1 > 0.6
    assert 60 < report["accuracy"].support < 180


@pytest.mark.parametrize("algorithm", ["random_forest", "linear", "gradient_boosting"])
def test_regressors_beat_the_mean(points, algorithm):
    model, held = tabular.train(points, **REGRESS, algorithm=algorithm, trees=10, depth=5)
    out = tabular.scores(model, held).first()
    assert out.r2 > (0.999 if algorithm == "linear" else 0.6)


def files_below(path):
    return sorted(str(p) for p in path.rglob("*.parquet"))


def test_saved_models_serve_another_session(spark, points, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    forest, _ = tabular.train(points, **CLASSIFY, trees=3, depth=3)
    line, _ = tabular.train(points, **REGRESS, algorithm="linear")
    for name, model in (("shape", line), ("shape", forest), ("line", line)):
        store.save(name, model)
    other = spark.newSession()
    again = ModelStore(other, str(tmp_path / "models"))
    rows = other.createDataFrame(points.select("id", *forest.features).collect(), points.select("id", *forest.features).schema)
    for name, model in (("shape", forest), ("line", line)):
        want = {r.id: r.predicted for r in tabular.predict(model, points).collect()}
        loaded = again.load(name)
        assert (loaded.features, loaded.target, loaded.task, loaded.algorithm) == (model.features, model.target, model.task, model.algorithm)
        source = rows if set(model.features) <= set(rows.columns) else points
        assert {r.id: r.predicted for r in again.predict(name, source).collect()} == want
    assert {(r.name, r.task) for r in again.list().collect()} == {("shape", "classification"), ("line", "regression")}
    before = len(files_below(tmp_path))
    again.delete("shape")
    assert [r.name for r in store.list().collect()] == ["line"] and len(files_below(tmp_path)) < before
    with pytest.raises(ValueError, match="no model"):
        store.predict("shape", points)


def test_prediction_fills_and_checks(points):
    model, _ = tabular.train(points, **REGRESS, algorithm="linear")
    gaps = points.limit(3).withColumns({"x": F.lit(None).cast("double"), "y": F.lit(None).cast("double")})
    out = tabular.predict(model, gaps).collect()
    assert all(r.predicted == pytest.approx(1, abs=1e-6) and r.x is None for r in out)
    with pytest.raises(ValueError, match="missing feature"):
        tabular.predict(model, points.drop("y"))


def test_importance(spark, points):
    model, _ = tabular.train(points, **CLASSIFY, trees=10, depth=5)
    rows = tabular.importance(model, spark).orderBy("rank").collect()
    assert rows[0].feature == "x" and sum(r.importance for r in rows) == pytest.approx(1)
    linear, _ = tabular.train(points, **REGRESS, algorithm="linear")
    with pytest.raises(ValueError, match="importances"):
        tabular.importance(linear, spark)


def test_bad_features(points):
    with pytest.raises(ValueError):
        tabular.train(points, **{**CLASSIFY, "features": ["nope"]})
    with pytest.raises(ValueError):
        tabular.train(points, **{**CLASSIFY, "features": ["w"]})


def test_folds_are_even(points):
    for stratify in (None, "class"):
        sizes = tabular.folds(points, key="id", k=4, stratify=stratify).groupBy(
            *([stratify] if stratify else []), "fold"
        ).count()
        groups = {}
        for r in sizes.collect():
            groups.setdefault(r[stratify] if stratify else "all", []).append(r["count"])
        assert all(len(g) == 4 and max(g) - min(g) <= 1 for g in groups.values())


@pytest.mark.parametrize("how", [CLASSIFY, REGRESS])
def test_cross_validation(points, how):
    rows = tabular.cross_validate(points, **how, k=2, trees=5, depth=5).collect()
    assert len(rows) == 2 and rows[0]["mean"] > 0.5
    assert rows[0]["mean"] == pytest.approx(sum(r.score for r in rows) / 2)


def test_batch_inference_loads_a_model(spark):
    def loader():
        return lambda a, b: a + 2 * b

    df = spark.range(100).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"))
    out = inference.batch_infer(df, loader, inputs=["a", "b"], output="s", return_type=T.DoubleType())
    assert all(r.s == r.a + 2 for r in out.collect())


# --- profiles and sources ------------------------------------------------------------------------


def test_quartiles_by_sort_equal_exact_ones(spark):
    df = spark.range(101).select(
        F.pmod(F.hash("id"), F.lit(37)).cast("double").alias("a"),
        F.when(F.col("id") < 70, 5.0).otherwise(F.col("id").cast("double")).alias("b"),
        F.when(F.col("id") > 3, F.col("id")).alias("c"),
    )
    exact = profile.describe_numeric(df).orderBy("column_name").collect()
    sorted_ = profile.describe_numeric(df, exact_values=0).orderBy("column_name").collect()
    assert exact == sorted_ and [r.column_name for r in exact] == ["a", "b", "c"]


def test_describe_categorical_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "x string")
    out = profile.describe_categorical(df, columns=["x"]).first()
    assert (out["count"], out.unique, out.top, out.freq) == (2, 2, "a", 1)


def test_catalog_search_and_card(spark):
    df = spark.createDataFrame(
        [("m1", "Big Model", "t1", 5, ["x"] * 30), ("m2", "small model", "t1", 9, []), ("m3", "other", "t1", 99, [])],
        "id string, name string, task string, downloads long, tags array<string>",
    )
    how = {"search_in": "name", "sort_by": "downloads", "key": "id"}
    assert [r.id for r in datasets.search_catalog(df, query="MODEL", **how).collect()] == ["m2", "m1"]
    assert [r.id for r in datasets.search_catalog(df, facets={"task": "t1"}, limit=1, **how).collect()] == ["m3"]
    assert len(datasets.card(df, key="id", wanted="m1", tags="tags").first().tags) == 20


def test_formats_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "train"), (2, "b", "test")], "n int, s string, part string")
    for fmt in ("parquet", "json", "csv", "orc"):
        path = str(tmp_path / f"t.{fmt}")
        wanted = datasets.manifest(df).first()
        assert datasets.publish(df, path, fmt=fmt).first() == wanted
        back = datasets.load_dataset(spark, path, split_col="part", split="test")
        assert [(r.n, r.s) for r in back.collect()] == [(2, "b")]
    with pytest.raises(ValueError):
        datasets.load_dataset(spark, "x", fmt="xlsx")


def test_sample_checks_its_text_column(spark):
    df = spark.createDataFrame([(i, "x") for i in range(5)], "id long, t string")
    assert datasets.sft_sample(df, order_by=["id"], text_col="t", max_samples=0).count() == 5
    assert datasets.sft_sample(df, order_by=["id"], text_col="t", max_samples=2).count() == 2
    with pytest.raises(ValueError):
        datasets.sft_sample(df, order_by=["id"], text_col="text")


# --- streams ---------------------------------------------------------------------------------------


def test_sessions_on_a_table(spark):
    rows = [(s,) for s in (0, 60, 120, 1000, 1030)]
    df = spark.createDataFrame(rows, "s long").select(F.timestamp_seconds("s").alias("ts"), F.lit(1.0).alias("v"))
    out = streams.resample(df, time="ts", value="v", every="1 hour", gap="5 minutes").orderBy("start")
    assert [r.n for r in out.collect()] == [3, 2]


def test_ingest_is_incremental(spark, tmp_path):
    incoming, root = str(tmp_path / "in"), str(tmp_path / "out")
    for start in (0, 10):
        spark.range(start, start + 10).write.mode("append").parquet(incoming)
        stream = streams.source(spark, incoming, T.StructType([T.StructField("id", T.LongType())]))
        streams.drain(stream, f"{root}/t", f"{root}/c")
    assert sorted(r.id for r in spark.read.parquet(f"{root}/t").collect()) == list(range(20))


ANOMALY_SCHEMA = "k string, at long, v double"


def anomaly_stream(spark, folder, **options):
    schema = spark.createDataFrame([], ANOMALY_SCHEMA).schema
    return streams.AnomalyStream(spark, f"{folder}/in", f"{folder}/out", schema, series=["k"], value="v", order_by=["at"], **options)


def expected_scores(batches, min_rows=5):
    """Each row against all rows of its series before it, by hand."""
    seen, out = {}, []
    for batch in batches:
        for k, at, v in sorted(batch, key=lambda r: r[1]):
            own = [x for x in seen.setdefault(k, []) if x is not None]
            z = None
            if v is not None and len(own) >= min_rows:
                mean = sum(own) / len(own)
                z = (v - mean) / ((sum((x - mean) ** 2 for x in own) / len(own)) ** 0.5 + streams.SIGMA_FLOOR)
            out.append((k, at, v, z))
            seen[k].append(v)
    return out


def scored_rows(stream):
    return sorted(((r.k, r.at, r.v, r.z) for r in stream.scored().collect()), key=lambda r: (r[0] or "", r[1]))


def same_scores(found, batches):
    want = sorted(expected_scores(batches), key=lambda r: (r[0] or "", r[1]))
    assert [r[:3] for r in found] == [r[:3] for r in want]
    for got, expected in zip(found, want, strict=True):
        assert got[3] == (None if expected[3] is None else pytest.approx(expected[3], rel=1e-7, abs=1e-7))


ARRIVALS = [
    [("a", k, 1000.0 + k % 4) for k in range(7)] + [(None, k, float(k)) for k in range(6)] + [("b", 0, None), ("b", 1, 2.0)],
    [("a", k, 1000.0 + k % 3) for k in range(10, 19)] + [("a", 19, None), ("b", 3, 4.0), (None, 9, 50.0)],
    [("a", 30, 1500.0), ("a", 31, 1001.0), ("c", 1, 1.0)],
]


def arrive(spark, folder, rows, schema=ANOMALY_SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")


@pytest.mark.parametrize("options", [{}, {"group_rows": 2}, {"files_per_batch": 1}], ids=["windows", "slices", "files"])
def test_anomaly_stream_goes_on_in_a_new_object(spark, tmp_path, options):
    for rows in ARRIVALS:
        arrive(spark, tmp_path, rows)
        stream = anomaly_stream(spark, tmp_path, **options)
        stream.advance()
    same_scores(scored_rows(stream), ARRIVALS)
    assert {("a", 1500.0), (None, 50.0)} <= {(r.k, r.v) for r in stream.anomalies().collect()}


def test_anomaly_batch_replayed_after_a_crash(spark, tmp_path, monkeypatch):
    arrive(spark, tmp_path, ARRIVALS[0])
    anomaly_stream(spark, tmp_path).advance()
    arrive(spark, tmp_path, ARRIVALS[1])
    fold = streams.AnomalyStream.fold

    def ends_late(self, rows, batch):
        fold(self, rows, batch)
        raise RuntimeError("the driver is lost after the batch wrote its tables")

    monkeypatch.setattr(streams.AnomalyStream, "fold", ends_late)
    with pytest.raises(Exception, match="driver is lost"):
        anomaly_stream(spark, tmp_path).advance()
    monkeypatch.setattr(streams.AnomalyStream, "fold", fold)
    arrive(spark, tmp_path, ARRIVALS[2])
    stream = anomaly_stream(spark, tmp_path)
    stream.advance()
    same_scores(scored_rows(stream), ARRIVALS)


STATE_SCHEMA = "key string, value string, seq long, extra map<string,string>"


def state_stream(spark, folder):
    schema = spark.createDataFrame([], STATE_SCHEMA).schema
    return streams.StateStream(spark, f"{folder}/in", f"{folder}/out", schema, key="key", order_by=["seq"], buckets=4)


def test_state_stream_upserts_into_a_snapshot(spark, tmp_path):
    batches = [
        [("a", "one", 1, {"x": "y"}), ("b", "two", 9, None), (None, "null", 1, None), ("a", "three", 3, None)],
        [("a", "late", 2, None), ("b", "ten", 10, None), ("c", None, 1, None)],
        [],
        [(None, "again", 5, None)],
    ]
    last = {}
    for rows in batches:
        arrive(spark, tmp_path, rows, STATE_SCHEMA)
        stream = state_stream(spark, tmp_path)
        stream.advance()
        for key, value, seq, _ in rows:
            if key not in last or seq > last[key][1]:
                last[key] = value, seq
        assert {r.key: (r.value, r.seq) for r in stream.latest().collect()} == last
    files = {f for f in stream.latest().inputFiles()}
    assert files and all("/out/snapshot/" in f for f in files)
    # A batch folded twice, whole or late, changes nothing.
    for batch in (0, 1, 7):
        stream.fold(spark.createDataFrame(batches[batch % 2], STATE_SCHEMA), batch)
        assert {r.key: (r.value, r.seq) for r in stream.latest().collect()} == last


def test_resampled_stream_keeps_open_windows_and_late_rows(spark, tmp_path):
    schema = "k string, ts timestamp, v double"

    def arrive(rows):
        rows = [(k, datetime.datetime(2024, 1, 1, hour, minute), v) for k, hour, minute, v in rows]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/incoming")
        stream = streams.source(spark, f"{tmp_path}/incoming", spark.createDataFrame([], schema).schema)
        out = streams.resample_all(stream, f"{tmp_path}/out", time="ts", value="v", every="1 hour", keys=["k"])
        return {(r["k"], r["start"].hour): (r["mean"], r["n"], r["n_closed"]) for r in out.collect()}

    first = arrive([("a", 0, 5, 1.0), ("a", 0, 50, 3.0), ("a", 3, 0, 5.0), (None, 0, 1, 7.0)])
    assert first == {("a", 0): (2.0, 2, 2), ("a", 3): (5.0, 1, None), (None, 0): (7.0, 1, 1)}
    second = arrive([("a", 0, 30, 8.0), ("a", 5, 0, 9.0)])
    assert second == {("a", 0): (4.0, 3, 2), ("a", 3): (5.0, 1, 1), ("a", 5): (9.0, 1, None), (None, 0): (7.0, 1, 1)}
