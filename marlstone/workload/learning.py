"""Queries over supervised models, batch inference and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.arrays import let
from marlstone.functions.text import WORD_RUN
from marlstone.operators import inference, metrics, tabular
from marlstone.plans.durable import scratch_path
from marlstone.sources.models import ModelStore
from marlstone.streaming import streams
from marlstone.workload import derived
from marlstone.workload.evaluation import LATEST_SQL
from marlstone.workload.registry import query, table, texts


def _document_table(spark, folder):
    """Labelled documents with plain numeric features."""
    docs = texts(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    runs = F.regexp_extract_all(F.lower("text"), F.lit(WORD_RUN), F.lit(0))
    counted = docs.withColumn(
        "s",
        let(
            runs,
            lambda r: F.struct(
                F.size(r).alias("words"), F.size(F.array_distinct(r)).alias("distinct_words")
            ),
        ),
    )
    return counted.select(
        "doc_id",
        "quality",
        "n_chars",
        "s.words",
        "s.distinct_words",
        F.regexp_count("text", F.lit("\n")).alias("line_breaks"),
        F.regexp_count("text", F.lit("[0-9]")).alias("digits"),
        F.regexp_count("text", F.lit(r"[^\p{L}\p{N}\s]")).alias("marks"),
    )


@query(
    "feature_matrix",
    " UNION ALL ".join(
        f"SELECT c_custkey AS key, '{c}' AS feature, coalesce(CAST({c} AS DOUBLE), 0) AS value "
        "FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top, count(*) AS n FROM orders GROUP BY 1) "
        "ON c_custkey = o_custkey"
        for c in ("c_nationkey", "c_acctbal", "top", "n")
    ),
)
def feature_matrix(spark, folder):
    orders = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("top"), F.count(F.lit(1)).alias("n"))
    )
    rows = table(spark, folder, "customer").join(orders, "c_custkey", "left")
    long = tabular.feature_matrix(rows, key="c_custkey", target="c_mktsegment")
    return long.withColumnRenamed("c_custkey", "key")


def _rounded(df):
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, 6) for c in doubles})


CLASSIFY = {"target": "quality", "task": "classification", "key": "doc_id"}
REGRESS = {
    "target": "p_retailprice",
    "task": "regression",
    "key": "p_partkey",
    "features": ["p_partkey", "p_size"],
}


def _classifier(name: str, algorithm: str) -> None:
    @query(name)
    def run(spark, folder):
        model, held = tabular.train(_document_table(spark, folder), **CLASSIFY, algorithm=algorithm)
        return _rounded(tabular.scores(model, held))


def _regressor(name: str, algorithm: str) -> None:
    @query(name)
    def run(spark, folder):
        model, held = tabular.train(table(spark, folder, "part"), **REGRESS, algorithm=algorithm)
        return _rounded(tabular.scores(model, held))


for _name, _algorithm in {
    "clf_random_forest": "random_forest",
    "clf_logistic": "logistic",
    "clf_gbt": "gradient_boosting",
}.items():
    _classifier(_name, _algorithm)
for _name, _algorithm in {"reg_random_forest": "random_forest", "reg_gbt": "gradient_boosting"}.items():
    _regressor(_name, _algorithm)

LINE_SQL = """
    WITH parted AS (
      SELECT p_partkey, p_retailprice AS y, p_partkey AS x,
             ('0x' || substr(md5(p_partkey || ':42'), 1, 8))::BIGINT >= 3435973836 AS test FROM part),
    line AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM parted WHERE NOT test),
    scored AS (SELECT p_partkey, y, a + b * x AS p, test FROM parted, line)
"""


def _line(spark, folder):
    return tabular.train(
        table(spark, folder, "part"), **{**REGRESS, "features": ["p_partkey"]}, algorithm="linear"
    )


@query(
    "reg_linear",
    LINE_SQL
    + """SELECT round(sqrt(avg(pow(y - p, 2))), 4) AS rmse, round(1 - avg(pow(y - p, 2)) / var_pop(y), 4) AS r2,
         count(*) AS n FROM scored WHERE test""",
)
def reg_linear(spark, folder):
    model, held = _line(spark, folder)
    return tabular.scores(model, held).withColumns({c: F.round(c, 4) for c in ("rmse", "r2")})


@query("batch_predict", LINE_SQL + "SELECT p_partkey, round(p, 3) AS predicted FROM scored")
def batch_predict(spark, folder):
    """By a model that one store object saved and another finds by its name."""
    root = scratch_path(spark, "models")
    ModelStore(spark, root).save("price", _line(spark, folder)[0])
    scored = ModelStore(spark, root).predict("price", table(spark, folder, "part"))
    return scored.select("p_partkey", F.round("predicted", 3).alias("predicted"))


@query(
    "regression_metrics",
    """
    SELECT round(sqrt(avg(pow(l_extendedprice - 1500 * l_quantity, 2))), 3) AS rmse,
           round(1 - avg(pow(l_extendedprice - 1500 * l_quantity, 2)) / var_pop(l_extendedprice), 6) AS r2,
           count(*) AS n FROM lineitem
    """,
)
def regression_metrics(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 1500).alias("guess")
    )
    out = metrics.regression(rows, truth="l_extendedprice", prediction="guess")
    return out.withColumns({"rmse": F.round("rmse", 3), "r2": F.round("r2", 6)})


@query("feature_importance")
def feature_importance(spark, folder):
    rows = _document_table(spark, folder)
    names = tabular.feature_names(rows.drop("doc_id"), target="quality")
    model = tabular.fit(
        rows, target="quality", task="classification", algorithm="random_forest", features=names
    )
    return _rounded(tabular.importance(model, spark))


@query(
    "cv_folds",
    """
    WITH placed AS (
      SELECT o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey || ':42'), o_orderkey) - 1 AS r
      FROM orders)
    SELECT o_orderstatus, CAST(r % 5 AS INTEGER) AS fold, count(*) AS rows FROM placed GROUP BY 1, 2
    """,
)
def cv_folds(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    assigned = tabular.folds(orders, key="o_orderkey", k=5, stratify="o_orderstatus")
    return assigned.groupBy("o_orderstatus", "fold").agg(F.count(F.lit(1)).alias("rows"))


@query("cross_validate")
def cross_validate(spark, folder):
    return _rounded(tabular.cross_validate(_document_table(spark, folder), **CLASSIFY))


def _weights():
    """A fixed linear scorer standing in for a caller's model."""
    import numpy as np

    weights = np.arange(1, 65, dtype=np.float64) / 64

    def predict(vectors):
        return vectors.astype(np.float64) @ weights

    return predict


@query(
    "batch_infer",
    """
    SELECT vec_id, round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * i / 64)), 6) + 0.0 AS score
    FROM embeddings
    """,
)
def batch_infer(spark, folder):
    scored = inference.batch_infer(
        table(spark, folder, "embeddings"),
        _weights,
        inputs=["embedding"],
        output="score",
        return_type=T.DoubleType(),
        batch_size=256,
        tensor_shapes=[[64]],
    )
    return scored.select("vec_id", F.round("score", 6).alias("score"))


# --- streams -------------------------------------------------------------------------------------


def _event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    return streams.source(spark, folder, schema, glob="events.parquet")


@query(
    "stream_ingest",
    "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type",
)
def stream_ingest(spark, folder):
    root = scratch_path(spark, "ingest")
    streams.drain(_event_stream(spark, folder), f"{root}/table", f"{root}/checkpoint")
    return (
        spark.read.parquet(f"{root}/table")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    )


@query(
    "stream_resample",
    """
    SELECT event_type, CAST(epoch(time_bucket(INTERVAL 6 HOUR, ts)) AS BIGINT) AS start, round(avg(value), 6) AS mean,
           count(*) AS n
    FROM events GROUP BY event_type, time_bucket(INTERVAL 6 HOUR, ts)
    """,
)
def stream_resample(spark, folder):
    """Every window of the drained stream, the open ones too."""
    means = streams.resample_all(
        _event_stream(spark, folder), scratch_path(spark, "resample"), time="ts", value="value", every="6 hours", keys=["event_type"]
    )
    return means.select("event_type", F.unix_seconds("start").alias("start"), F.round("mean", 6).alias("mean"), "n")


def _arrivals(rows, incoming, month):
    """Write a table as one arrival per distinct ``month``, oldest first."""
    marked = rows.withColumn("__m", month)
    for (value,) in sorted(marked.select("__m").distinct().collect()):
        marked.where(F.col("__m") == value).drop("__m").write.mode("append").parquet(incoming)
        yield value


@query(
    "stream_anomalies",
    """
    WITH scored AS (
      SELECT event_id, user_id, value, count(*) OVER w AS n, avg(value) OVER w AS m, stddev_pop(value) OVER w AS d
      FROM events WINDOW w AS (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT user_id, event_id, value, round((value - m) / (d + 1e-9), 5) AS z FROM scored
    WHERE n >= 5 AND abs((value - m) / (d + 1e-9)) > 3
    """,
)
def stream_anomalies(spark, folder):
    """Each event against all events of its user before it, arriving week by week, by a new stream object each week."""
    rows = table(spark, folder, "events").select("user_id", "event_id", "ts", "value")
    root = scratch_path(spark, "anomalies")
    week = F.date_trunc("week", F.col("ts").cast("timestamp"))
    for _ in _arrivals(rows, f"{root}/incoming", week):
        stream = streams.AnomalyStream(
            spark, f"{root}/incoming", root, rows.schema, series=["user_id"], value="value", order_by=["ts", "event_id"]
        )
        stream.advance()
    return stream.anomalies().select("user_id", "event_id", "value", F.round("z", 5).alias("z"))


@query("stream_state_latest", LATEST_SQL + "SELECT key, value, tag, seq FROM latest")
def stream_state_latest(spark, folder):
    """The keyed state after two arrivals, the later events first."""
    log = derived.writes(spark, folder)
    root = scratch_path(spark, "state")
    stream = streams.StateStream(
        spark, f"{root}/incoming", root, log.schema, key="key", order_by=["ts", "seq"]
    )
    for _ in _arrivals(log, f"{root}/incoming", F.col("value").isin("view", "click")):
        stream.advance()
    return stream.latest().withColumn("tag", F.element_at("tags", 1)).drop("tags", "ts")
