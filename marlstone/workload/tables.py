"""Queries over sources, row-level operators and series."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators import prep, profile, timeseries
from marlstone.plans.durable import scratch_path
from marlstone.sources import datasets
from marlstone.workload import derived
from marlstone.workload.derived import SERIES_SQL
from marlstone.workload.registry import query, table, texts

SERIES = {"series": ["series_id"], "order_by": ["ts", "event_id"], "value": "value"}


@query(
    "dataset_summary",
    """
    SELECT (SELECT count(*) FROM documents) AS num_rows, 5 AS num_columns,
           'doc_id,text,lang,source,n_chars' AS columns,
           (SELECT string_agg(doc_id || '/' || lang, ',' ORDER BY doc_id)
            FROM (SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 3)) AS sample
    """,
)
def dataset_summary(spark, folder):
    summary = datasets.summarize(
        datasets.load_dataset(spark, f"{folder}/documents.parquet"), order_by=["doc_id"]
    )
    rows = F.transform(
        F.split("sample", "\n"),
        lambda r: F.concat_ws(
            "/", F.get_json_object(r, "$.doc_id"), F.get_json_object(r, "$.lang")
        ),
    )
    return summary.withColumn("sample", F.array_join(rows, ","))


@query("dataset_peek", "SELECT event_id, user_id, event_type, value FROM events ORDER BY ts, event_id LIMIT 3")
def dataset_peek(spark, folder):
    first = datasets.peek(table(spark, folder, "events"), order_by=["ts", "event_id"])
    return first.select("event_id", "user_id", "event_type", "value")


@query(
    "csv_profile",
    """
    SELECT CAST(o AS INTEGER) AS ordinal, c AS column_name, t AS dtype, (SELECT count(*) FROM part) AS rows
    FROM (VALUES (0, 'p_partkey', 'int'), (1, 'p_name', 'string'), (2, 'p_brand', 'string'),
                 (3, 'p_type', 'string'), (4, 'p_size', 'int'), (5, 'p_retailprice', 'double')) v(o, c, t)
    """,
)
def csv_profile(spark, folder):
    path = scratch_path(spark, "part-csv")
    table(spark, folder, "part").write.option("header", True).csv(path)
    return profile.dtypes(datasets.load_csv(spark, path))


@query(
    "series_summary",
    """
    SELECT user_id AS series_id, count(*) AS length, round(avg(value), 6) AS mean,
           round(stddev_pop(value), 6) AS std
    FROM events GROUP BY user_id
    """,
)
def series_summary(spark, folder):
    stats = timeseries.summary(derived.series(spark, folder), series=["series_id"], value="value")
    return stats.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(
    "sft_sample",
    "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 1000",
)
def sft_sample(spark, folder):
    docs = table(spark, folder, "documents")
    return datasets.sft_sample(docs, order_by=["doc_id"], text_col="text").select(
        "doc_id", "lang", "n_chars"
    )


@query(
    "catalog_search",
    """
    SELECT p_partkey, p_name, p_type, p_retailprice FROM part
    WHERE lower(p_name) LIKE '%widget%' AND p_type = 'ECONOMY'
    ORDER BY p_retailprice DESC, p_partkey LIMIT 10
    """,
)
def catalog_search(spark, folder):
    found = datasets.search_catalog(
        table(spark, folder, "part"),
        search_in="p_name",
        query="Widget",
        facets={"p_type": "ECONOMY"},
        sort_by="p_retailprice",
        key="p_partkey",
    )
    return found.select("p_partkey", "p_name", "p_type", "p_retailprice")


HASH_SQL = "('0x' || substr(md5(doc_id || ':42'), 1, 8))::BIGINT"


@query(
    "split_hash",
    f"SELECT doc_id, CASE WHEN {HASH_SQL} >= 3435973836 THEN 'test' ELSE 'train' END AS split FROM documents",
)
def split_hash(spark, folder):
    return prep.split(table(spark, folder, "documents").select("doc_id"), key="doc_id")


@query(
    "split_exact",
    """
    SELECT doc_id, CASE WHEN r <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split
    FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) AS r,
                 count(*) OVER () AS n FROM documents)
    """,
)
def split_exact(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return prep.split(docs, key="doc_id", exact=True)


_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey")


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
        CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS p50,
        CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in _NUMERIC
    ),
)
def describe_numeric(spark, folder):
    lines = datasets.spread(table(spark, folder, "lineitem").select(*_NUMERIC))
    stats = profile.describe_numeric(lines, columns=_NUMERIC)
    return stats.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


_TEXTUAL = ("o_orderstatus", "o_orderpriority", "o_custkey")


@query(
    "describe_categorical",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS unique,
        arg_min(v, (-n, v)) AS top, max(n) AS freq
        FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM orders GROUP BY 1)"""
        for c in _TEXTUAL
    ),
)
def describe_categorical(spark, folder):
    return profile.describe_categorical(table(spark, folder, "orders"), columns=_TEXTUAL)


_NULLABLE = ("c_custkey", "c_name", "c_acctbal", "o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "missing_counts",
    "WITH j AS (SELECT * FROM customer LEFT JOIN orders ON c_custkey = o_custkey) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM j"
        for c in _NULLABLE
    ),
)
def missing_counts(spark, folder):
    customer, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    joined = customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return profile.missing(joined.select(*_NULLABLE))


STRIP_SQL = r"regexp_replace({0}, '^[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+|[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+$', '', 'g')"


@query(
    "text_blocks",
    f"""
    WITH pieces AS (
      SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
    lines AS (
      SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) AS i FROM pieces),
    kept AS (SELECT doc_id, i, {STRIP_SQL.format("raw")} AS text FROM lines)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS block, text
    FROM kept WHERE text <> ''
    """,
)
def text_blocks(spark, folder):
    return prep.text_blocks(texts(spark, folder, "documents"), key="doc_id", text_col="text")


@query(
    "assemble_prompts",
    """
    SELECT conv_id,
           string_agg(role || ': ' || text, chr(10) ORDER BY turn) || chr(10) || 'assistant:' AS prompt
    FROM conversations GROUP BY conv_id
    """,
)
def assemble_prompts(spark, folder):
    return prep.assemble_prompts(
        table(spark, folder, "conversations"),
        conversation="conv_id",
        turn="turn",
        role="role",
        text="text",
    )


@query(
    "rolling_stats",
    f"""
    WITH {SERIES_SQL}
    SELECT series_id, event_id, round(m, 6) AS rolling_mean, round(s, 6) AS rolling_std FROM (
      SELECT series_id, event_id, pos, avg(value) OVER w AS m, stddev_pop(value) OVER w AS s
      FROM series WINDOW w AS (PARTITION BY series_id ORDER BY pos ROWS 6 PRECEDING))
    WHERE pos >= 6
    """,
)
def rolling_stats(spark, folder):
    stats = timeseries.rolling(derived.series(spark, folder), **SERIES)
    return stats.select(
        "series_id",
        "event_id",
        F.round("rolling_mean", 6).alias("rolling_mean"),
        F.round("rolling_std", 6).alias("rolling_std"),
    )


_FORECASTS = {
    "last": "max_by(value, pos)",
    "mean": "avg(value)",
    "drift": "max_by(value, pos) + (max_by(value, pos) - min_by(value, pos)) / greatest(count(*) - 1, 1) * step",
}


def _forecast(method: str, level: str) -> None:
    @query(
        f"forecast_{method}",
        f"""
        WITH {SERIES_SQL}
        SELECT series_id, CAST(step AS INTEGER) AS step, round({level}, 6) AS forecast
        FROM series, range(1, 6) r(step) GROUP BY series_id, step
        """,
    )
    def run(spark, folder):
        out = timeseries.forecast(derived.series(spark, folder), **SERIES, method=method)
        return out.withColumn("forecast", F.round("forecast", 6))


for _method, _level in _FORECASTS.items():
    _forecast(_method, _level)


ANOMALIES_SQL = """
    WITH s AS (SELECT user_id, avg(value) AS m, stddev_pop(value) AS d FROM events GROUP BY user_id)
    SELECT e.user_id AS series_id, event_id, value, round((value - m) / (d + 1e-9), 6) AS z
    FROM events e JOIN s ON e.user_id = s.user_id WHERE abs((value - m) / (d + 1e-9)) > 3.0
"""


@query("anomalies_z", ANOMALIES_SQL)
def anomalies_z(spark, folder):
    found = timeseries.anomalies(
        derived.series(spark, folder), series=["series_id"], value="value", carry=["event_id"]
    )
    return found.withColumn("z", F.round("z", 6)).select("series_id", "event_id", "value", "z")


def _resample(method: str, level: str) -> None:
    @query(
        f"resample_{method}",
        f"""
        WITH {SERIES_SQL}
        SELECT series_id, pos // 4 AS block, round({level}(value), 6) AS resampled
        FROM series GROUP BY series_id, pos // 4 HAVING count(*) = 4
        """,
    )
    def run(spark, folder):
        out = timeseries.resample(
            derived.series(spark, folder), **SERIES, factor=4, method=method
        )
        return out.withColumn("resampled", F.round("resampled", 6))


for _method, _level in {"mean": "avg", "median": "median"}.items():
    _resample(_method, _level)


@query(
    "dataset_filter",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24
    """,
)
def dataset_filter(spark, folder):
    kept = datasets.filter_dataset(
        table(spark, folder, "lineitem"),
        "l_shipdate >= timestamp_ntz '1998-01-01' and l_discount between 0.05 and 0.07 and l_quantity < 24",
    )
    return kept.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "dataset_map",
    """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net,
           year(l_shipdate) AS ship_year FROM lineitem
    """,
)
def dataset_map(spark, folder):
    mapped = datasets.map_dataset(
        table(spark, folder, "lineitem"),
        {"net": "round(l_extendedprice * (1 - l_discount), 4)", "ship_year": "year(l_shipdate)"},
    )
    return mapped.select("l_orderkey", "l_linenumber", "net", "ship_year")


@query(
    "dataset_publish",
    """
    SELECT count(*) AS num_rows,
           CAST(sum(('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
             o_orderpriority, o_orderstatus)), 1, 8))::BIGINT) AS BIGINT) AS content_hash,
           'o_orderkey,o_custkey,o_orderpriority,o_orderstatus' AS columns
    FROM orders
    """,
)
def dataset_publish(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"
    )
    return datasets.publish(
        orders, scratch_path(spark, "published"), partition_by=["o_orderstatus"]
    )
