"""Tables derived from the driver's tables, once for Spark and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.workload.registry import table, texts

# SQL common table expressions, named as the functions below.
SERIES_SQL = """
series AS (
  SELECT user_id AS series_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
         ts, event_id, value
  FROM events)
"""

EDGES_SQL = """
edges AS (
  SELECT DISTINCT 'P' || l_partkey AS src, 'S' || l_suppkey AS dst, 'supplied_by' AS relation FROM lineitem
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, 'in' FROM customer
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, 'in' FROM nation)
"""

CYCLE_EDGES_SQL = """
edges AS (
  SELECT DISTINCT 'P' || l_partkey AS src, 'S' || l_suppkey AS dst FROM lineitem
  UNION ALL SELECT DISTINCT 'S' || l_suppkey, 'P' || l_partkey FROM lineitem WHERE l_quantity > 40)
"""

PAIRS_SQL = """
pairs AS (
  SELECT a.conv_id || ':' || a.turn AS pair_id, a.text AS prediction, b.text AS reference
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
"""

CLASS_PAIRS_SQL = """
class_pairs AS (
  SELECT d.doc_id, CAST(quality AS VARCHAR) AS y_true,
         CASE WHEN n_chars >= 200 THEN '1' WHEN n_chars >= 60 THEN '0' ELSE 'short' END AS y_pred
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""

FLAG_PAIRS_SQL = """
flag_pairs AS (
  SELECT l_returnflag AS y_true,
         CASE WHEN l_linestatus = 'O' AND l_quantity > 25 THEN 'N' WHEN l_discount > 0.05 THEN 'R' ELSE 'A' END AS y_pred
  FROM lineitem)
"""

WRITES_SQL = """
writes AS (
  SELECT CAST(user_id AS VARCHAR) AS key, event_type AS value,
         CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 5 AS VARCHAR) AS tag, ts, event_id AS seq
  FROM events)
"""


def series(spark: SparkSession, folder: str) -> DataFrame:
    """Events by user: (series_id, ts, event_id, value)."""
    events = table(spark, folder, "events")
    return events.select(F.col("user_id").alias("series_id"), "ts", "event_id", "value")


def graph_nodes(spark: SparkSession, folder: str) -> DataFrame:
    parts = []
    for name, letter, key, label in (
        ("part", "P", "p_partkey", "p_name"),
        ("supplier", "S", "s_suppkey", "s_name"),
        ("customer", "C", "c_custkey", "c_name"),
        ("nation", "N", "n_nationkey", "n_name"),
        ("region", "R", "r_regionkey", "r_name"),
    ):
        parts.append(
            table(spark, folder, name).select(
                F.concat(F.lit(letter), F.col(key)).alias("id"),
                F.col(label).alias("label"),
                F.create_map(F.lit("kind"), F.lit(name)).alias("attrs"),
            )
        )
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    return nodes


def graph_edges(spark: SparkSession, folder: str) -> DataFrame:
    supplied = (
        table(spark, folder, "lineitem")
        .select("l_partkey", "l_suppkey")
        .distinct()
        .select(
            F.concat(F.lit("P"), "l_partkey").alias("src"),
            F.concat(F.lit("S"), "l_suppkey").alias("dst"),
            F.lit("supplied_by").alias("relation"),
        )
    )
    customers = table(spark, folder, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("src"),
        F.concat(F.lit("N"), "c_nationkey").alias("dst"),
        F.lit("in").alias("relation"),
    )
    nations = table(spark, folder, "nation").select(
        F.concat(F.lit("N"), "n_nationkey").alias("src"),
        F.concat(F.lit("R"), "n_regionkey").alias("dst"),
        F.lit("in").alias("relation"),
    )
    return supplied.unionByName(customers).unionByName(nations)


def cycle_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Part to supplier for every pair, and back where a line holds more than 40."""
    lines = table(spark, folder, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("part"),
        F.concat(F.lit("S"), "l_suppkey").alias("supplier"),
        "l_quantity",
    )
    there = lines.select(F.col("part").alias("src"), F.col("supplier").alias("dst")).distinct()
    back = (
        lines.where("l_quantity > 40")
        .select(F.col("supplier").alias("src"), F.col("part").alias("dst"))
        .distinct()
    )
    return there.unionByName(back)


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each turn next to the one after it; turns are numbered without gaps."""
    turns = texts(spark, folder, "conversations")
    following = turns.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference")
    )
    return turns.join(following, ["conv_id", "turn"]).select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias(
            "pair_id"
        ),
        F.col("text").alias("prediction"),
        "reference",
    )


def class_pairs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        "doc_id",
        F.col("quality").cast("string").alias("y_true"),
        F.when(F.col("n_chars") >= 200, "1")
        .when(F.col("n_chars") >= 60, "0")
        .otherwise("short")
        .alias("y_pred"),
    )


def flag_pairs(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    rule = (
        F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 25), "N")
        .when(F.col("l_discount") > 0.05, "R")
        .otherwise("A")
    )
    return lines.select(F.col("l_returnflag").alias("y_true"), rule.alias("y_pred"))


def writes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as keyed writes with one tag each."""
    events = table(spark, folder, "events")
    tag = F.get_json_object("props", "$.k").cast("long") % 5
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.col("event_type").alias("value"),
        F.array(tag.cast("string")).alias("tags"),
        "ts",
        F.col("event_id").alias("seq"),
    )
