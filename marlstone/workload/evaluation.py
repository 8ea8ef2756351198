"""Queries over prediction pairs, keyed state, episodes and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.functions.text import WHITE
from marlstone.operators import graph, metrics, rl, state
from marlstone.plans.durable import scratch_path
from marlstone.workload import derived
from marlstone.workload.derived import (
    CLASS_PAIRS_SQL,
    CYCLE_EDGES_SQL,
    EDGES_SQL,
    FLAG_PAIRS_SQL,
    PAIRS_SQL,
    SERIES_SQL,
    WRITES_SQL,
)
from marlstone.workload.registry import query, table

CLASSES = {"truth": "y_true", "prediction": "y_pred"}
PAIRS = {"prediction": "prediction", "reference": "reference"}


@query(
    "accuracy",
    f"""
    WITH {CLASS_PAIRS_SQL}
    SELECT round(count(*) FILTER (WHERE trim(y_true) = trim(y_pred)) / count(*), 6) AS accuracy,
           count(*) FILTER (WHERE trim(y_true) = trim(y_pred)) AS correct, count(*) AS total
    FROM class_pairs
    """,
)
def accuracy(spark, folder):
    out = metrics.accuracy(
        derived.class_pairs(spark, folder), prediction="y_pred", reference="y_true"
    )
    return out.withColumn("accuracy", F.round("accuracy", 6))


def _thirteen_a(column: str) -> str:
    line = f"regexp_replace({column}, '{WHITE}+$', '')"
    for raw, plain in (
        ("'<skipped>'", "''"), ("'-' || chr(10)", "''"), ("chr(10)", "' '"), ("'&quot;'", "'\"'"),
        ("'&amp;'", "'&'"), ("'&lt;'", "'<'"), ("'&gt;'", "'>'"),
    ):
        line = f"replace({line}, {raw}, {plain})"
    line = f"concat(' ', {line}, ' ')"
    for pattern, put in (
        (r"([\{-~\[-` -&\(-\+:-@/])", r" \1 "),
        (r"([^0-9])([.,])", r"\1 \2 "),
        (r"([.,])([^0-9])", r" \1 \2"),
        (r"([0-9])(-)", r"\1 \2 "),
    ):
        line = f"regexp_replace({line}, '{pattern}', '{put}', 'g')"
    return f"list_filter(string_split_regex({line}, '{WHITE}+'), lambda t: t <> '')"


def _grams_sql(orders, tokens: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT pair_id, side, {n} AS n, unnest(list_transform(range(1, len({tokens}) - {n} + 2),
        lambda i: array_to_string({tokens}[i:i + {n} - 1], ' '))) AS gram FROM sides"""
        for n in orders
    )


def _overlap_sql(orders, tokenizer) -> str:
    return f"""
    WITH {PAIRS_SQL},
    sides AS (
      SELECT pair_id, 'p' AS side, {tokenizer('prediction')} AS t FROM pairs
      UNION ALL SELECT pair_id, 'r', {tokenizer('reference')} FROM pairs),
    grams AS ({_grams_sql(orders, 't')}),
    counts AS (SELECT pair_id, n, gram, count(*) FILTER (WHERE side = 'p') AS p,
                      count(*) FILTER (WHERE side = 'r') AS r FROM grams GROUP BY pair_id, n, gram),
    hits AS (SELECT pair_id, n, sum(least(p, r)) AS m, sum(p) AS p, sum(r) AS r FROM counts GROUP BY pair_id, n)
    """


@query(
    "bleu",
    _overlap_sql((1, 2, 3, 4), _thirteen_a)
    + """,
    sums AS (SELECT n, sum(m) AS m, sum(p) AS total FROM hits GROUP BY n),
    halved AS (SELECT *, sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) OVER (ORDER BY n) AS k FROM sums),
    prec AS (SELECT n, CASE WHEN m = 0 THEN 100.0 / (pow(2, k) * total) ELSE 100.0 * m / total END AS p FROM halved),
    lens AS (SELECT sum(len(t)) FILTER (WHERE side = 'p') AS pl, sum(len(t)) FILTER (WHERE side = 'r') AS rl FROM sides),
    bp AS (SELECT pl, rl, CASE WHEN pl >= rl THEN 1.0::DOUBLE ELSE exp(1 - rl / pl) END AS bp FROM lens)
    SELECT round(bp * exp((SELECT avg(ln(p)) FROM prec)), 6) AS bleu,
           round((SELECT p FROM prec WHERE n = 1), 6) AS p1, round((SELECT p FROM prec WHERE n = 2), 6) AS p2,
           round((SELECT p FROM prec WHERE n = 3), 6) AS p3, round((SELECT p FROM prec WHERE n = 4), 6) AS p4,
           round(bp, 6) AS bp, CAST(pl AS BIGINT) AS pred_len, CAST(rl AS BIGINT) AS ref_len FROM bp
    """,
)
def bleu(spark, folder):
    out = metrics.bleu(derived.pairs(spark, folder), **PAIRS)
    return out.withColumns({c: F.round(c, 6) for c in ("bleu", "p1", "p2", "p3", "p4", "bp")})


def _rouge_tokens(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '[a-z0-9]+')"


@query(
    "rouge_n",
    _overlap_sql((1, 2), _rouge_tokens)
    + """,
    scored AS (
      SELECT pairs.pair_id, h.n, CASE WHEN coalesce(p + r, 0) = 0 THEN 0 ELSE 2.0 * m / (p + r) END AS f
      FROM pairs CROSS JOIN (VALUES (1), (2)) o(n) LEFT JOIN hits h ON h.pair_id = pairs.pair_id AND h.n = o.n),
    size AS (SELECT count(*) AS pairs FROM pairs)
    SELECT round(coalesce(sum(f) FILTER (WHERE n = 1), 0) / any_value(pairs), 6) AS rouge1,
           round(coalesce(sum(f) FILTER (WHERE n = 2), 0) / any_value(pairs), 6) AS rouge2 FROM scored, size
    """,
)
def rouge_n(spark, folder):
    """Unstemmed, so that SQL can follow."""
    out = metrics.rouge(
        derived.pairs(spark, folder), **PAIRS, stem=False, kinds=("rouge1", "rouge2")
    )
    return out.withColumns({c: F.round(c, 6) for c in out.columns})


@query("rouge_l")
def rouge_l(spark, folder):
    """All three kinds on stemmed tokens."""
    out = metrics.rouge(derived.pairs(spark, folder), **PAIRS)
    return out.withColumns({c: F.round(c, 6) for c in out.columns})


REPORT_SQL = f"""
    WITH {FLAG_PAIRS_SQL},
    labels_seen AS (SELECT y_true AS label FROM flag_pairs UNION SELECT y_pred FROM flag_pairs),
    counts AS (
      SELECT label, count(*) FILTER (WHERE y_true = label AND y_pred = label) AS tp,
             count(*) FILTER (WHERE y_true <> label AND y_pred = label) AS fp,
             count(*) FILTER (WHERE y_true = label AND y_pred <> label) AS fn
      FROM labels_seen, flag_pairs GROUP BY label),
    rated AS (SELECT label, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r,
                     tp, tp + fn AS support FROM counts),
    report AS (SELECT label, p, r, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1, tp, support FROM rated)
"""


@query(
    "class_report",
    REPORT_SQL
    + """SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM report""",
)
def class_report(spark, folder):
    rows = metrics.class_report(derived.flag_pairs(spark, folder), **CLASSES).drop("tp", "predicted")
    return rows.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "class_report_avg",
    REPORT_SQL
    + """, one AS (
      SELECT sum(tp) / sum(support) AS acc, CAST(sum(support) AS BIGINT) AS support, avg(p) AS p, avg(r) AS r,
             avg(f1) AS f1, sum(p * support) / sum(support) AS wp, sum(r * support) / sum(support) AS wr,
             sum(f1 * support) / sum(support) AS wf FROM report)
    SELECT 'accuracy' AS average, round(acc, 6) AS precision, round(acc, 6) AS recall, round(acc, 6) AS f1, support FROM one
    UNION ALL SELECT 'macro avg', round(p, 6), round(r, 6), round(f1, 6), support FROM one
    UNION ALL SELECT 'weighted avg', round(wp, 6), round(wr, 6), round(wf, 6), support FROM one
    """,
)
def class_report_avg(spark, folder):
    rows = metrics.report_averages(derived.flag_pairs(spark, folder), **CLASSES)
    return rows.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "f1_scores",
    REPORT_SQL
    + """SELECT round(avg(f1), 6) AS macro_f1, round(sum(tp) / sum(support), 6) AS micro_f1,
         round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM report""",
)
def f1_scores(spark, folder):
    rows = metrics.f1_scores(derived.flag_pairs(spark, folder), **CLASSES)
    return rows.withColumns({c: F.round(c, 6) for c in rows.columns})


# --- keyed state -------------------------------------------------------------------------------

LATEST_SQL = f"""
    WITH {WRITES_SQL},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, seq DESC) AS r FROM writes),
    latest AS (SELECT key, value, tag, seq FROM ranked WHERE r = 1)
"""


def _state(spark, folder):
    log = state.write(None, derived.writes(spark, folder))
    return state.latest(log, key="key", order_by=["ts", "seq"])


def _flat(df):
    return df.withColumn("tag", F.element_at("tags", 1)).drop("tags", "ts")


@query("state_latest", LATEST_SQL + "SELECT key, value, tag, seq FROM latest")
def state_latest(spark, folder):
    return _flat(_state(spark, folder))


@query(
    "state_lookup",
    LATEST_SQL
    + """SELECT CAST(c_custkey AS VARCHAR) AS key, value, seq, key IS NOT NULL AS found
         FROM customer LEFT JOIN latest ON key = CAST(c_custkey AS VARCHAR)""",
)
def state_lookup(spark, folder):
    """Every customer key looked up in the users' state."""
    keys = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    return state.lookup(_state(spark, folder), keys, key="key").select("key", "value", "seq", "found")


@query("state_by_tag", LATEST_SQL + "SELECT key, value, tag, seq FROM latest WHERE tag = '3'")
def state_by_tag(spark, folder):
    return _flat(state.by_tag(_state(spark, folder), "3"))


@query(
    "notes_indexed",
    """
    SELECT conv_id, turn, role, row_number() OVER (ORDER BY conv_id, turn) - 1 AS index FROM conversations
    """,
)
def notes_indexed(spark, folder):
    notes = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    return state.index_notes(notes, order_by=["conv_id", "turn"])


@query(
    "notes_recent",
    "SELECT conv_id, turn, role FROM conversations ORDER BY conv_id DESC, turn DESC LIMIT 20",
)
def notes_recent(spark, folder):
    notes = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    return state.recent(notes, order_by=["conv_id", "turn"], limit=20)


@query(
    "state_after_clear",
    f"""
    WITH {WRITES_SQL},
    mark AS (SELECT ts, seq FROM writes WHERE value = 'error' AND tag = '0' ORDER BY ts DESC, seq DESC LIMIT 1),
    alive AS (SELECT w.* FROM writes w, mark m
              WHERE (w.ts, w.seq) > (m.ts, m.seq) AND NOT (w.value = 'error' AND w.tag = '0')),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, seq DESC) AS r FROM alive)
    SELECT key, value, tag, seq FROM ranked WHERE r = 1
    """,
)
def state_after_clear(spark, folder):
    """Errors tagged 0 stand for clearing."""
    log = derived.writes(spark, folder)
    cleared = (F.col("value") == "error") & F.array_contains("tags", "0")
    alive = state.after_clear(log, cleared=cleared, order_by=["ts", "seq"])
    return _flat(state.latest(alive, key="key", order_by=["ts", "seq"]))


@query(
    "event_trace",
    """
    SELECT user_id, event_id, event_type,
           row_number() OVER w - 1 AS pos,
           round((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000.0, 6) AS gap_seconds
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def event_trace(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    traced = state.trace(events, actor="user_id", order_by=["ts", "event_id"], time="ts")
    return traced.withColumn("gap_seconds", F.round("gap_seconds", 6)).drop("ts")


# --- episodes ------------------------------------------------------------------------------------

STEPS = {"episode": "series_id", "order_by": ["ts", "event_id"], "reward": "value"}


@query(
    "discounted_returns",
    f"""
    WITH {SERIES_SQL}
    SELECT a.series_id, a.event_id, a.pos AS t, round(sum(b.value * pow(0.99, b.pos - a.pos)), 6) AS discounted_return
    FROM series a JOIN series b ON a.series_id = b.series_id AND b.pos >= a.pos
    GROUP BY a.series_id, a.event_id, a.pos
    """,
)
def discounted_returns(spark, folder):
    out = rl.returns(derived.series(spark, folder), **STEPS)
    return out.select(
        "series_id", "event_id", "t", F.round("discounted_return", 6).alias("discounted_return")
    )


@query(
    "episode_returns",
    f"""
    WITH {SERIES_SQL}
    SELECT series_id, round(sum(value), 6) AS total, count(*) AS steps FROM series WHERE pos < 50 GROUP BY series_id
    """,
)
def episode_returns(spark, folder):
    out = rl.rollout(derived.series(spark, folder), **STEPS, max_steps=50)
    return out.withColumn("total", F.round("total", 6))


@query(
    "policy_eval",
    """
    WITH episodes AS (
      SELECT user_id, event_type AS policy, sum(value) AS total FROM events GROUP BY user_id, event_type)
    SELECT policy, round(avg(total), 6) AS mean_return, round(stddev_pop(total), 6) AS std_return, count(*) AS episodes
    FROM episodes GROUP BY policy
    """,
)
def policy_eval(spark, folder):
    """Each user's events of one type as an episode of that policy."""
    events = table(spark, folder, "events")
    episodes = (
        events.groupBy("user_id", F.col("event_type").alias("policy")).agg(F.sum("value").alias("total"))
    )
    out = rl.evaluate(episodes, policy=["policy"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean_return", "std_return")})


# --- graphs --------------------------------------------------------------------------------------


@query(
    "graph_upsert_nodes",
    """
    SELECT 'C' || c_custkey AS id, CASE WHEN c_acctbal < 0 THEN upper(c_name) ELSE c_name END AS label,
           CASE WHEN c_acctbal < 0 THEN 'debtor' ELSE 'customer' END AS kind FROM customer
    """,
)
def graph_upsert_nodes(spark, folder):
    customers = table(spark, folder, "customer")
    identity = F.concat(F.lit("C"), "c_custkey").alias("id")

    def nodes(label, kind, rows):
        return rows.select(
            identity, label.alias("label"), F.create_map(F.lit("kind"), F.lit(kind)).alias("attrs")
        )

    old = nodes(F.col("c_name"), "customer", customers)
    new = nodes(F.upper("c_name"), "debtor", customers.where("c_acctbal < 0"))
    merged = graph.upsert_nodes(old, new, order_by=["label"])
    return merged.select("id", "label", F.element_at("attrs", "kind").alias("kind"))


@query(
    "graph_edge_counts",
    f"WITH {EDGES_SQL} SELECT relation, count(*) AS edges FROM edges GROUP BY relation",
)
def graph_edge_counts(spark, folder):
    return graph.edge_counts(graph.add_edges(None, derived.graph_edges(spark, folder)))


def _neighbors(direction: str, here: str, there: str) -> None:
    @query(
        f"neighbors_{direction}",
        f"""
        WITH {EDGES_SQL},
        asked AS (SELECT 'P' || p_partkey AS node FROM part WHERE p_size > 25
                  UNION ALL SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal > 0
                  UNION ALL SELECT 'N' || n_nationkey FROM nation)
        SELECT {here} AS node, {there} AS neighbor, relation FROM edges JOIN asked ON {here} = node
        """,
    )
    def run(spark, folder):
        asked = (
            table(spark, folder, "part")
            .where("p_size > 25")
            .select(F.concat(F.lit("P"), "p_partkey").alias("node"))
            .unionByName(
                table(spark, folder, "supplier")
                .where("s_acctbal > 0")
                .select(F.concat(F.lit("S"), "s_suppkey").alias("node"))
            )
            .unionByName(
                table(spark, folder, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("node"))
            )
        )
        return graph.neighbors(derived.graph_edges(spark, folder), asked, direction=direction)


_neighbors("out", "src", "dst")
_neighbors("in", "dst", "src")


@query(
    "graph_degrees",
    f"""
    WITH {EDGES_SQL},
    nodes AS (SELECT 'P' || p_partkey AS id FROM part UNION ALL SELECT 'S' || s_suppkey FROM supplier
              UNION ALL SELECT 'C' || c_custkey FROM customer UNION ALL SELECT 'N' || n_nationkey FROM nation
              UNION ALL SELECT 'R' || r_regionkey FROM region),
    o AS (SELECT src AS id, count(*) AS n FROM edges GROUP BY src),
    i AS (SELECT dst AS id, count(*) AS n FROM edges GROUP BY dst)
    SELECT nodes.id, coalesce(o.n, 0) AS out_degree, coalesce(i.n, 0) AS in_degree
    FROM nodes LEFT JOIN o ON nodes.id = o.id LEFT JOIN i ON nodes.id = i.id
    """,
)
def graph_degrees(spark, folder):
    return graph.degrees(derived.graph_nodes(spark, folder), derived.graph_edges(spark, folder))


@query("graph_export", f"WITH {EDGES_SQL} SELECT src AS source, dst AS target, relation FROM edges")
def graph_export(spark, folder):
    path = scratch_path(spark, "graph")
    graph.export(derived.graph_nodes(spark, folder), derived.graph_edges(spark, folder), path)
    return spark.read.parquet(f"{path}/edges")


@query(
    "bfs_distance",
    f"""
    WITH RECURSIVE {CYCLE_EDGES_SQL},
    walk(node, depth) AS (
      SELECT 'S' || min(s_suppkey), 0 FROM supplier
      UNION SELECT dst, depth + 1 FROM walk JOIN edges ON node = src WHERE depth < 40)
    SELECT node, min(depth) AS depth FROM walk GROUP BY node
    """,
)
def bfs_distance(spark, folder):
    """Hops from the first supplier through parts and suppliers."""
    first = table(spark, folder, "supplier").agg(
        F.concat(F.lit("S"), F.min("s_suppkey")).alias("node")
    )
    return graph.distances(derived.cycle_edges(spark, folder), first)


@query(
    "shortest_path",
    f"""
    WITH RECURSIVE {EDGES_SQL},
    pairs AS (SELECT c_custkey AS pair_id, 'C' || c_custkey AS source, 'R' || (c_custkey % 7) AS target FROM customer),
    walk(pair_id, node, path, depth) AS (
      SELECT pair_id, source, source, 0 FROM pairs
      UNION ALL SELECT pair_id, dst, path || '>' || dst, depth + 1 FROM walk JOIN edges ON node = src)
    SELECT p.pair_id, CASE WHEN CAST(substr(target, 2) AS INTEGER) > 4 THEN 'missing'
                           WHEN path IS NULL THEN 'no path' ELSE 'found' END AS status,
           CAST(depth AS INTEGER) AS length, path
    FROM pairs p LEFT JOIN walk w ON p.pair_id = w.pair_id AND w.node = p.target
    """,
)
def shortest_path(spark, folder):
    """Every customer to a region, some of them not its own and some not declared."""
    pairs = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("pair_id"),
        F.concat(F.lit("C"), "c_custkey").alias("source"),
        F.concat(F.lit("R"), (F.col("c_custkey") % 7).cast("string")).alias("target"),
    )
    found = graph.shortest_paths(
        derived.graph_nodes(spark, folder), derived.graph_edges(spark, folder), pairs
    )
    return found.select("pair_id", "status", "length", F.array_join("path", ">").alias("path"))
