"""Merkle trees over the rows of each source, a root over all sources, and what each row needs to prove itself.

Time-forward processing: a digest is a message to the node above, and the queue of messages is ordered by node
label, level first, then tree and place. All messages of the least level are taken at once, meet at their parents
by a shuffle on the parent's label, and what the parents send is written to the shared folder for the next turn.
A turn has a sixteenth of the messages of the one before, so the queue holds little more than the leaves, and a
parent never gets more than ``FAN`` messages however large its tree is. The sweep back takes the same tables from the
last to the first: each node hands what lies above it to the nodes that had sent to it, so that a leaf receives
the rest of its proof with the run of siblings it belongs to, once per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.numbering import numbered
from marlstone.plans.durable import durable
from marlstone.plans.joins import attach

FAN = 16
_HEX = 64


def framed(value: Column) -> Column:
    """``-`` for null, else the byte count, ``:`` and the value; so no two rows write the same text."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest_of(values: Sequence[Column]) -> Column:
    """SHA-256 of the values one after another, as lowercase hex."""
    return F.sha2(F.concat(*map(framed, values)).cast("binary"), 256)


def build(nodes: DataFrame, payload: Sequence[str] = ()) -> list[DataFrame]:
    """The written turns of the queue, leaves first.

    ``nodes`` has ``tree``, ``place`` (gapless from 0 in its tree), ``n`` (nodes in its tree) and ``digest``. A row of
    a turn is a run of up to ``FAN`` nodes of one tree: ``tree``, ``place`` of the node above, ``lone`` (the tree had
    but one node, which stays as it is), ``run`` (the digests one after another), ``digest`` of the node above and ``n``
    (nodes of the tree on that level). The first turn also keeps ``children`` with each leaf's slot and payload.
    """
    most = nodes.agg(F.max("n")).first()[0] or 1
    turns: list[DataFrame] = []
    while not turns or most > 1:
        sent = F.struct((F.col("place") % FAN).cast("int").alias("slot"), "digest", *([] if turns else payload))
        runs = nodes.groupBy("tree", F.expr(f"place div {FAN}").alias("place"), "n").agg(
            F.array_sort(F.collect_list(sent)).alias("children")
        )
        run = F.array_join(F.transform("children", lambda c: c["digest"]), "")
        runs = runs.withColumn("run", run).select(
            "tree",
            "place",
            (F.col("n") == 1).alias("lone"),
            "run",
            F.when(F.col("n") == 1, F.col("run")).otherwise(F.sha2(F.col("run").cast("binary"), 256)).alias("digest"),
            F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
            *([] if turns else ["children"]),
        )
        turns.append(durable(runs))
        nodes = turns[-1].where("n > 1")
        most = -(-most // FAN)
    return turns


def deliver(turns: Sequence[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """The first turn with ``path``, the runs above each of its runs' nodes from below to the top, and ``top``, ``root``.

    A step of a path has the ``slot`` that the node takes in ``run``. ``above`` has ``tree``, ``path``, ``top`` and ``root``
    for the trees' own tops; without it these are the roots.
    """
    carried = None
    for turn in reversed(turns):
        ends = turn.where("n = 1")
        if above is None:
            path = F.array().cast("array<struct<slot:int,run:string>>")
            ends = ends.withColumns({"path": path, "top": F.col("digest"), "root": F.col("digest")})
        else:
            ends = ends.join(above, "tree")
        if carried is not None:
            higher = carried.select(
                "tree", F.col("place").alias("up"), F.col("run").alias("up_run"), F.col("path").alias("up_path"), "top", "root"
            )
            inner = turn.where("n > 1").withColumn("up", F.expr(f"place div {FAN}")).join(higher, ["tree", "up"])
            step = F.struct((F.col("place") % FAN).cast("int").alias("slot"), F.col("up_run").alias("run"))
            inner = inner.withColumn("path", F.concat(F.array(step), "up_path"))
            ends = ends.unionByName(inner.drop("up", "up_run", "up_path"))
        carried = durable(ends)
    return carried


def _before(run: Column, slot: Column) -> Column:
    return F.substring(run, F.lit(1), slot * _HEX)


def _after(run: Column, slot: Column) -> Column:
    return F.substring(run, slot * _HEX + _HEX + 1, F.lit(FAN * _HEX))


def siblings(run: Column, slot: Column) -> Column:
    return F.concat(_before(run, slot), _after(run, slot))


def folded(digest: Column, path: Column) -> Column:
    """The root that ``digest`` and the siblings of ``path`` give."""

    def up(own: Column, step: Column) -> Column:
        whole = F.concat(_before(step["run"], step["slot"]), own, _after(step["run"], step["slot"]))
        return F.sha2(whole.cast("binary"), 256)

    return F.aggregate(path, digest, up)


def _own_path(child: Column) -> Column:
    """The whole path of a leaf: its run, unless it is alone in its tree, and what lies above."""
    step = F.struct(child["slot"].alias("slot"), F.col("run").alias("run"))
    return F.when(F.col("lone"), F.col("path")).otherwise(F.concat(F.array(step), F.col("path")))


def manifest(leaves: DataFrame) -> DataFrame:
    """One row per leaf: ``doc_id``, ``leaf``, ``subroot`` of its source, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    ``leaves`` has ``doc_id``, ``source``, ``leaf`` and ``claimed``, the digest that is folded up the leaf's siblings;
    ``verified`` says whether that gives the root. Leaves ascend by ``doc_id`` in their source, null first; rows that
    tie follow their digests, and equal rows are told apart by place only. A null source is a source of its own,
    before all others. An empty table gives no rows. Sources may be as many or as large as they like: places come
    from one sort of all rows, cut into ranges.
    """
    keyed = leaves.withColumn("tree", framed(F.col("source")))
    placed = numbered(keyed, [F.col("source"), F.col("doc_id"), F.col("leaf"), F.col("claimed")], "at")
    starts = placed.groupBy("tree").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"), F.first("source").alias("named"))
    nodes = attach(placed, starts, ["tree"], how="inner")
    nodes = nodes.select("tree", (F.col("at") - F.col("start")).alias("place"), "n", F.col("leaf").alias("digest"), "doc_id", "claimed", "named")
    turns = build(nodes, ["doc_id", "claimed", "named"])

    tops = [t.where("n = 1").select("tree", "digest") for t in turns]
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionByName(more)
    named = turns[0].where("place = 0").select("tree", F.col("children")[0]["named"].alias("source"))
    sources = numbered(subroots.join(named, "tree").withColumnRenamed("tree", "key"), [F.col("source")], "place")
    over = sources.select(F.lit("").alias("tree"), "place", F.lit(sources.count()).cast("long").alias("n"), "digest", "key")
    inner = deliver(build(over, ["key"])).withColumn("child", F.explode("children"))
    above = inner.select(F.col("child.key").alias("tree"), _own_path(F.col("child")).alias("path"), F.col("child.digest").alias("top"), "root")

    runs = deliver(turns, durable(above))
    rest = F.array_join(F.transform("path", lambda s: siblings(s["run"], s["slot"])), "")

    def proven(child: Column) -> Column:
        own = F.when(F.col("lone"), "").otherwise(siblings(F.col("run"), child["slot"]))
        return F.struct(
            child["doc_id"].alias("doc_id"),
            child["digest"].alias("leaf"),
            F.sha2(F.concat(own, F.col("rest")).cast("binary"), 256).alias("proof_sha256"),
            folded(child["claimed"], _own_path(child)).alias("folded_root"),
        )

    rows = runs.withColumn("rest", rest).select("top", "root", F.explode(F.transform("children", proven)).alias("row"))
    return rows.select(
        "row.doc_id",
        "row.leaf",
        F.col("top").alias("subroot"),
        "root",
        "row.proof_sha256",
        "row.folded_root",
        (F.col("row.folded_root") == F.col("root")).alias("verified"),
    )


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """``doc_id``, ``source``, ``leaf`` and ``claimed``: the digest of the row, and with A-Z of its text lower-cased where ``tampered``.

    Whole texts are read however long, in place; only digests move on. Columns other than ``doc_id``, ``source``,
    ``lang``, ``n_chars`` and ``text`` are not read.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = digest_of(columns)
    claimed = F.when(F.coalesce(tampered, F.lit(False)), digest_of([*columns[:-1], lower])).otherwise(leaf)
    return docs.select("doc_id", "source", leaf.alias("leaf"), claimed.alias("claimed"))
