"""The registered query of each operator over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import (
    chunk_dedup,
    decontaminate,
    feistel,
    filter_audit,
    jaccard,
    kneser_ney,
    line_dedup,
    merkle,
    packing,
    surrogates,
    token_files,
    topk_search,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/benchmark.parquet")


def query(fn=None, *, sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register(fn) if fn else register


@query
def op3_feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    sized = documents(spark, folder).select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    placed = feistel.shard(sized, order=order, shards=8, key="shuffle-1")
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs, path=tokenizer_path("byte_bpe_50k.json"), capacity=2048, end=0)


@query
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(documents(spark, folder))


@query
def op5_arrow_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    files = token_files.write_token_files(docs, path=tokenizer_path("word_bpe_49k.json"), end=2, keep_space=False)
    return token_files.read_token_files(spark, files, docs.schema["doc_id"].dataType)


CHUNKS_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t ORDER BY n_chars DESC, doc_id)
"""


@query(sql=CHUNKS_SQL)
def op6_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_dedup.dedup(documents(spark, folder))


WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS t
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, ms WHERE len(w) >= m)),
h AS (SELECT dw.doc_id, i, m, item_id FROM dw JOIN bw USING (m, t)),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM h),
hit AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query(sql=DECONTAMINATION_SQL)
def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(documents(spark, folder), benchmark(spark, folder))
    return found.select(
        "doc_id",
        "n_words",
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.Model | None:
    """Fitted on labelled documents outside the held-out fifth."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~_held_out(F.col("doc_id")))
    return toxicity.fit(documents(spark, folder), labels)


def _held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, folder))
    return scored.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


JACCARD_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 4) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
  SELECT o.a, o.b FROM o JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id,
       coalesce(any_value(k.n), 0) AS n_links
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM e GROUP BY a) k USING (doc_id)
JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""


@query(sql=JACCARD_SQL)
def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    grouped = jaccard.groups(documents(spark, folder), size=4, percent=85)
    return grouped.select("doc_id", "n_shingles", "component_id", "n_links")


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS line, s[i] AS raw,
         trim(regexp_replace(lower(s[i]), '[ \t\r\f\x0B]+', ' ', 'g')) AS p
  FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL))),
f AS (
  SELECT p, min(doc_id * 1000000 + line) AS first, length(p) AS n FROM l WHERE length(p) >= 20 GROUP BY p),
h AS (
  SELECT p, first, m AS longer, unnest(['h' || substr(p, 1, m // 2), 't' || right(p, m - m // 2)]) AS half
  FROM (SELECT p, first, unnest([n, n + 1]) AS m FROM f)),
near AS (
  SELECT DISTINCT b.p FROM h a JOIN h b ON a.longer = b.longer AND a.half = b.half AND a.first < b.first
  WHERE levenshtein(a.p, b.p) <= 1),
marked AS (
  SELECT l.doc_id, l.line, l.raw,
         f.p IS NOT NULL AND (f.first <> l.doc_id * 1000000 + l.line OR near.p IS NOT NULL) AS gone
  FROM l LEFT JOIN f ON f.p = l.p LEFT JOIN near ON near.p = l.p)
SELECT doc_id, count_if(gone) AS lines_dropped,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY line) FILTER (NOT gone), '')) AS text_sha256
FROM marked GROUP BY doc_id
"""


@query(sql=LINES_SQL)
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_dedup.drop_repeated(documents(spark, folder).select("doc_id", "text"))
    text = F.coalesce("text", F.lit("")).cast("binary")
    return cleaned.select("doc_id", F.col("lines_dropped").cast("long").alias("lines_dropped"), F.sha2(text, 256).alias("text_sha256"))


@query
def op1_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.replace(documents(spark, folder).select("doc_id", "text"), key="surrogates-1")


@query
def op2_kneser_ney_quality(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = documents(spark, folder).select("doc_id", "lang", "text")
    return kneser_ney.classify(docs, labels.where("quality = 1"))


MERKLE_SQL = """
WITH RECURSIVE p AS (
  SELECT doc_id, source, text, CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END AS tree,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
         || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head,
         xor(list_reduce(list_concat([4294967295], list_transform(range(0, 8 * length(CAST(doc_id AS VARCHAR))),
           lambda i: (ascii(CAST(doc_id AS VARCHAR)[i // 8 + 1]) >> (i % 8)) & 1)),
           lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 5 = 0 AS hit
  FROM documents),
c AS (
  SELECT *, CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other
  FROM p),
l AS (
  SELECT doc_id, source, tree, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(other) || ':' || other END) AS claimed
  FROM c),
o AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS n FROM l),
up AS (
  SELECT 0 AS level, tree, place, n, leaf AS d FROM o
  UNION ALL
  SELECT level + 1, tree, place // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY place)) FROM up
  WHERE n > 1 GROUP BY level, tree, place // 16, n),
sub AS (
  SELECT s.tree, s.d, row_number() OVER (ORDER BY t.source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM up s JOIN (SELECT DISTINCT tree, source FROM l) t USING (tree) WHERE s.n = 1),
top AS (
  SELECT 0 AS level, place, n, d FROM sub
  UNION ALL
  SELECT level + 1, place // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY place)) FROM top
  WHERE n > 1 GROUP BY level, place // 16, n),
runs AS (
  SELECT level, tree, place // 16 AS parent, string_agg(d, '' ORDER BY place) AS run FROM up WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT 1000 + level, '', place // 16, string_agg(d, '' ORDER BY place) FROM top WHERE n > 1 GROUP BY ALL),
f AS (
  SELECT doc_id, leaf, claimed AS d, '' AS proof, tree AS source, tree, place, n, 0 AS level FROM o
  UNION ALL
  SELECT doc_id, leaf,
         CASE WHEN f.n > 1 THEN sha256(run[:64 * (f.place % 16)] || f.d || run[64 * (f.place % 16) + 65:]) ELSE f.d END,
         CASE WHEN f.n > 1 THEN proof || run[:64 * (f.place % 16)] || run[64 * (f.place % 16) + 65:] ELSE proof END,
         f.source, CASE WHEN f.n > 1 THEN f.tree ELSE '' END, CASE WHEN f.n > 1 THEN f.place // 16 ELSE sub.place END,
         CASE WHEN f.n > 1 THEN (f.n + 15) // 16 ELSE sub.n END, CASE WHEN f.n > 1 THEN f.level + 1 ELSE 1000 END
  FROM f LEFT JOIN runs ON runs.level = f.level AND runs.tree = f.tree AND runs.parent = f.place // 16
  LEFT JOIN sub ON sub.tree = f.tree
  WHERE f.n > 1 OR f.level < 1000)
SELECT f.doc_id, f.leaf, sub.d AS subroot, r.d AS root, sha256(f.proof) AS proof_sha256, f.d AS folded_root,
       f.d = r.d AS verified
FROM f JOIN sub ON sub.tree = f.source CROSS JOIN (SELECT d FROM top WHERE n = 1) r WHERE f.n = 1 AND f.level >= 1000
"""


@query(sql=MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(merkle.document_leaves(documents(spark, folder), tampered))


AUDIT_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END AS failed FROM t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
g AS (
  SELECT part, failed, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, failed),
a AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b),
o AS (
  SELECT a1.f || a2.f || a3.f || a4.f || a5.f AS filter_order, [a1.b, a2.b, a3.b, a4.b, a5.b] AS bits
  FROM a a1, a a2, a a3, a a4, a a5 WHERE a1.b + a2.b + a3.b + a4.b + a5.b = 31
  AND len(list_distinct([a1.b, a2.b, a3.b, a4.b, a5.b])) = 5),
s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
  FROM (SELECT filter_order, bits, unnest(range(1, 6)) AS step FROM o)),
r AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN failed & (before | own) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN failed & before = 0 AND failed & own <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN failed & before <> 0 AND failed & own <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN failed & before = 0 AND failed & own <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN failed & before = 0 AND failed & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM g, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""


@query(sql=AUDIT_SQL)
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    traits = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    failed = filter_audit.labelled(filter_audit.failures(documents(spark, folder)), labels, traits)
    return filter_audit.audit(failed, "ABCDE", list(traits))


SEARCH_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""


@query(sql=SEARCH_SQL)
def op13_exact_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{folder}/embeddings.parquet")
    vectors = topk_search.whole_vectors(embeddings, id="vec_id", vec="embedding", scale=64)
    return topk_search.search(vectors, F.col("id") % 20 == 0, k=20)
