"""Queries over text and source code."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.functions.code import (
    DOCSTRINGS,
    FUNCTION_NAME,
    LANGUAGE_MARKS,
    PYTHON_IMPORT,
    SCRIPT_IMPORT,
)
from marlstone.functions.text import STOP_WORDS, WHITE
from marlstone.operators import code, lexical, text
from marlstone.workload.registry import query, table, texts

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_WORDS = r"list_filter(regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-z]{{3,}}'))"
# Words of any script, as the text vectors read them.
_RUNS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{M}}\p{{N}}_]+')"

WORDS_SQL = f"""
words AS (
  SELECT doc_id, lang, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, lang, {_WORDS.format("text")} AS ws FROM documents)),
kept AS (SELECT * FROM words WHERE word NOT IN ({_STOP}))
"""


def literal(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


@query(
    "keywords",
    f"""
    WITH {WORDS_SQL},
    counted AS (SELECT doc_id, word, count(*) AS n, min(i) AS f FROM kept GROUP BY doc_id, word),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS rank FROM counted)
    SELECT doc_id, CAST(rank AS INTEGER) AS rank, word AS keyword, CAST(n AS INTEGER) AS score
    FROM ranked WHERE rank <= 10
    """,
)
def keywords(spark, folder):
    return text.keywords(texts(spark, folder, "documents"), key="doc_id", text_col="text")


@query(
    "keywords_by_lang",
    f"""
    WITH {WORDS_SQL},
    counted AS (SELECT lang, word, count(*) AS n FROM kept GROUP BY lang, word),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM counted)
    SELECT lang, CAST(rank AS INTEGER) AS rank, word AS keyword, n AS score FROM ranked WHERE rank <= 20
    """,
)
def keywords_by_lang(spark, folder):
    return text.keywords_by(texts(spark, folder, "documents"), by=["lang"], text_col="text", k=20)


@query(
    "entity_counts",
    "WITH found AS ("
    + " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(regexp_extract_all(text, {literal(rule)})) AS entity FROM documents"
        for label, rule in text.ENTITY_RULES.items()
    )
    + """)
    SELECT label, entity, count(*) AS mentions, count(DISTINCT doc_id) AS texts FROM found GROUP BY label, entity
    """,
)
def entity_counts(spark, folder):
    return text.entity_counts(texts(spark, folder, "documents"), key="doc_id", text_col="text")


_SPANS = " UNION ALL ".join(
    f"""
    SELECT doc_id, '{label}' AS label, entity, CAST(s AS INTEGER) AS start, CAST(s + len(entity) AS INTEGER) AS "end"
    FROM (
      SELECT doc_id, unnest(hits) AS entity, unnest(list_transform(range(1, len(hits) + 1), lambda i:
        list_sum(list_transform(gaps[:i], lambda g: len(g)))
        + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: len(h))), 0))) AS s
      FROM (SELECT doc_id, regexp_extract_all(text, {literal(rule)}) AS hits,
                   string_split_regex(text, {literal(rule)}) AS gaps FROM documents))
    """
    for label, rule in text.ENTITY_RULES.items()
)


@query("entities", _SPANS)
def entities(spark, folder):
    return text.entities(texts(spark, folder, "documents"), key="doc_id", text_col="text")


# A lexicon read off the labelled texts: a word leans to where it is over-represented.
LEXICON_SQL = f"""
labelled AS (
  SELECT d.doc_id, toxic, {_RUNS.format("text")} AS ws
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
totals AS (SELECT count(*) FILTER (WHERE toxic = 0) AS clean, count(*) FILTER (WHERE toxic = 1) AS bad FROM labelled),
seen AS (
  SELECT word, count(*) FILTER (WHERE toxic = 0) AS c, count(*) FILTER (WHERE toxic = 1) AS b
  FROM (SELECT DISTINCT doc_id, toxic, unnest(ws) AS word FROM labelled) GROUP BY word),
lexicon AS (
  SELECT word, CASE WHEN c * bad > b * clean THEN 1 WHEN c * bad < b * clean THEN -1 ELSE 0 END AS weight
  FROM seen, totals)
"""


def _lexicon(spark, folder):
    labelled = texts(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    clean, bad = labelled.agg(
        F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)
    ).first()
    # Each labelled row's distinct words; their counts inside the row are not needed.
    seen = (
        labelled.select("toxic", F.explode(F.array_distinct(lexical.words(F.col("text")))).alias("term"))
        .groupBy("term")
        .agg(F.count_if(F.col("toxic") == 0).alias("c"), F.count_if(F.col("toxic") == 1).alias("b"))
    )
    return seen.select(F.col("term").alias("token"), F.signum(F.col("c") * bad - F.col("b") * clean).cast("int").alias("weight"))


@query(
    "polarity",
    f"""
    WITH {LEXICON_SQL},
    words AS (
      SELECT doc_id, unnest(ws) AS word FROM (SELECT doc_id, {_RUNS.format("text")} AS ws FROM documents)),
    sums AS (
      SELECT doc_id, sum(coalesce(weight, 0)) AS w, count(*) AS n
      FROM words LEFT JOIN lexicon USING (word) GROUP BY doc_id),
    scored AS (SELECT d.doc_id, coalesce(w, 0) / greatest(coalesce(n, 0), 1) AS score
               FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id)
    SELECT doc_id, round(score, 6) + 0.0 AS score,
           CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS label
    FROM scored
    """,
)
def polarity(spark, folder):
    scored = text.polarity(
        texts(spark, folder, "documents"), _lexicon(spark, folder), key="doc_id", text_col="text"
    )
    return scored.withColumn("score", F.round("score", 6))


def stripped(column: str) -> str:
    return f"regexp_replace({column}, '^{WHITE}+|{WHITE}+$', '', 'g')"


@query(
    "extractive_summary",
    f"""
    WITH {WORDS_SQL},
    freq AS (SELECT word, count(DISTINCT doc_id) AS df FROM kept GROUP BY word),
    parts AS (
      SELECT doc_id, list_filter(list_transform(
        string_split(regexp_replace(text, '([.!?]){WHITE}+', '\\1' || chr(1), 'g'), chr(1)),
        lambda s: {stripped("s")}), lambda s: s <> '') AS ss
      FROM documents),
    sents AS (SELECT doc_id, unnest(ss) AS sentence, generate_subscripts(ss, 1) AS i FROM parts),
    tokens AS (
      SELECT doc_id, i, unnest(ws) AS word
      FROM (SELECT doc_id, i, {_WORDS.format("sentence")} AS ws FROM sents)),
    scores AS (
      SELECT doc_id, i, CAST(sum(df) AS DOUBLE) / count(*) AS score
      FROM tokens JOIN freq USING (word) GROUP BY doc_id, i),
    ranked AS (
      SELECT s.doc_id, s.i, sentence, len(regexp_extract_all(sentence, '[\\p{{L}}\\p{{N}}_]+')) AS n,
             coalesce(score, 0) AS score
      FROM sents s LEFT JOIN scores c ON s.doc_id = c.doc_id AND s.i = c.i),
    cumulated AS (
      SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY score DESC, i ROWS UNBOUNDED PRECEDING) AS upto FROM ranked),
    summaries AS (
      SELECT doc_id, string_agg(sentence, ' ' ORDER BY i) AS summary
      FROM cumulated WHERE upto <= 130 OR upto - n < 30 GROUP BY doc_id)
    SELECT d.doc_id, coalesce(summary, '') AS summary FROM documents d LEFT JOIN summaries s ON d.doc_id = s.doc_id
    """,
)
def extractive_summary(spark, folder):
    return text.summarize(texts(spark, folder, "documents"), key="doc_id", text_col="text")


@query(
    "perplexity_unigram",
    f"""
    WITH counts AS (
      SELECT word, count(*) AS c FROM (SELECT unnest({_RUNS.format("text")}) AS word FROM documents) GROUP BY word),
    size AS (SELECT sum(c) AS n, count(*) AS v FROM counts),
    asked AS (SELECT item_id, unnest({_RUNS.format("text")}) AS word FROM benchmark)
    SELECT item_id, round(exp(-avg(ln((coalesce(c, 0) + 1) / (n + v + 1)))), 4) AS perplexity, count(*) AS tokens
    FROM asked LEFT JOIN counts USING (word), size GROUP BY item_id
    """,
)
def perplexity_unigram(spark, folder):
    model = text.unigram_model(texts(spark, folder, "documents"), text_col="text")
    scored = text.perplexity(
        model, texts(spark, folder, "benchmark"), key="item_id", text_col="text"
    )
    return scored.withColumn("perplexity", F.round("perplexity", 4))


def _vectors_sql(rows: str, name: str, terms: str = "term") -> str:
    """Unit vectors ``{name}(id, term, impact)`` of the counts in ``rows`` (id, term, n), weighted by ``df`` and ``size``."""
    return f"""
    {name}_w AS (
      SELECT id, {terms} AS term, sum(n * (ln((1 + size.n) / (1 + coalesce(df.df, 0))) + 1)) AS w
      FROM {rows} LEFT JOIN df USING (term), size GROUP BY id, {terms}),
    {name} AS (
      SELECT id, term, CAST(round(w / sqrt(sum(w * w) OVER (PARTITION BY id)) * {lexical.SCALE}) AS BIGINT) AS impact FROM {name}_w)
    """.replace("size.n", "size.texts")


def _index_sql(source: str, key: str, column: str) -> str:
    return f"""
    counted AS (
      SELECT id, term, count(*) AS n FROM (SELECT {key} AS id, unnest({_RUNS.format(column)}) AS term FROM {source})
      GROUP BY id, term),
    size AS (SELECT count(*) AS texts FROM {source}),
    df AS (SELECT term, count(*) AS df FROM counted GROUP BY term)
    """


@query(
    "embed_documents",
    f"""
    WITH {_index_sql("documents", "doc_id", "text")},
    {_vectors_sql("counted", "v", "CAST(('0x' || md5(term)[1:8])::BIGINT % 256 AS INTEGER)")}
    SELECT doc_id, coalesce(string_agg(term || ':' || impact, ' ' ORDER BY term), '') AS cells,
           round(sqrt(coalesce(sum(impact * impact), 0)) / {lexical.SCALE}, 4) AS norm
    FROM documents LEFT JOIN v ON id = doc_id GROUP BY doc_id
    """,
)
def embed_documents(spark, folder):
    """Every text's vector in 256 buckets, written out as its cells, and its length."""
    embedded = lexical.embed(texts(spark, folder, "documents"), key="doc_id", text_col="text", dim=256)
    squares = F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + c["impact"] * c["impact"])
    written = F.transform("cells", lambda c: F.concat_ws(":", c["cell"], c["impact"]))
    return embedded.select(
        F.col("id").alias("doc_id"),
        F.array_join(written, " ").alias("cells"),
        F.round(F.sqrt(squares) / F.lit(float(lexical.SCALE)), 4).alias("norm"),
    )


def _search_sql(source: str, key: str, column: str, asked: str) -> str:
    """The five best texts of each query by all products, without an index; ``asked`` selects id and text."""
    return f"""
    WITH {_index_sql(source, key, column)},
    asked AS (
      SELECT id, term, count(*) AS n FROM (SELECT id, unnest({_RUNS.format("text")}) AS term FROM ({asked})) GROUP BY id, term),
    {_vectors_sql("counted", "v")}, {_vectors_sql("asked", "q")},
    scored AS (
      SELECT q.id AS query_id, v.id, CAST(sum(q.impact * v.impact) AS BIGINT) AS total
      FROM q JOIN v USING (term) GROUP BY ALL),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY total DESC, id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, id, round(total / {float(lexical.SCALE) ** 2}, 6) AS score FROM ranked WHERE rank <= 5
    """


@query("semantic_search", _search_sql("documents", "doc_id", "text", "SELECT item_id AS id, text FROM benchmark"))
def semantic_search(spark, folder):
    found = text.semantic_search(
        texts(spark, folder, "benchmark"),
        texts(spark, folder, "documents"),
        key="doc_id",
        text_col="text",
        query_id="item_id",
        query_text="text",
    )
    return found.withColumn("score", F.round("score", 6)).drop("text")


@query("classify_docs")
def classify_docs(spark, folder):
    docs = texts(spark, folder, "documents")
    train = docs.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")
    return text.classify(train, docs, text_col="text", label="quality", key="doc_id")


@query(
    "zero_shot",
    f"""
    WITH {_index_sql("documents", "doc_id", "text")},
    described AS (
      SELECT lang AS id, term, sum(n) AS n FROM counted JOIN documents ON doc_id = id WHERE lang IS NOT NULL GROUP BY lang, term),
    {_vectors_sql("counted", "v")}, {_vectors_sql("described", "q")},
    sums AS (SELECT v.id, q.id AS label, sum(q.impact * v.impact) AS total FROM v JOIN q USING (term) GROUP BY ALL),
    scored AS (
      SELECT doc_id, l.lang AS label, coalesce(total, 0) AS total
      FROM documents CROSS JOIN (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL) l
      LEFT JOIN sums ON sums.id = doc_id AND sums.label = l.lang)
    SELECT doc_id, label, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY total DESC, label) AS INTEGER) AS rank,
           round(exp(10 * total / {float(lexical.SCALE) ** 2})
                 / sum(exp(10 * total / {float(lexical.SCALE) ** 2})) OVER (PARTITION BY doc_id), 6) AS score
    FROM scored
    """,
)
def zero_shot(spark, folder):
    """Languages as candidate labels, each described by all its texts."""
    docs = texts(spark, folder, "documents")
    found = text.zero_shot(docs, key="doc_id", text_col="text", label_col="lang")
    return found.withColumn("score", F.round("score", 6))


# --- source code -----------------------------------------------------------------------------


def _language_sql(source: str, key: str, column: str) -> str:
    scores = ", ".join(
        "("
        + " + ".join(
            f"CAST(regexp_matches({column}, {literal('(?im)' + m)}) AS INTEGER)" for m in marks
        )
        + f") AS score_{name}"
        for name, marks in LANGUAGE_MARKS.items()
    )
    names = [f"score_{n}" for n in LANGUAGE_MARKS]
    best = " ".join(
        f"WHEN score_{n} = greatest({', '.join(names)}) THEN '{n}'" for n in LANGUAGE_MARKS
    )
    return f"""
    SELECT '{source}' AS source, {key} AS id, {', '.join(names)},
           CASE WHEN greatest({', '.join(names)}) = 0 THEN 'unknown' {best} END AS language
    FROM (SELECT {key}, {scores} FROM {source})
    """


@query(
    "code_language",
    _language_sql("documents", "doc_id", "text")
    + " UNION ALL "
    + _language_sql("pages", "page_id", "html"),
)
def code_language(spark, folder):
    parts = []
    for source, key, column in (("documents", "doc_id", "text"), ("pages", "page_id", "html")):
        rows = texts(spark, folder, source).select(
            F.lit(source).alias("source"), F.col(key).alias("id"), F.col(column).alias("code")
        )
        parts.append(code.language(rows, code_col="code").drop("code"))
    return parts[0].unionByName(parts[1])


SNIPPETS_SQL = """
snippets AS (
  SELECT p_partkey AS id, language, CASE language
    WHEN 'python' THEN concat('import ', n, chr(10), 'from ', lower(p_type), ' import item', chr(10), 'def ', n,
      '(x):', chr(10), '    \"\"\"  Handle ', p_name, '.', chr(10), '    More.\"\"\"', chr(10), '    return x')
    WHEN 'javascript' THEN concat('import ', n, ' from ''./', n, '''', chr(13), chr(10), 'const b = require(''',
      lower(p_brand), '''); const c = require(''c'')', chr(10), 'function ', n, '(x) { return x; }')
    ELSE concat('package main', chr(10), 'func ', n, '() { x := ', p_size, ' }') END AS code
  FROM (SELECT *, replace(p_name, ' ', '_') AS n,
          CASE WHEN p_size < 20 THEN 'python' WHEN p_size < 40 THEN 'javascript' ELSE 'go' END AS language FROM part))
"""


def snippets(spark, folder):
    """Short source texts in three languages, built from part names and types."""
    name, nl = F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("\n")
    size = F.col("p_size")
    language = F.when(size < 20, "python").when(size < 40, "javascript").otherwise("go")
    python = F.concat(
        F.lit("import "), name, nl, F.lit("from "), F.lower("p_type"), F.lit(" import item"), nl,
        F.lit("def "), name, F.lit("(x):"), nl, F.lit('    """  Handle '), F.col("p_name"), F.lit("."), nl,
        F.lit('    More."""'), nl, F.lit("    return x"),
    )
    script = F.concat(
        F.lit("import "), name, F.lit(" from './"), name, F.lit("'\r\n"), F.lit("const b = require('"),
        F.lower("p_brand"), F.lit("'); const c = require('c')"), nl, F.lit("function "), name,
        F.lit("(x) { return x; }"),
    )
    go = F.concat(
        F.lit("package main"), nl, F.lit("func "), name, F.lit("() { x := "), size.cast("string"), F.lit(" }")
    )
    return texts(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        language.alias("language"),
        F.when(size < 20, python).when(size < 40, script).otherwise(go).alias("code"),
    )


@query(
    "code_imports",
    f"""
    WITH {SNIPPETS_SQL},
    found AS (
      SELECT id, unnest(CASE WHEN language = 'python' THEN regexp_extract_all(code, {literal('(?m)' + PYTHON_IMPORT)})
        WHEN language IN ('javascript', 'typescript') THEN regexp_extract_all(code, {literal('(?m)' + SCRIPT_IMPORT)})
        ELSE [] END) AS statement FROM snippets)
    SELECT statement, count(*) AS statements, count(DISTINCT id) AS texts FROM found GROUP BY statement
    """,
)
def code_imports(spark, folder):
    found = code.imports(
        snippets(spark, folder), key="id", code_col="code", language=F.col("language")
    )
    return code.import_counts(found, key="id")


@query(
    "code_summary",
    f"""
    WITH {SNIPPETS_SQL},
    raw AS (
      SELECT id, regexp_extract(code, {literal(FUNCTION_NAME)}, 1) AS n,
             CASE WHEN regexp_matches(code, {literal('(?s)' + DOCSTRINGS[0])})
                    THEN regexp_extract(code, {literal('(?s)' + DOCSTRINGS[0])}, 1)
                  WHEN regexp_matches(code, {literal('(?s)' + DOCSTRINGS[1])})
                    THEN regexp_extract(code, {literal('(?s)' + DOCSTRINGS[1])}, 1) END AS d FROM snippets),
    named AS (
      SELECT id, CASE WHEN n = '' THEN 'anonymous' ELSE n END AS name,
             nullif(string_split({stripped("d")}, chr(10))[1], '') AS line FROM raw)
    SELECT id, name, coalesce(line, 'Function/method named ' || name) AS summary, line IS NOT NULL AS has_docstring
    FROM named
    """,
)
def code_summary(spark, folder):
    return code.summary(snippets(spark, folder), code_col="code").drop("code", "language")


@query(
    "code_search",
    f"WITH {SNIPPETS_SQL}, "
    + _search_sql("snippets", "id", "code", "SELECT min(p_partkey) AS id, p_name AS text FROM part GROUP BY p_name").strip().removeprefix("WITH")
    .replace("SELECT query_id, rank, id, round", "SELECT query_id, rank, ranked.id, left(code, 500) AS text, round")
    .replace("FROM ranked WHERE rank <= 5", "FROM ranked JOIN snippets USING (id) WHERE rank <= 5"),
)
def code_search(spark, folder):
    """Every distinct part name as a query against all snippets."""
    names = (
        table(spark, folder, "part")
        .groupBy("p_name")
        .agg(F.min("p_partkey").alias("query_key"))
    )
    found = text.semantic_search(
        names,
        snippets(spark, folder),
        key="id",
        text_col="code",
        query_id="query_key",
        query_text="p_name",
        snippet=500,
    )
    return found.withColumn("score", F.round("score", 6))
