import collections
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marlstone.functions import arrays
from marlstone.functions import text as T
from marlstone.functions.code import LANGUAGE_MARKS, PYTHON_IMPORT, SCRIPT_IMPORT
from marlstone.functions.stem import stem
from marlstone.operators import code, lexical, prep, text


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first().y


KEYWORDS = [
    ("The cat sat. The cat ran! A dog, a cat?", [("cat", 3), ("sat", 1), ("ran", 1)]),
    ("größe abc_1 der die der abc abc1 ab zzz", [("der", 2), ("die", 1), ("abc", 1)]),
    ("and the for", []),
    ("", []),
    ("beta alpha beta alpha gamma", [("beta", 2), ("alpha", 2), ("gamma", 1)]),
    ("Ünder the Ärger naïve café cafe CAFE cafe", [("cafe", 3)]),
]


@pytest.mark.parametrize("value,want", KEYWORDS)
def test_keywords_of_small_texts(spark, value, want):
    df = spark.createDataFrame([(1, value)], "id long, t string")
    got = text.keywords(df, key="id", text_col="t", k=3).orderBy("rank").collect()
    assert [(r.keyword, r.score) for r in got] == want


def test_keywords_scan_only(spark):
    df = spark.createDataFrame([(1, "a")], "id long, t string")
    plan = text.keywords(df, key="id", text_col="t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_overlap_is_multiset_intersection(spark):
    cases = [("a b b c", "b b b d"), ("", "a"), ("a", ""), ("x y", "p q"), ("a a a", "a a")]
    df = spark.createDataFrame(cases, "a string, b string")
    tokens = [F.filter(F.split(c, " "), lambda t: t != "") for c in ("a", "b")]
    got = df.select(arrays.overlap(*tokens).alias("n")).collect()
    want = [sum((Counter(a.split()) & Counter(b.split())).values()) for a, b in cases]
    assert [r.n for r in got] == want


def test_grams(spark):
    tokens = lambda c: F.split(c, " ")
    assert one(spark, "a b c", lambda c: arrays.grams(tokens(c), 2)) == ["a b", "b c"]
    assert one(spark, "a b", lambda c: arrays.grams(tokens(c), 3)) == []


@pytest.mark.parametrize("value", ["  x ", "\t\n x\r\n", " x ", "", " \n ", "a b"])
def test_strip_follows_python(spark, value):
    assert one(spark, value, T.strip) == value.strip()


def test_bleu_tokens(spark):
    value = "It's 3.5, e.g. a well-known 10-K &quot;A&amp;B&quot; (x)!"
    want = "It's 3.5 , e . g . a well-known 10 - K \" A & B \" ( x ) !".split()
    assert one(spark, value, T.bleu_tokens) == want


def test_sentences(spark):
    assert one(spark, "One. Two!  Three? 3.5 is one", T.sentences) == ["One.", "Two!", "Three?", "3.5 is one"]


def test_entities_with_spans(spark):
    value = "mail a.b@c.org or d@e.net, see http://x.org/p?q=1 from 10.0.0.1"
    df = spark.createDataFrame([(1, value), (2, "")], "id long, t string")
    rows = text.entities(df, key="id", text_col="t").collect()
    assert {(r.label, r.entity) for r in rows} == {
        ("email", "a.b@c.org"), ("email", "d@e.net"), ("url", "http://x.org/p?q=1"), ("ipv4", "10.0.0.1")
    }
    assert all(value[r.start : r.end] == r.entity for r in rows)
    counts = text.entity_counts(df, key="id", text_col="t")
    assert {(r.entity, r.mentions, r.texts) for r in counts.collect()} == {(r.entity, 1, 1) for r in rows}


def test_polarity_labels(spark):
    df = spark.createDataFrame([(1, "good good bad"), (2, "bad"), (3, "plain"), (4, "")], "id long, t string")
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1)], "token string, weight int")
    got = {r.id: (r.label, r.score) for r in text.polarity(df, lexicon, key="id", text_col="t").collect()}
    assert got == {
        1: ("positive", pytest.approx(1 / 3)), 2: ("negative", -1.0), 3: ("neutral", 0.0), 4: ("neutral", 0.0)
    }


def test_polarity_sorts_words_in_compiled_code(spark):
    df = spark.createDataFrame(
        [(1, "Good good so-so BAD good"), (2, None), (3, "so so"), (4, "ünd good")], "id long, t string"
    )
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1), ("so", 0)], "token string, weight int")
    scored = text.polarity(df, lexicon, key="id", text_col="t")
    got = {r.id: (r.label, r.score) for r in scored.collect()}
    assert got == {
        1: ("positive", pytest.approx(2 / 6)), 2: ("neutral", 0.0), 3: ("neutral", 0.0), 4: ("positive", 0.5)
    }
    assert "array_sort" not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_summary_respects_the_budget(spark):
    sentence = "Word{0} common words here."
    value = " ".join(sentence.format(c) for c in "abcdefgh")
    df = spark.createDataFrame([(1, value), (2, "")], "id long, t string")
    out = {r.id: r.summary for r in text.summarize(df, key="id", text_col="t", max_length=9, min_length=5).collect()}
    kept = T_split(out[1])
    assert kept == [s for s in T_split(value) if s in kept] and len(kept) == 2
    assert out[2] == ""
    long = text.summarize(df, key="id", text_col="t", max_length=3, min_length=2).where("id = 1").first().summary
    assert len(T_split(long)) == 1


def T_split(value):
    return re.split(r"(?<=[.!?])\s+", value)


SEARCHED = {
    "a": "rare common common words", "b": "common words of anything", "c": "Größe größe common 東京 12", "d": "", "e": None,
    "f": "words words words", "g": "12 x", "h": "rare common common words",
}
ASKED = [(1, "rare words"), (2, "größe"), (3, "東京 12 unseen"), (4, "nothing here"), (5, ""), (6, None), (7, "common words")]


def plain_vectors(texts, known):
    """Unit vectors by definition; ``known`` are the texts whose words set the weights."""
    count = collections.Counter(w for t in known for w in set(re.findall(r"\w+", (t or "").lower())))
    out = []
    for value in texts:
        own = collections.Counter(re.findall(r"\w+", (value or "").lower()))
        v = {w: n * (math.log((1 + len(known)) / (1 + count[w])) + 1) for w, n in own.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append({w: round(x / norm * lexical.SCALE) for w, x in v.items()})
    return out


@pytest.mark.parametrize("k", [1, 2, 50])
def test_search_gives_what_all_products_give(spark, k):
    df = spark.createDataFrame(list(SEARCHED.items()), "id string, t string").repartition(3)
    asked = spark.createDataFrame(ASKED, "q int, t string")
    found = text.semantic_search(asked, df, key="id", text_col="t", query_id="q", query_text="t", k=k, snippet=4)
    want = set()
    base = dict(zip(SEARCHED, plain_vectors(SEARCHED.values(), SEARCHED.values()), strict=True))
    for (q, _), v in zip(ASKED, plain_vectors([t for _, t in ASKED], SEARCHED.values()), strict=True):
        totals = sorted((-sum(x * b.get(w, 0) for w, x in v.items()), i) for i, b in base.items())
        want |= {(q, r, i, round(-s / lexical.SCALE**2, 9), SEARCHED[i][:4]) for r, (s, i) in enumerate(totals[:k], 1) if s}
    assert {(r.query_id, r["rank"], r.id, round(r.score, 9), r.text) for r in found.collect()} == want


def test_search_over_random_texts_prunes_nothing_it_needs(spark):
    rng = random.Random(5)
    vocabulary = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(600)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, t string")
    found = text.semantic_search(df, df, key="id", text_col="t", query_id="id", query_text="t", k=3)
    vectors = plain_vectors([t for _, t in rows], [t for _, t in rows])
    want = set()
    for q, v in enumerate(vectors):
        totals = sorted((-sum(x * b.get(w, 0) for w, x in v.items()), i) for i, b in enumerate(vectors))
        want |= {(q, r, i) for r, (s, i) in enumerate(totals[:3], 1) if s}
    assert {(r.query_id, r["rank"], r.id) for r in found.collect()} == want


def test_embeddings_hold_every_word(spark):
    df = spark.createDataFrame([*SEARCHED.items(), (None, "no id")], "id string, t string")
    out = lexical.embed(df, key="id", text_col="t", dim=16).withColumn("v", lexical.dense(16)("cells")).collect()
    assert len(out) == 9
    for r in out:
        has_words = bool(re.findall(r"\w", SEARCHED.get(r.id) or "")) and r.id is not None
        assert sum(x * x for x in r.v) == pytest.approx(float(has_words), abs=1e-4)
        assert bool(r.cells) == has_words and all(x >= 0 for x in r.v)


def test_zero_shot_scores_add_up(spark):
    docs = spark.createDataFrame([(1, "cats purr softly"), (2, "dogs bark loudly"), (3, None), (4, "unrelated")], "id long, t string")
    labels = spark.createDataFrame(
        [("cat", "cats purr"), ("dog", "dogs"), ("dog", "bark"), (None, "cats")], "label string, description string"
    )
    rows = text.zero_shot(docs, labels, key="id", text_col="t").collect()
    assert {r.id: r.label for r in rows if r["rank"] == 1} == {1: "cat", 2: "dog", 3: "cat", 4: "cat"}
    for key in (1, 2, 3, 4):
        assert sum(r.score for r in rows if r.id == key) == pytest.approx(1)
    assert [r.score for r in rows if r.id == 3] == [0.5, 0.5]



def test_zero_shot_labels_of_own_rows(spark):
    docs = spark.createDataFrame(
        [(1, "cats purr softly", "cat"), (2, "dogs bark loudly", "dog"), (3, None, "dog"), (4, "dogs and cats", None),
         (5, "", "bird")],
        "id long, t string, lang string",
    )
    labels = docs.select(F.col("lang").alias("label"), F.col("t").alias("description"))
    given = sorted(map(tuple, text.zero_shot(docs, labels, key="id", text_col="t").collect()))
    own = sorted(map(tuple, text.zero_shot(docs, key="id", text_col="t", label_col="lang").collect()))
    assert own == given and len(own) == 15

# Pairs from the published description of the algorithm.
STEMS = """caresses caress ponies poni cats cat feed feed agreed agre plastered plaster bled bled motoring motor
sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz
failing fail filing file happy happi relational relat conditional condit rational ration valenci valenc
digitizer digit radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam
predication predic operator oper feudalism feudal decisiveness decis hopefulness hope formaliti formal
sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin
gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt communism commun activate activ homologous homolog effective effect
bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll generalizations gener
oscillators oscil enjoy enjoy died die dies die by by geology geolog skies sky news news""".split()


def test_stems():
    pairs = list(zip(STEMS[::2], STEMS[1::2]))
    assert [(w, stem(w)) for w, _ in pairs] == pairs


# --- code ------------------------------------------------------------------------------------

SNIPPETS = {
    "python": "from os import path\nimport re\n\ndef go(x):\n    return x\n",
    "javascript": "const a = require('a');\nfunction f(x) { return x => 1 }",
    "typescript": "interface A { x: number; }\ntype B = string;",
    "java": "public class A {\n  void run() { System.out.println(1); }\n}",
    "go": "package main\nfunc main() { x := 1 }",
    "rust": "fn main() { let mut x = 1; }\nimpl A { }",
    "cpp": "#include <vector>\nint main() { std::vector<int> v; }",
    "sql": "select a from b where c = 1",
    "unknown": "zzz",
    "empty": "",
    "crlf": "import a\r\nfrom b import c\r\nconst q = require('z'); const r = require('y')\r\n",
    "quotes": "import x from './x'\nconst y = require(\"y\")\n  import indented",
}


def test_languages_of_snippets(spark):
    df = spark.createDataFrame(list(SNIPPETS.items()), "id string, c string")
    got = {r.id: r.language for r in code.language(df, code_col="c").collect()}
    assert {name: got[name] for name in LANGUAGE_MARKS} == {name: name for name in LANGUAGE_MARKS}
    assert (got["unknown"], got["empty"]) == ("unknown", "unknown")


@pytest.mark.parametrize(
    "language,pattern",
    [("python", PYTHON_IMPORT), ("javascript", SCRIPT_IMPORT), ("typescript", SCRIPT_IMPORT), ("go", None)],
)
def test_imports_follow_python(spark, language, pattern):
    df = spark.createDataFrame(list(SNIPPETS.items()), "id string, c string")
    got = {}
    for r in code.imports(df, key="id", code_col="c", language=language).orderBy("id", "at").collect():
        got.setdefault(r.id, []).append(r.statement)
    want = {k: re.findall(pattern, v, re.M) for k, v in SNIPPETS.items()} if pattern else {}
    assert got == {k: v for k, v in want.items() if v}


FUNCTIONS = [
    ('def f(x):\n    """  First line.\n    More."""', "f", "First line.", True),
    ("def g():\n    '''Single quotes'''", "g", "Single quotes", True),
    ('def h():\n    """"""\n    pass', "h", "Function/method named h", False),
    ("fn run() {}", "run", "Function/method named run", False),
    ("x = 1", "anonymous", "Function/method named anonymous", False),
    ("", "anonymous", "Function/method named anonymous", False),
    ("function größe() {}", "größe", "Function/method named größe", False),
]


def test_function_summaries(spark):
    df = spark.createDataFrame([(i, f[0]) for i, f in enumerate(FUNCTIONS)], "id long, c string")
    got = code.summary(df, code_col="c").orderBy("id").collect()
    assert [(r.name, r.summary, r.has_docstring) for r in got] == [f[1:] for f in FUNCTIONS]


# --- row-level operators ----------------------------------------------------------------------


def test_exact_split_sizes(spark):
    for n in (1, 5, 7, 100):
        parts = prep.split(spark.range(n), key="id", exact=True, train_ratio=0.8)
        assert parts.where("split = 'test'").count() == -(-n // 5)
    assert prep.split(spark.range(0), key="id", exact=True).count() == 0


def test_splits_do_not_depend_on_partitions(spark):
    for exact in (False, True):
        a, b = (
            {r.id: r.split for r in prep.split(spark.range(200).repartition(p), key="id", exact=exact).collect()}
            for p in (1, 7)
        )
        assert a == b
    c = {r.id: r.split for r in prep.split(spark.range(200), key="id", seed=1).collect()}
    assert c != a


def test_one_prompt_for_each_conversation(spark):
    rows = [("c", t, "user", f"m{t}") for t in range(10_500)] + [("d", 0, "bot", "hi")]
    df = spark.createDataFrame(rows, "conv string, turn long, role string, text string").repartition(3)
    prompts = prep.assemble_prompts(df, conversation="conv", turn="turn", role="role", text="text").collect()
    got = {r.conv: r.prompt.split("\n") for r in prompts}
    assert len(prompts) == 2 and got["d"] == ["bot: hi", "assistant:"]
    assert (len(got["c"]), got["c"][9_999], got["c"][-1]) == (10_501, "user: m9999", "assistant:")


def test_top_predictions(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.9), (1, "b", 0.9), (1, "c", 0.2), (2, "a", 0.5), (3, "a", 0.49)], "id long, label string, score double"
    )
    got = prep.top_predictions(df, key=["id"], label="label", score="score", k=1, threshold=0.5)
    assert {(r.id, r.label) for r in got.collect()} == {(1, "a"), (2, "a")}


def test_search_reads_the_lists_of_asked_words_only(spark):
    import os

    from marlstone.plans.durable import shared_folder

    df = spark.createDataFrame(list(SEARCHED.items()), "id string, t string").repartition(3)
    asked = spark.createDataFrame(ASKED, "q int, t string")
    index = lexical.TextIndex.build(df, key="id", text_col="t")
    vectors = index.vectors(asked, key="q", text_col="t")
    words = {r.term for r in vectors.select("term").collect()}
    postings = {(r.id, r.term, r.impact) for r in index.postings.collect()}
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    found = index.search(vectors, k=2).collect()
    assert found and {r.id for r in found} <= set(SEARCHED)
    read = [
        {(r.id, r.term, r.impact) for r in spark.read.parquet(f"{folder}/{t}").collect()}
        for t in set(os.listdir(folder)) - before
        if spark.read.parquet(f"{folder}/{t}").columns == ["term", "id", "impact"]
    ]
    assert {p for p in postings if p[1] in words} in read
    assert {p for p in postings if p[1] not in words}


def test_embed_sorts_in_compiled_code(spark):
    df = spark.createDataFrame([(1, "b a b c"), (2, None), (3, "")], "id long, t string")
    out = lexical.embed(df, key="id", text_col="t", dim=16)
    cells = {r.id: [c.cell for c in r.cells] for r in out.collect()}
    assert cells[2] == [] and cells[3] == [] and cells[1] == sorted(cells[1]) and cells[1]
    assert "array_sort" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_summaries_look_words_up_by_place(spark):
    """Scores come from whole arrays of counts, not from a search of a map for each word; odd rows as ever."""
    rare = " ".join(f"{a}{b}{c}x" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzabcd")
    rows = [
        (1, f"the cat sat. cat cat dog! {rare}? \u00bf123 \u0130stanbul cat_1."),
        (2, "Dog cat. The the the. dog dog cat cat."),
        (2, "Dog cat. The the the. dog dog cat cat."),
        (3, None), (4, ""), (5, " . \x01 "), (None, "cat dog."),
    ]
    df = spark.createDataFrame(rows, "id long, t string")
    made = text.summarize(df, key="id", text_col="t", max_length=5, min_length=2)
    out = {r.id: r.summary for r in made.collect()}
    # cat is in 4 rows, dog in 4 (repeated rows count each), sat and every rare word in 1.
    assert out == {1: "cat cat dog!", 2: "Dog cat.", 3: "", 4: "", 5: ". \x01", None: ""}
    plan = made._jdf.queryExecution().toString()
    assert "element_at" not in plan and "map_from_entries" not in plan


def test_word_counts_of_odd_texts(spark):
    rows = [(1, "One one TWO, \u00e9t\u00e9 e\u0301t e\u0301t  7_x"), (1, "one"), (None, "a"), (2, None), (3, ""), (4, " ,. "), (5, "\U0001d400b \u0130")]
    df = spark.createDataFrame(rows, "id long, t string")
    found = lexical.word_counts(df, key="id", text_col="t")
    got = sorted((r.id or 0, r.term, r.n) for r in found.collect())
    want = [(1, "one", 2), (1, "two", 1), (1, "\u00e9t\u00e9", 1), (1, "e\u0301t", 2), (1, "7_x", 1), (1, "one", 1), (0, "a", 1)]
    want += [(5, "\U0001d400b", 1), (5, "i\u0307", 1)]
    assert got == sorted(want)
    assert "lambdafunction" not in found._jdf.queryExecution().toString()
