import math

import pytest
from pyspark.sql import functions as F

from marlstone.operators import graph, metrics
from marlstone.sources.graphs import GraphStore

PAIR = {"prediction": "p", "reference": "r"}


def pairs(spark, rows):
    return spark.createDataFrame(rows, "p string, r string")


def test_accuracy_strips(spark):
    out = metrics.accuracy(pairs(spark, [(" a ", "a"), ("b", "a"), ("\nc", "c\t")]), **PAIR).first()
    assert (out.correct, out.total, out.accuracy) == (2, 3, pytest.approx(2 / 3))
    empty = metrics.accuracy(pairs(spark, []), **PAIR).first()
    assert (empty.accuracy, empty.total) == (0.0, 0)


def test_length_mismatch(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, p string")
    b = spark.createDataFrame([(1, "x")], "id long, r string")
    with pytest.raises(ValueError, match="mismatch"):
        metrics.align(a, b, key="id")
    assert metrics.align(a.where("id = 1"), b, key="id").count() == 1


def test_bleu_of_equal_texts(spark):
    out = metrics.bleu(pairs(spark, [("the cat sat on the mat", "the cat sat on the mat")]), **PAIR).first()
    assert out.bleu == pytest.approx(100) and out.bp == 1


def test_bleu_by_hand(spark):
    # 5 of 6 words, 3 of 5, 1 of 4 and 0 of 3 n-grams; the last order is halved once.
    out = metrics.bleu(pairs(spark, [("the cat sat on a mat", "the cat is on a mat")]), **PAIR).first()
    wanted = [500 / 6, 300 / 5, 100 / 4, 100 / 6]
    assert [out[f"p{n}"] for n in (1, 2, 3, 4)] == pytest.approx(wanted)
    assert out.bleu == pytest.approx(math.exp(sum(map(math.log, wanted)) / 4))


def test_bleu_brevity_and_misses(spark):
    short = metrics.bleu(pairs(spark, [("a b c d", "a b c d e f g h")]), **PAIR).first()
    assert short.bp == pytest.approx(math.exp(1 - 8 / 4)) and short.bleu == pytest.approx(100 * short.bp)
    for rows in ([("x y z w", "a b c d")], [("", "a b")], [], [("a b c", "a b c")]):
        assert metrics.bleu(pairs(spark, rows), **PAIR).first().bleu == 0


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b, 1):
            row[j] = last[j - 1] + 1 if x == y else max(last[j], row[j - 1])
    return row[-1]


def test_rouge_by_hand(spark):
    rows = [("The cats were running", "a cat runs"), ("x", "y"), ("", ""), ("one two three", "one three two")]
    stemmed = [("the cat were run", "a cat run"), ("x", "y"), ("", ""), ("one two three", "one three two")]
    out = metrics.rouge(pairs(spark, rows), **PAIR).first()
    one, longest = [], []
    for p, r in stemmed:
        a, b = p.split(), r.split()
        n = len(a) + len(b)
        one.append(2 * len(set(a) & set(b)) / n if n else 0)
        longest.append(2 * lcs(a, b) / n if n else 0)
    assert out.rouge1 == pytest.approx(sum(one) / 4)
    assert out.rougeL == pytest.approx(sum(longest) / 4)
    assert metrics.rouge(pairs(spark, []), **PAIR).first().rouge1 == 0


def test_report_covers_both_sides(spark):
    rows = [("a", "a"), ("b", "a"), ("a", "c"), ("a ", "a")]
    df = spark.createDataFrame(rows, "t string, p string")
    got = {r.label: (r.precision, r.recall, r.support) for r in metrics.class_report(df, truth="t", prediction="p").collect()}
    assert got == {
        "a": (pytest.approx(1 / 3), 0.5, 2), "b": (0.0, 0.0, 1), "c": (0.0, 0.0, 0), "a ": (0.0, 0.0, 1)
    }
    f1 = metrics.f1_scores(df, truth="t", prediction="p").first()
    assert f1.micro_f1 == 0.25 and f1.macro_f1 == pytest.approx(0.4 / 4) and f1.weighted_f1 == pytest.approx(0.2)
    assert metrics.class_report(df.limit(0), truth="t", prediction="p").count() == 0


def test_regression(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0)], "t double, p double")
    out = metrics.regression(df, truth="t", prediction="p").first()
    assert (out.rmse, out.r2) == (pytest.approx(math.sqrt(2 / 3)), pytest.approx(0.0))


# --- graphs ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def net(spark):
    # Two equally short ways a>c>d and a>b>d, the one over c is written first.
    listed = [
        ("a", "c"), ("a", "b"), ("c", "d"), ("b", "d"), ("d", "e"), ("e", "a"), ("a", "a"), ("a", "b"), ("x", "a"),
        ("e", "ghost"),
    ]
    edges = spark.createDataFrame([(s, d, i) for i, (s, d) in enumerate(listed)], "src string, dst string, seq long")
    nodes = spark.createDataFrame([(n,) for n in "abcdexz"], "id string")
    return nodes, graph.add_edges(None, edges)


def walk(spark, net, ends, max_hops=None):
    pairs = spark.createDataFrame([(i, *e) for i, e in enumerate(ends)], "pair_id long, source string, target string")
    out = graph.shortest_paths(*net, pairs, max_hops=max_hops).orderBy("pair_id").collect()
    return [(r.status, r.length, r.path) for r in out]


def test_shortest_paths(spark, net):
    got = walk(spark, net, [("a", "d"), ("a", "a"), ("d", "x"), ("a", "ghost"), ("x", "e"), ("z", "a")])
    assert got == [
        ("found", 2, ["a", "c", "d"]),
        ("found", 0, ["a"]),
        ("no path", None, None),
        ("missing", None, None),
        ("found", 4, ["x", "a", "c", "d", "e"]),
        ("no path", None, None),
    ]
    assert walk(spark, net, [("x", "e")], max_hops=3) == [("beyond bound", None, None)]


def test_long_paths_need_no_bound(spark):
    chain = [f"n{i:02d}" for i in range(31)]
    edges = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(zip(chain, chain[1:], strict=False))], "src string, dst string, seq long")
    nodes = spark.createDataFrame([(n,) for n in chain], "id string")
    assert walk(spark, (nodes, graph.add_edges(None, edges)), [("n00", "n30"), ("n05", "n07"), ("n07", "n05")]) == [
        ("found", 30, chain), ("found", 2, chain[5:8]), ("no path", None, None),
    ]


def test_hub_is_searched_in_parts(spark):
    spokes = spark.range(100_000).select(F.lit("hub").alias("src"), F.format_string("s%06d", "id").alias("dst"), F.col("id").alias("seq"))
    more = spark.createDataFrame([("a", "hub", 200_000), ("s000007", "z", 200_001), ("s000003", "z", 200_002), ("z", "y", 200_003)], spokes.schema)
    edges = graph.add_edges(None, spokes.unionByName(more))
    nodes = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    steps, hubs = graph._split_steps(edges, 20_000)
    assert hubs.collect() == [("hub", 5)]
    assert {r.part for r in steps.where("node = 'hub'").select("part").distinct().collect()} == set(range(5))
    found = walk(spark, (nodes, edges), [("a", "y"), ("hub", "s099999"), ("y", "hub")])
    assert found == [("found", 4, ["a", "hub", "s000003", "z", "y"]), ("found", 1, ["hub", "s099999"]), ("no path", None, None)]


def test_distances(spark, net):
    source = spark.createDataFrame([("x",), ("d",)], "node string")
    got = {r.node: r.depth for r in graph.distances(net[1], source).collect()}
    assert got == {"x": 0, "d": 0, "a": 1, "e": 1, "b": 2, "c": 2, "ghost": 2}


def test_neighbors_keep_repeats(spark, net):
    asked = spark.createDataFrame([("a",), ("nobody",), ("a",)], "node string")
    out = graph.neighbors(net[1], asked).collect()
    assert sorted(r.neighbor for r in out) == ["a", "b", "b", "c"]
    assert {r.relation for r in out} == {"related"}
    into = graph.neighbors(net[1], asked, direction="anything").collect()
    assert sorted(r.neighbor for r in into) == ["a", "e", "x"]


def test_nodes_by_name(spark):
    schema = "id string, name string, label string, at long"
    old = spark.createDataFrame([("1", "x", "old", 0)], schema)
    new = spark.createDataFrame([("1", None, "new", 1), (None, "n", "named", 2), ("0", None, "zero", 3)], schema)
    got = {r.id: r.label for r in graph.upsert_nodes(old, new, order_by=["at"]).collect()}
    assert got == {"1": "new", "n": "named", "0": "zero"}
    nobody = spark.createDataFrame([(None, None, "?", 1)], schema)
    with pytest.raises(Exception, match="needs an id"):
        graph.upsert_nodes(old, nobody, order_by=["at"]).collect()


def test_degrees(spark, net):
    got = {r.id: (r.out_degree, r.in_degree) for r in graph.degrees(*net).collect()}
    assert got["a"] == (4, 3) and got["z"] == (0, 0)


def test_graph_store(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "graphs"))
    nodes = spark.createDataFrame(
        [("a", "A", {"k": "1"}, 1), ("b", "B", {}, 2), ("a", "A2", {}, 3), ("c", "C", {}, 4)],
        "id string, label string, attrs map<string,string>, at long",
    )
    assert store.add_nodes("g", nodes, order_by=["at"]) == 3
    assert store.add_nodes("g", nodes.where("at = 2"), order_by=["at"]) == 3
    edges = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("b", "c", 3)], "src string, dst string, at long")
    assert store.add_edges("g", edges, order_by=["at"]) == 3
    assert {r.id: r.label for r in store.nodes("g").collect()} == {"a": "A2", "b": "B", "c": "C"}
    pairs = spark.createDataFrame([(1, "a", "c")], "pair_id long, source string, target string")
    found = graph.shortest_paths(store.nodes("g"), store.edges("g"), pairs, max_hops=5).first()
    assert found.path == ["a", "b", "c"]
    store.create("g")
    assert (store.nodes("g").count(), store.edges("g").count()) == (0, 0)
