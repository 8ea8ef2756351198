import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.functions import vectors as V
from marlstone.operators import vectors
from marlstone.sources import collections
from marlstone.sources.indexes import IndexStore

NAMES = {"id": "id", "vec": "vec", "query_id": "id"}


def table(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    rows = [(int(i), [float(x) for x in row]) for i, row in zip(ids, matrix)]
    return spark.createDataFrame(rows, "id long, vec array<float>").repartition(3)


@pytest.fixture(scope="module")
def clouds():
    """Clusters of very different size: one holds most vectors."""
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8)) * 4
    sizes = [300, 40, 40, 40, 20, 10]
    points = np.concatenate([c + rng.normal(size=(n, 8)) for c, n in zip(centers, sizes)])
    return points.astype(np.float32).astype(np.float64)


def brute(base, queries, k, metric):
    if metric == "l2":
        scores = -((queries[:, None, :] - base[None, :, :]) ** 2).sum(2)
    else:
        scores = queries @ base.T
        if metric == "cosine":
            lengths = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(base, axis=1)[None, :]
            scores = scores / (lengths + 1e-9)
    scores = np.round(scores, 9)
    ids = np.arange(len(base))
    return {q: [int(i) for i in np.lexsort((ids, -row))[:k]] for q, row in enumerate(scores)}


def found(hits):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.id)
    return out


LIMITS = {
    "queries broadcast": {},
    "base broadcast": {"broadcast_floats": 4_000},
    "shares": {"broadcast_floats": 0, "block_rows": 60, "query_rows": 70},
}


@pytest.mark.parametrize("metric", ["ip", "l2", "cosine"])
@pytest.mark.parametrize("path", LIMITS)
def test_exact_paths_agree(spark, clouds, metric, path):
    base, queries = (clouds[:120], clouds) if path == "base broadcast" else (clouds, clouds[::3])
    hits = vectors.search(
        table(spark, base), table(spark, queries), **NAMES, k=7, metric=metric, **LIMITS[path]
    )
    assert found(hits) == brute(base, queries, 7, metric)


def test_equal_scores_go_to_the_smaller_id(spark):
    same = np.ones((40, 4))
    hits = vectors.search(table(spark, same), table(spark, same[:2]), **NAMES, k=3)
    assert found(hits) == {0: [0, 1, 2], 1: [0, 1, 2]}


def test_fewer_rows_than_k(spark):
    few = np.eye(3)
    hits = vectors.search(table(spark, few), table(spark, few), **NAMES, k=10, metric="l2")
    assert all(len(ids) == 3 for ids in found(hits).values())


def test_nothing_to_search(spark):
    empty = spark.createDataFrame([], "id long, vec array<float>")
    some = table(spark, np.eye(3))
    for base, queries in ((empty, some), (some, empty)):
        assert vectors.search(base, queries, **NAMES, k=2).count() == 0


def recall(hits, truth):
    got = found(hits)
    return np.mean([len(set(got.get(q, [])) & set(ids)) / len(ids) for q, ids in truth.items()])


@pytest.mark.parametrize("limits", [{}, {"block_rows": 25, "query_rows": 30}])
def test_cells_reach_most_neighbors(spark, clouds, limits):
    df = table(spark, clouds)
    truth = brute(clouds, clouds, 5, "l2")
    ivf = vectors.search(df, df, **NAMES, k=5, metric="l2", method="ivf", nprobe=2, **limits)
    assert recall(ivf, truth) > 0.9
    lsh = vectors.search(
        df, df, **NAMES, k=5, metric="l2", method="lsh", bucket_length=4.0, tables=10, **limits
    )
    assert recall(lsh, truth) > 0.8


def test_all_cells_are_exact(spark, clouds):
    df = table(spark, clouds)
    centers = vectors.train_cells(df, vec="vec", nlist=4)
    hits = vectors.search(
        df, df, **NAMES, k=5, metric="ip", method="ivf", nprobe=4, centers=centers, block_rows=50
    )
    assert found(hits) == brute(clouds, clouds, 5, "ip")


def test_column_functions(spark):
    rows = [([3.0, 4.0], [6.0, 8.0]), ([1.0, 0.0], [-1.0, 0.0]), ([0.0, 0.0], [1.0, 1.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    out = df.select(V.cosine(F.col("a"), F.col("b")).alias("c"), V.normalize(F.col("a")).alias("n")).collect()
    assert [r.c for r in out] == pytest.approx([1.0, -1.0, 0.0], abs=1e-6)
    assert out[0].n == pytest.approx([0.6, 0.8]) and out[2].n == [0.0, 0.0]


def test_unequal_lengths_raise(spark):
    df = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="unequal length"):
        df.select(V.dot(F.col("a"), F.col("b"))).collect()
    with pytest.raises(Exception, match="expected vectors"):
        vectors.add_vectors(None, table(spark, np.eye(3)), order_by=["id"], vec="vec", dim=4).collect()


def test_unknown_names(spark):
    df = table(spark, np.eye(2))
    for wrong in ({"metric": "dot"}, {"method": "hnsw"}, {"k": 0}):
        with pytest.raises(ValueError):
            vectors.search(df, df, **NAMES, **wrong)


# --- collections ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def held(spark):
    rows = [
        (1, {"n": "1", "lang": "en"}),
        (2, {"n": "5", "lang": "de"}),
        (3, {"n": "10", "lang": "en", "ok": "true"}),
        (4, {}),
    ]
    return spark.createDataFrame(rows, "id long, metadata map<string,string>")


@pytest.mark.parametrize(
    "conditions,ids",
    [
        ({"lang": "en"}, [1, 3]),
        ({"n": {"$gt": 4}}, [2, 3]),
        ({"n": {"$gte": 5, "$lt": 10}}, [2]),
        ({"n": {"$lte": 1}}, [1]),
        ({"lang": {"$ne": "en"}}, [2, 4]),
        ({"lang": {"$in": ["de", "fr"]}}, [2]),
        ({"lang": {"$nin": ["en"]}}, [2, 4]),
        ({"ok": True}, [3]),
        ({"$or": [{"n": 1}, {"lang": "de"}]}, [1, 2]),
        ({"$and": [{"lang": "en"}, {"n": {"$gt": 1}}]}, [3]),
        ({"lang": "en", "n": 10}, [3]),
        ({}, [1, 2, 3, 4]),
    ],
)
def test_where(held, conditions, ids):
    assert sorted(r.id for r in held.where(collections.where(conditions)).collect()) == ids


def test_where_refuses_unknown_operators():
    with pytest.raises(ValueError):
        collections.where({"a": {"$like": "x"}}, F.lit(None))


def test_store(spark, tmp_path):
    store = collections.CollectionStore(spark, str(tmp_path / "store"))
    assert store.list().count() == 0
    store.create("a", {"kind": "first"})
    store.create("a", {"kind": "second"})
    rows = spark.createDataFrame(
        [("1", "one"), ("2", "two"), ("1", "again")], "id string, document string"
    ).withColumn("metadata", F.create_map(F.lit("k"), F.lit("v")))
    assert store.add("a", rows, order_by=["document"]) == 2
    assert store.add("a", rows, order_by=["document"]) == 2
    assert store.add("b", rows.limit(1)) == 1
    assert {r.collection: r.n for r in store.list().collect()} == {"a": 2, "b": 1}
    assert {r.metadata["kind"] for r in store.list().where("collection = 'a'").collect()} == {"first"}
    store.delete("a")
    assert {r.collection: r.n for r in store.list().collect()} == {"b": 1}
    assert store.add("a", rows.where("id = '2'")) == 1
    assert store.update("a", spark.createDataFrame([("2", "new"), ("3", "three")], "id string, document string")) == 2
    assert {r.id: r.document for r in store.documents("a").collect()} == {"2": "new", "3": "three"}


def parquet_files(path):
    return sorted(str(p) for p in path.rglob("*.parquet"))


def test_deleted_collection_leaves_no_files(spark, tmp_path):
    store = collections.CollectionStore(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([("1", "one")], "id string, document string")
    store.add("a/b: c", rows)
    before = parquet_files(tmp_path)
    store.add("other", rows)
    assert len(before) == 2 and len(parquet_files(tmp_path)) == 4
    store.delete("a/b: c")
    assert len(parquet_files(tmp_path)) == 2 and not set(before) & set(parquet_files(tmp_path))
    assert {r.collection for r in store.list().collect()} == {"other"}


def test_failed_and_repeated_batches(spark, tmp_path):
    store = collections.CollectionStore(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([(str(k), f"text {k}") for k in range(20)], "id string, document string")
    store.add("a", rows.where("id < 5"), batch_id="1")
    broken = rows.withColumn("document", F.when(F.col("id") == "13", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("document")))
    with pytest.raises(Exception, match="lost"):
        store.add("a", broken, batch_id="2")
    assert store.documents("a").count() == 5
    # What a job wrote before it was lost is replaced by its repetition.
    store.batches.write("a", rows.where("id in (7, 8)").select("id", "document", F.create_map().cast("map<string,string>").alias("metadata"), F.lit(None).cast("array<float>").alias("embedding")), "2")
    for _ in range(2):
        assert store.add("a", rows, batch_id="2") == 20
    assert store.documents("a").select("id").distinct().count() == 20


def test_add_to_each_collection(spark, tmp_path):
    store = collections.CollectionStore(spark, str(tmp_path / "store"))
    schema = "collection string, id string, document string"
    rows = [("a", "1", "one"), ("a", "1", "two"), ("b", "1", "three"), (None, "1", "x"), ("b", None, "y")]
    store.create("a", {"kept": "yes"})
    store.add("a", spark.createDataFrame([("0", "zero")], "id string, document string"))
    for _ in range(2):
        store.add_to_each(spark.createDataFrame(rows, schema), order_by=["document"], batch_id="1")
    assert {(r.collection, r.id): r.document for r in store.documents().collect()} == {("a", "0"): "zero", ("a", "1"): "one", ("b", "1"): "three"}
    assert {r.collection: r.metadata for r in store.list().collect()} == {"a": {"kept": "yes"}, "b": {}}


def test_two_writers_keep_out_of_each_others_way(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    stores = [collections.CollectionStore(spark, str(tmp_path / "store")) for _ in range(4)]

    def put(k):
        rows = spark.createDataFrame([(f"{k}-{i}", "x") for i in range(3)] + [("both", f"by {k}")], "id string, document string")
        stores[k].update("a", rows)

    stores[0].create("a")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(put, range(4)))
    held = {r.id: r.document for r in stores[0].documents("a").collect()}
    assert len(held) == 13 and held["both"].startswith("by ")


def test_collection_asked_by_text_and_by_vector(spark, tmp_path):
    store = collections.CollectionStore(spark, str(tmp_path / "store"))
    schema = "id string, document string, metadata map<string,string>, embedding array<float>"
    rows = [("x", "red apple", {"k": "1"}, [1.0, 0.0]), ("b", "green apple", {"k": "2"}, [0.0, 1.0]), ("a", "blue", {}, None)]
    store.add("c", spark.createDataFrame(rows, schema))
    asked = spark.createDataFrame([("q1", "green", [0.9, 0.0]), ("q2", None, None)], "q string, t string, v array<float>")
    by_text = store.query("c", asked, query_id="q", text="t", k=2).collect()
    assert [(r.query_id, r.id, r.document) for r in by_text] == [("q1", "b", "green apple")]
    by_vector = store.query("c", asked, query_id="q", vec="v", k=2).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.id) for r in by_vector] == [("q1", 1, "x"), ("q1", 2, "b")]
    kept = store.query("c", asked, query_id="q", vec="v", conditions={"k": "2"}).collect()
    assert [(r.id, r.metadata) for r in kept] == [("b", {"k": "2"})]
    with pytest.raises(ValueError):
        store.query("c", asked, query_id="q")


def test_search_with_ids_of_any_type(spark):
    rows = [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0]), ("d", None), (None, [1.0, 0.0])]
    df = spark.createDataFrame([(None, None), *rows], "id string, v array<float>")
    found = vectors.search(df, df, id="id", vec="v", query_id="id", k=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.id) for r in found] == [
        ("a", 1, "a"), ("a", 2, "b"), ("b", 1, "a"), ("b", 2, "b"), ("c", 1, "c"), ("c", 2, "a"),
    ]


def test_add_and_update_within_a_batch(spark):
    schema = "id string, document string, at long"
    old = spark.createDataFrame([("1", "old", 0)], schema)
    new = spark.createDataFrame([("1", "new", 1), ("2", "early", 2), ("2", "late", 3)], schema)
    added = {r.id: r.document for r in collections.add(old, new, order_by=["at"]).collect()}
    assert added == {"1": "old", "2": "early"}
    updated = {r.id: r.document for r in collections.update(old, new, order_by=["at"]).collect()}
    assert updated == {"1": "new", "2": "late"}


def test_default_ids_are_stable(spark):
    batch = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "at long, document string")
    first, second = (
        sorted(r.id for r in collections.with_default_ids(b, document="document", order_by=["at"]).collect())
        for b in (batch, batch.repartition(5))
    )
    assert first == second and len(set(first)) == 3


@pytest.mark.parametrize("kind", ["Flat", "IVFFlat", "HNSW"])
def test_index_store(spark, tmp_path, clouds, kind):
    store = IndexStore(spark, str(tmp_path / "indexes"))
    store.create("main", 8, kind=kind, metric="l2", nlist=2)
    df = table(spark, clouds).withColumn("document", F.concat(F.lit("d"), "id"))
    assert store.add("main", df.where("id < 200"), order_by=["id"]) == 200
    assert store.add("main", df.where("id >= 200").drop("document"), order_by=["id"]) == len(clouds)
    again = IndexStore(spark, str(tmp_path / "indexes"))
    hits = again.search("main", df, query_id="id", k=1).collect()
    assert all(r.id == r.query_id and r.score == 0 for r in hits) and len(hits) == len(clouds)
    assert {r.document for r in hits if r.id in (3, 250)} == {"d3", ""}
    lists = again.info("main").collect()
    assert {r.total for r in lists} == {len(clouds)} and sum(r.in_list for r in lists) == len(clouds)
    assert len(lists) == (2 if kind == "IVFFlat" else 1)
    again.create("main", 8)
    assert again.vectors("main").count() == 0
    with pytest.raises(ValueError):
        again.search("other", df, query_id="id")


def test_index_reads_only_probed_lists(spark, tmp_path, clouds, capsys):
    store = IndexStore(spark, str(tmp_path / "indexes"))
    store.create("main", 8, kind="IVFFlat", metric="l2", nlist=5)
    df = table(spark, clouds)
    store.add("main", df, order_by=["id"], batch_id="1")
    one = df.where("id = 7")
    probed = store.probed("main", one, vec="vec", nprobe=1)
    probed.explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if line.startswith("PartitionFilters")]
    assert any("cell" in line for line in filters)
    (cell,) = [r.cell for r in probed.select("cell").distinct().collect()]
    assert probed.count() == store.vectors("main").where(F.col("cell") == cell).count() < len(clouds)
    hits = store.search("main", df, query_id="id", k=3, nprobe=5).select("query_id", "rank", "id", "score")
    pos = {r.id: n for n, r in enumerate(df.select("id").orderBy("id").collect())}
    exact = vectors.search(df, df, id="id", vec="vec", query_id="id", k=3, metric="l2")
    assert {(r.query_id, r["rank"], r.id) for r in hits.collect()} == {(r.query_id, r["rank"], pos[r.id]) for r in exact.collect()}
    # Writing the batch again changes nothing; a second batch goes behind it.
    assert store.add("main", df, order_by=["id"], batch_id="1") == len(clouds)
    assert store.add("main", df.limit(3), order_by=["id"], batch_id="2") == len(clouds) + 3
    assert sorted(r.pos for r in store.vectors("main").collect()) == list(range(len(clouds) + 3))


@pytest.mark.parametrize("name, metric", [("knn_ip", "ip"), ("knn_l2", "l2"), ("knn_ivf", "ip")])
def test_searches_ask_with_every_row(spark, tmp_path, name, metric):
    from marlstone.workload import registered

    vecs = np.random.default_rng(11).normal(size=(120, 64)).astype(np.float32)
    # Ids with gaps, only two of them divisible by 50.
    ids = [3 * i + 1 for i in range(120)]
    rows = spark.createDataFrame(
        [(i, i % 10, [float(x) for x in v]) for i, v in zip(ids, vecs)], "vec_id long, label int, embedding array<float>"
    )
    rows.write.parquet(f"{tmp_path}/embeddings.parquet")
    want = brute(vecs.astype(np.float64), vecs.astype(np.float64), 5, metric)
    # knn_ivf names base rows by their place in vec_id order.
    named = (lambda i: i) if name == "knn_ivf" else (lambda i: ids[i])
    assert found(registered().queries[name](spark, str(tmp_path))) == {ids[q]: [named(i) for i in near] for q, near in want.items()}


def test_collection_query_asks_with_every_row(spark, tmp_path):
    from marlstone.workload import registered

    vecs = np.random.default_rng(12).normal(size=(120, 64)).astype(np.float32).astype(np.float64)
    # Ids with gaps, only two of them divisible by 50.
    rows = [(3 * i + 1, i % 10, [float(x) for x in v]) for i, v in enumerate(vecs)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    kept = [i for i in range(120) if i % 10 >= 3 and i % 10 != 7]
    near = brute(vecs[kept], vecs, 5, "l2")
    want = {f"q{3 * q + 1}": [f"v{3 * kept[i] + 1:012d}" for i in hits] for q, hits in near.items()}
    assert found(registered().queries["collection_query"](spark, str(tmp_path))) == want
