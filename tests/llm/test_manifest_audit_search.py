"""Merkle manifest, filter audit and exact search against brute force on small tables with nulls, ties and repeats."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import filter_audit, merkle, topk_search

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
DOCUMENTS = "doc_id long, source string, lang string, n_chars long, text string, slot int, tree string, digest string, part string, failed int"


def table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 9, "t", None, "p", None) for r in rows], DOCUMENTS)


def rows_of(sizes):
    """Documents of several sources, among them a null one, an empty name and one with many rows."""
    texts = [None, "", "Plain Text", "lower only", "Ünï CODE", LONG + " END"]
    number, rows = itertools.count(), []
    for source, n in sizes.items():
        for _ in range(n):
            k = next(number)
            rows.append((k, source, None if k % 7 == 0 else "en", None if k % 5 == 0 else k, texts[k % len(texts)]))
    return rows


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, source, lang, n_chars, text):
    return H(*map(framed, (doc_id, source, lang, n_chars, text)))


def climb(digests):
    """The top of a tree, and per leaf its siblings' runs with the leaf's slot."""
    paths, level, at = [[] for _ in digests], digests, list(range(len(digests)))
    while len(level) > 1:
        runs = [level[i : i + 16] for i in range(0, len(level), 16)]
        for path, place in zip(paths, at, strict=True):
            path.append((place % 16, runs[place // 16]))
        at = [p // 16 for p in at]
        level = [H(*r) for r in runs]
    return (level[0] if level else None), paths


def expected_manifest(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = sorted((r for r in rows if r[1] == source), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees[source] = own, *climb([leaf_of(*r) for r in own])
    root, above = climb([trees[s][1] for s in sources])
    out = Counter()
    for source, higher in zip(sources, above, strict=True):
        own, top, paths = trees[source]
        for row, path in zip(own, paths, strict=True):
            whole = path + higher
            proof = H(*[d for slot, run in whole for k, d in enumerate(run) if k != slot])
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            lower = row[4] and re.sub("[A-Z]+", lambda m: m[0].lower(), row[4])
            folded = leaf_of(*row[:4], lower if hit else row[4])
            for slot, run in whole:
                folded = H(*run[:slot], folded, *run[slot + 1 :])
            out[row[0], leaf_of(*row), top, root, proof, folded, folded == root] += 1
    return out


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {None: 1, "": 1, "a": 16}, {"b": 17, None: 3, "é": 16, "a": 300}, {f"s{k}": 1 + k % 3 for k in range(40)}],
    ids=["one", "few", "deep", "many"],
)
def test_manifest(spark, sizes):
    rows = rows_of(sizes)
    if len(sizes) == 3:
        rows += [rows[5], rows[5], (None, "a", None, None, "No Id"), (None, "a", None, None, None)]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.manifest(merkle.document_leaves(table(spark, rows).repartition(5), tampered))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, found.collect())) == expected_manifest(rows)


def test_manifest_of_nothing(spark):
    leaves = merkle.document_leaves(table(spark, rows_of({"a": 1})).limit(0), F.lit(True))
    assert merkle.manifest(leaves).count() == 0


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    own = ""
    own += "A" * (len(words) < 200)
    own += "B" * (100 * len(set(words)) < 50 * len(words))
    own += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text))
    own += "D" * bool(re.search(r"[#$%&*|]", text))
    return own


def expected_audit(rows, labels):
    docs = []
    for doc_id, source, _, _, text in rows:
        text = text or ""
        copy = doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[4] or "") == text for r in rows)
        own = [x for x in labels if x[0] == doc_id and doc_id is not None]
        docs.append((source or "", failed(text) + "E" * copy, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = set()
    for part in {d[0] for d in docs}:
        mine, table, total = [d for d in docs if d[0] == part], [], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                total[name] += len(gone)
                failing = sum(name in d[1] for d in mine)
                alone = sum(d[1] == name for d in mine)
                table.append((part, order, step, len(left), len(gone), failing - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out |= {(*t, total[t[1][t[2] - 1]]) for t in table}
    return out


def test_audit(spark):
    words = [" ".join(f"{p}{i % m}" for i in range(n)) for p, n, m in [("w", 300, 300), ("w", 300, 90), ("W", 250, 250), ("#", 260, 100), ("é", 5, 5)]]
    texts = [*words, None, "", " \t\n\x0b", "A$", "many words joined", LONG]
    rows = [(k, [None, "", "a", "b"][k % 4], "en", 1, texts[k * k % len(texts)]) for k in range(60)]
    rows += [rows[3], (3, "b", "en", 1, "another text of the same id"), (None, None, None, None, None), (None, "a", None, None, words[0])]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 60, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (7, None, None)]
    named = spark.createDataFrame([(a, b, None if c is None else int(c)) for a, b, c in labels], "doc_id long, quality int, toxic int")
    traits = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    marked = filter_audit.labelled(filter_audit.failures(table(spark, rows)), named, traits)
    found = filter_audit.audit(marked, "ABCDE", list(traits))
    assert found.columns[:7] == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == 3 * 600 and set(got) == expected_audit(rows, labels)
    empty = filter_audit.failures(table(spark, rows).limit(0))
    assert filter_audit.audit(filter_audit.labelled(empty, named.limit(0), traits), "ABCDE", list(traits)).count() == 0


def test_orders_counted_by_paths():
    reach, leave = filter_audit.path_counts(5)
    assert reach[31] == leave[0] == 120
    assert all(reach[s] * leave[s] * 1 <= 120 for s in range(32))
    assert sum(reach[s] * leave[s | 1] for s in range(0, 32, 2)) == 120  # every order passes one edge of each filter


def expected_search(rows, k):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    whole = [(n, i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and usable(v)]
    out = Counter()
    for n, i, v in whole:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, j, w in whole if m != n)  # noqa: B905
            for rank, (score, j) in enumerate(scores[:k], 1):
                out[i, rank, j, -score] += 1
    return out


def search(spark, rows, k):
    schema = "vec_id long, embedding array<float>, rid string, slice int, rank string"
    df = spark.createDataFrame([(*r, "r", 1, None) for r in rows], schema).repartition(3)
    vectors = topk_search.whole_vectors(df, id="vec_id", vec="embedding", scale=64)
    found = topk_search.search(vectors, F.col("id") % 20 == 0, k=k)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return Counter(map(tuple, found.collect()))


ODD_VECTORS = [(None, [1.0, 2.0]), (40, None), (41, [float("nan"), 1.0]), (60, [float("inf"), 1.0]), (61, [None, 1.0]), (80, [])]


@pytest.mark.parametrize("k", [1, 5, 20])
def test_search(spark, monkeypatch, k):
    for name, value in (("SLICE", 16), ("GROUP", 4), ("ROUND", 2), ("DEPTH", 24), ("CHUNK", 3)):
        monkeypatch.setattr(topk_search, name, value)
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=7).tolist()) for i in range(-40, 200)]
    rows += [(int(i), [1.0, -0.5, 0.25, 0.0, 0.0, 0.0, 2.0]) for i in range(300, 420)]  # a common vector
    rows += [(20, rows[60][1]), (20, rows[60][1]), (500, [1.0, 2.0, 3.0]), *ODD_VECTORS]
    assert search(spark, rows, k) == expected_search(rows, k)


def test_search_of_little(spark):
    few = [(0, [0.5, 1.0]), (1, [0.5, 1.0]), (20, [-3.0, 0.1])]
    assert search(spark, few, 20) == expected_search(few, 20)
    assert search(spark, [(0, [1.0])], 20) == Counter()
    assert search(spark, [(1, [1.0]), (2, [2.0])], 20) == Counter()
    assert search(spark, ODD_VECTORS[:5], 20) == Counter()
    large = [(k * 10, [float(k * 1e5), 7.0, -1e4]) for k in range(30)]
    assert search(spark, large, 4) == expected_search(large, 4)
    with pytest.raises(ValueError, match="may not fit"):
        search(spark, [(0, [1e30]), (1, [1.0])], 3)
