"""The training-text operators against brute force on small tables with nulls, ties, repeats and odd texts."""

import itertools
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from oracle import difference
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from marlstone.llm import (
    chunk_dedup,
    decontaminate,
    feistel,
    graphs,
    jaccard,
    kneser_ney,
    line_dedup,
    packing,
    queries,
    surrogates,
    textarrays,
    token_files,
    toxicity,
)
from marlstone.plans.durable import durable

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
TEXTS = [None, "", " \t\n", "one two", "One  two", "one two three four five six", LONG, LONG + " end", "a" * 5000, "é ß 漢字 \x00 x"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, repeated rows and extra columns whose names clash with new ones."""
    rows = [(k, t, "en", 1, "x", -1) for k, t in enumerate(TEXTS)] + [(3, "one two", "en", 1, "x", -1)] * 2
    rows += [(None, "no id at all here", None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, shard int, score string, offset long")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, folder, name):
    assert difference(queries.QUERIES[name](spark, folder), queries.ORACLES[name], folder) is None


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000, 4097])
def test_permutation(n):
    places = feistel.permute(np.arange(n), n, "k")
    assert sorted(places) == list(range(n))
    assert (feistel.row_at(places, n, "k") == np.arange(n)).all()
    assert feistel.place_of(n - 1, n, 8, "k") == (places[-1] % 8, places[-1] // 8)


def test_shards(odd, empty):
    order = [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")).cast("binary"))]
    rows = feistel.shard(odd, order=order, shards=4, key="k").collect()
    assert len(rows) == odd.count() and {r["score"] for r in rows} == {"x", None}
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))
    again = feistel.shard(odd.repartition(5), order=order, shards=4, key="k").collect()
    assert {(r["row_number"], r["shard"], r["slot"]) for r in rows} == {(r["row_number"], r["shard"], r["slot"]) for r in again}
    assert feistel.shard(empty, order=order, shards=4, key="k").count() == 0


def library_ids(name, texts, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path(name))
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end], "<u4") for t in texts]


@pytest.mark.parametrize(("name", "keep_space"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_encode_like_the_library(name, keep_space):
    from marlstone.llm.token_ids import PieceEncoder

    parts = ["a", "B", "é", " ", "  ", "\n", "\t", "'s", "don't", "<|endoftext|>", "12", " ", "́", "漢", "😀", ".", "İ"]
    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(800)] + [t for t in TEXTS if t]
    texts += ["<|startoftext|> a <|ENDOFTEXT|>", " lead", "trail ", "a\u2003 b", "x\u00a0y z", None, "", "a  b"]
    encoder = PieceEncoder(queries.tokenizer_path(name), keep_space, most_bytes=20_000)
    for text, ids, want in zip(texts, encoder.encode(pa.array(texts)), library_ids(name, texts, 0), strict=True):
        assert ids.tolist() == want[:-1].tolist(), text


def test_packing(odd, empty):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    pieces = packing.token_pieces(odd, path=path, capacity=64, end=0, keep_ids=True)
    placed = packing.pack(pieces, order=["doc_id", "piece", "ids_crc32"], capacity=64)
    rows = placed.collect()
    by_text = dict(enumerate(library_ids("byte_bpe_50k.json", TEXTS, 0)))
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        if r["doc_id"] is not None:
            assert by_text[r["doc_id"]][r["start"] : r["start"] + r["length"]].tolist() == r["ids"]
    made = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed).collect()}
    assert max(map(len, made.values())) <= 64
    for r in rows:
        assert made[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    total = sum(r["length"] for r in rows)
    assert len(made) <= -(-total // 64) + 2
    assert packing.pack_documents(empty, path=path, capacity=64).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_length_once(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(rng.integers(1, 101, rng.integers(1, 3000)) ** (1 + seed % 2) % 100 + 1, minlength=101)
    segments = packing.plan(counts, 100)
    placed, filled = np.zeros(101, int), {}
    for s in segments:
        placed[s.length] += s.count
        for k in range(s.count):
            filled.setdefault(s.sequence + k, []).append((s.offset, s.length))
    assert placed.tolist() == counts.tolist()
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 100
    assert len(filled) <= 1.06 * (counts @ np.arange(101)) / 100 + 3


def test_ids_that_do_not_fit_are_refused(tmp_path):
    for wide in (False, True):
        writer = token_files._Writer(str(tmp_path / f"{wide}.arrow"), 4, wide)
        writer.add(np.array([1, 65_536], np.uint32))
        if wide:
            writer.close()
            assert token_files.TokenFile(str(tmp_path / "True.arrow")).ids(0, 2).tolist() == [1, 65_536]
        else:
            with pytest.raises(ValueError, match="does not fit"):
                writer.close()


def test_token_files(spark, odd, empty):
    path = queries.tokenizer_path("word_bpe_49k.json")
    files = token_files.write_token_files(odd, path=path, end=2, keep_space=False, length=16)
    rows = token_files.read_token_files(spark, files, odd.schema["doc_id"].dataType).orderBy("start").collect()
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    wanted = dict(enumerate(library_ids("word_bpe_49k.json", TEXTS, 2)))
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        if r["doc_id"] is not None:
            assert r["ids_crc32"] == zlib.crc32(wanted[r["doc_id"]].tobytes()) and r["n_tokens"] == len(wanted[r["doc_id"]])
    reader = token_files.TokenFile(f"{files[-1][0]}.ids.arrow")
    seen, mask = reader.sequence(0)
    assert len(seen) == 16 and seen[mask].tolist() == reader.ids(0, int(mask.sum())).tolist()
    assert token_files.write_token_files(empty, path=path, end=2, keep_space=False) == []


@pytest.mark.parametrize("bits", [64, 8])
def test_chunk_recipes(odd, empty, bits):
    docs = odd.unionByName(odd.select(*[(F.col(c) + 100).alias(c) if c == "doc_id" else c for c in odd.columns]))
    rows = chunk_dedup.dedup(docs, bits=bits).collect()
    assert len(rows) == docs.count()
    groups = {}
    for r in docs.collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r["text"] or ""), []).append(r)
    best = {t: min(g, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is not None, r["doc_id"])) for t, g in groups.items()}
    want = Counter((r["doc_id"], best[t]["doc_id"], len(g)) for t, g in groups.items() for r in g)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in rows) == want
    assert sum(r["kept"] for r in rows) == len(groups)
    assert chunk_dedup.dedup(empty).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup(spark, odd, empty):
    rng = np.random.default_rng(3)
    bases = ["the quick brown fox jumps over it", "a second line that is long enough", "short", "zzzz zzzz zzzz zzzz zzzz zzzz"]

    def changed(line):
        at, letter = rng.integers(0, len(line)), "qxz"[rng.integers(0, 3)]
        return [line, line[:at] + line[at + 1 :], line[:at] + letter + line[at:], line[:at] + letter + line[at + 1 :], line.upper()][rng.integers(0, 5)]

    texts = ["\n".join(changed(changed(bases[rng.integers(0, 4)])) for _ in range(rng.integers(1, 6))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["line"]) for r in line_dedup.repeated_lines(docs).collect()}
    lines = [(d, k, re.sub(r"[ \t]+", " ", x.lower()).strip()) for d, t in enumerate(texts) for k, x in enumerate(t.split("\n"))]
    lines = [x for x in lines if len(x[2]) >= 20]
    want = {(d, k) for at, (d, k, x) in enumerate(lines) if any(edits(x, y) <= 1 for _, _, y in lines[:at])}
    assert got == want
    cleaned = line_dedup.drop_repeated(odd).collect()
    assert len(cleaned) == odd.count() and {r["shard"] for r in cleaned} == {1, None}
    assert [r["text"] for r in cleaned if r["doc_id"] == 0] == [None]
    assert line_dedup.drop_repeated(empty).count() == 0


def test_many_lines_in_one_text(spark):
    other = [f"line number {k * k} of a long text" for k in range(3_000)]
    long = "\n".join(["the same long line again and again"] * 60_000 + other)
    rows = [(1, long, "a", "b", 7), (2, "short\n" + other[5] + "\nkept here", "a", "b", 7), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __gone string, __rk string, lines_dropped int")
    cleaned = line_dedup.drop_repeated(docs)
    assert cleaned.columns == docs.columns
    got = {r["doc_id"]: r for r in cleaned.collect()}
    assert got[1]["text"].split("\n")[0] == "the same long line again and again" and got[1]["lines_dropped"] >= 59_999
    assert (got[2]["text"], got[2]["lines_dropped"], got[2]["__gone"]) == ("short\nkept here", 1, "a")
    assert (got[3]["text"], got[3]["lines_dropped"]) == (None, 0)


def brute_components(texts, size, percent):
    """Set size, component and number of links of every text."""

    def of(text):
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
        return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()

    sets, label, links = {k: of(t) for k, t in texts.items()}, {k: k for k in texts}, Counter()
    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            links.update((a, b))
            low, high = sorted((label[a], label[b]))
            label = {k: low if v == high else v for k, v in label.items()}
    return {k: (len(sets[k]), label[k], links[k]) for k in texts}


def found_groups(docs, size, percent):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard.groups(docs, size=size, percent=percent).collect()}


@pytest.mark.parametrize(("size", "percent", "many"), [(4, 85, 64), (4, 85, 1), (5, 80, 3), (2, 50, 1)])
def test_jaccard_groups(spark, monkeypatch, size, percent, many):
    monkeypatch.setattr(jaccard, "MANY", many)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 5)
    rng = np.random.default_rng(size)
    texts = {}
    for base in range(6):
        words = [f"b{base}w{k}" for k in range(40)]
        for copy in range(12):
            own = list(words)
            for _ in range(rng.integers(0, 5)):
                own[rng.integers(0, 40)] = f"n{rng.integers(0, 9)}"
            texts[base * 100 + copy] = " ".join(own[: rng.integers(34, 41)])
    texts |= {900: None, 901: "", 902: "one two", 903: "ONE two", 904: "one two three"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_components(texts, size, percent)
    assert found_groups(docs, size, percent) == want
    kept = {r["doc_id"] for r in jaccard.keep_one(docs, size=size, percent=percent).collect()}
    assert kept == {k for k, (_, c, _) in want.items() if k == c}


@pytest.mark.parametrize("block_rows", [1024, 30])
def test_large_group_of_near_copies(spark, monkeypatch, block_rows):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(60)]
    texts = {}
    for k in range(120):
        own = list(words)
        for _ in range(3):
            own[rng.integers(0, 60)] = f"x{k}"
        texts[k] = " ".join(own)
    texts |= {200: texts[7], 201: texts[7], 202: texts[9] + " end"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert found_groups(docs, 2, 85) == brute_components(texts, 2, 85)


@pytest.mark.parametrize("many", [8, 64])
def test_near_copies_travel_few_times(spark, monkeypatch, many):
    """Whole sets in blocks, or texts in groups, are sent about once per row, not once per common column or pair."""
    monkeypatch.setattr(jaccard, "MANY", many)
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(120)]
    texts = {}
    for k in range(40):
        own = list(words)
        for _ in range(2):
            own[rng.integers(0, 120)] = f"x{k}"
        texts[k] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sent = []

    def counted(name, count):
        plain = getattr(jaccard, name)

        def call(*given):
            out = plain(*given)
            sent.append(count(out))
            return out

        monkeypatch.setattr(jaccard, name, call)

    counted("_blocks", lambda blocks: sum(len(r["rows"]) // 8 for r in blocks.select("rows").collect()))
    counted("_texts_of", lambda texts: texts.count())
    assert found_groups(docs, 3, 80) == brute_components(texts, 3, 80)
    assert max(sent) >= 40 and sum(sent) <= 4 * 40


def test_written_tables_leave_no_shuffle_files(spark):
    """A stage's tables replace the shuffle files they were made from, and the session's setting is as before."""
    from marlstone.plans.durable import SHUFFLES_GO

    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return sum(Path(d.getPath()).is_dir() and len(list(Path(d.getPath()).rglob("shuffle_*.data"))) for d in manager.localDirs())

    before, told = shuffled(), spark.conf.get(SHUFFLES_GO, None)
    table = durable(spark.range(1000).withColumn("k", F.col("id") % 7).repartition(4).groupBy("k").count())
    for _ in range(50):  # files go a moment later
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and spark.conf.get(SHUFFLES_GO, None) == told
    assert table.count() == 7


def test_overlaps_over_ranges(monkeypatch):
    monkeypatch.setattr(jaccard, "RANGE", 3)
    rng = np.random.default_rng(2)
    sets = [[np.unique(rng.integers(0, 30, n)).astype(np.uint64) for n in rng.integers(0, 20, m)] for m in (7, 5)]
    parts = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s]), len(s)) for s in sets]
    got = jaccard._overlaps(*parts[0], *parts[1])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[1]] for a in sets[0]]


def test_jaccard_odd_rows(odd, empty):
    rows = jaccard.groups(odd, size=4, percent=85).collect()
    assert len(rows) == odd.count()
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect())[3] == 1
    assert jaccard.groups(empty, size=4, percent=85).count() == 0 and jaccard.keep_one(empty).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 101), (101, 100), (200, 300), (300, 250)]
    got = dict(graphs.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 0 for k in range(31)} | {100: 100, 101: 100} | {200: 200, 250: 200, 300: 200}


def brute_hits(text, items):
    def of(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    words, hit, found = of(text), set(), set()
    for item, body in items:
        w = of(body)
        m = min(13, len(w))
        for at in range(len(w) - m + 1 if w else 0):
            for p in range(len(words) - m + 1):
                if words[p : p + m] == w[at : at + m]:
                    hit.update(range(p, p + m))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_rows", [100_000, 3])
def test_decontamination(spark, odd, empty, block_rows):
    passage = [f"p{k}" for k in range(20)]
    items = [(1, " ".join(passage)), (2, "Short Item"), (3, None), (4, "..."), (10, "the the the"), (11, " ".join(passage[3:]) + " tail"), (12, "é")]
    texts = ["x " + " ".join(passage) + " y", " ".join(passage[2:16]).upper(), " ".join(passage[:12]), "a short item, short item", "the the the the", "É é", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in decontaminate.find(docs, table, block_rows=block_rows).collect()}
    assert got == {k: brute_hits(t, items) for k, t in enumerate(texts)}
    if block_rows > 3:
        assert decontaminate.find(odd, table).count() == odd.count()
        assert decontaminate.find(empty, table).count() == 0
        assert decontaminate.find(docs, table.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_toxicity(spark, folder, odd, empty):
    labels = spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.01')}/labels.parquet")
    docs = queries.documents(spark, folder.replace("sf0.001", "sf0.01"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held))
    scored = toxicity.score(docs, model).join(labels.where(held), "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in scored)
    assert right / len(scored) > 0.93
    cases = spark.createDataFrame([(1, "you are an id.iot and a lo-ser"), (2, "what an i d i o t"), (3, "the that with")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(cases, model).collect()}
    assert min(got[1], got[2]) > got[3]
    assert toxicity.score(odd, model).count() == odd.count() and toxicity.score(empty, model).count() == 0
    assert toxicity.fit(docs, labels.where("toxic = 1")) is None
    assert {r["score"] for r in toxicity.score(cases, None).collect()} == {0.0}


def test_similarity_is_the_normalised_kernel():
    def features(word):
        out = Counter()
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if k - i < toxicity.SPAN:
                out[word[i] + word[j] + word[k]] += toxicity.DECAY ** (k - i)
        return out

    words, marks = ["idiot", "idxiot", "banana", "idiotidiot"], ["idiot", "banana", "worthless"]
    got = toxicity.Kernel(marks)(words)
    for (a, w), (b, m) in itertools.product(enumerate(words), enumerate(marks)):
        x, y = features(w), features(m)
        want = sum(x[t] * y[t] for t in x) / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
        assert got[a, b] == pytest.approx(want if want >= toxicity.LEAST_SIMILAR else got[a, b])
        assert got[a, b] <= want + 1e-9


def brute_kneser_ney(texts):
    order, codes = kneser_ney.ORDER, [[0] * (kneser_ney.ORDER - 1) + [ord(c) for c in t] for t in texts]
    counts = {order: Counter(tuple(c[i - order + 1 : i + 1]) for c in codes for i in range(order - 1, len(c)))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    chars = len(counts[1]) + 1

    def probability(g):
        if not g:
            return 1 / chars
        c = counts[len(g)]
        n = [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        share = n[0] / max(n[0] + 2 * n[1], 1)
        cut = [min(max(k - (k + 1) * share * n[k] / max(n[k - 1], 1), 0.1), k - 0.05) for k in (1, 2, 3)]
        after = [v for x, v in c.items() if x[:-1] == g[:-1]]
        low = probability(g[1:])
        if not after:
            return low
        less = sum(cut[min(v, 3) - 1] for v in after)
        own = c.get(g, 0)
        return (own - (cut[min(own, 3) - 1] if own else 0)) / sum(after) + less / sum(after) * low

    return probability


@pytest.mark.parametrize("shard_rows", [1_000_000, 40])
def test_perplexity(spark, shard_rows):
    texts = ["abracadabra", "abra cadabra", "banana abra", "cab", "añb 漢"]
    table = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    model = kneser_ney.train(table)
    rows = [(1, "en", "abra"), (2, "en", "zzz banana"), (3, "en", None), (4, "xx", "abra"), (None, "en", "cab"), (1, "en", "abra")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = kneser_ney.perplexities(docs, model, shard_rows=shard_rows).collect()
    assert len(got) == len(rows)
    folded = ["".join(chr(ord(c) if ord(c) < 2048 else 2048 + ord(c) % 2048) for c in t) for t in texts]
    probability = brute_kneser_ney(folded)
    for key, text in ((1, "abra"), (2, "zzz banana"), (None, "cab")):
        padded = [0] * (kneser_ney.ORDER - 1) + [ord(c) for c in text]
        logs = [np.log(probability(tuple(padded[i : i + kneser_ney.ORDER]))) for i in range(len(text))]
        for r in got:
            if r["doc_id"] == key:
                assert r["perplexity"] == pytest.approx(np.exp(-np.mean(logs)), rel=1e-4)
    assert all(r["perplexity"] is None for r in got if r["doc_id"] in (3, 4))


def test_perplexity_tells_characters_of_any_script_apart(spark):
    text = "漢字仮名交じり文は日本語の表記法である。" * 3
    other = "".join(chr(ord(c) + 2048) for c in text)
    model = kneser_ney.train(spark.createDataFrame([("ja", text), ("ja", "한국어 문장")], "lang string, text string"))
    docs = spark.createDataFrame([(1, "ja", text), (2, "ja", other), (3, "ja", "😀" + text)], "doc_id long, lang string, text string")
    got = {r["doc_id"]: r["perplexity"] for r in kneser_ney.perplexities(docs, model).collect()}
    assert got[1] < 5 and got[2] > 3 * got[1] and got[3] > got[1]
    probability = brute_kneser_ney([text, "한국어 문장"])
    for key, value in ((1, text), (2, other), (3, "😀" + text)):
        padded = [0] * (kneser_ney.ORDER - 1) + [ord(c) for c in value]
        logs = [np.log(probability(tuple(padded[i : i + kneser_ney.ORDER]))) for i in range(len(value))]
        assert got[key] == pytest.approx(np.exp(-np.mean(logs)), rel=1e-4)


@pytest.mark.parametrize("spread", [1, 60_000])
def test_counts_of_many_different_characters(spread):
    points = np.random.default_rng(3).integers(0x4E00, 0x4E00 + spread, 9000)
    texts = ["".join(map(chr, points[k : k + 1500])) for k in range(0, 9000, 1500)] + ["", "é"]
    if spread > 1:
        texts = [t.encode("utf-32-le", "replace").decode("utf-32-le") for t in texts]
    f, g, many = kneser_ney._counted(*kneser_ney.codes(texts))
    want = Counter(zip(*(x.tolist() for x in kneser_ney.grams(*kneser_ney.codes(texts))), strict=True))
    assert dict(zip(zip(f.tolist(), g.tolist(), strict=True), many.tolist(), strict=True)) == want
    assert sum(want.values()) == sum(map(len, texts))


def test_quality_keeps_clean_text(spark, folder, odd, empty):
    rows = queries.QUERIES["op2_kneser_ney_quality"](spark, folder).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    good = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1]
    assert np.mean(good) > 0.9
    trusted = odd.select("doc_id")
    assert kneser_ney.classify(odd, trusted).count() == odd.count()
    assert kneser_ney.classify(empty, trusted).count() == 0


def test_surrogates(spark, odd, empty):
    texts = [
        "Write to anna.k@mail.example.com or Anna.K@mail.example.com from 10.1.2.3.",
        "Call +1 (988) 555-2485, then 988-555-2485. Card 4539 1488 0343 6467.",
        "Herr Karl Weber met Frau Weber; г-н and господин Иванов. token = \"0641917ea4e9feb9cda83477b57ac2654884f485\"",
        "nothing here", None, "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_replaced"]) for r in surrogates.replace(docs, key="k").collect()}
    assert [got[k][0] for k in (3, 4, 5)] == ["nothing here", None, ""]
    mails = re.findall(r"\S+@\S+", got[0][0])
    assert len(set(m.lower() for m in mails)) == 1 and "anna" not in got[0][0].lower()
    phones = re.findall(r"\+1 \((\d{3})\) (\d{3})-(\d{4})|(\d{3})-(\d{3})-(\d{4})", got[1][0])
    assert len({"".join(p) for p in phones}) == 1 and "555-2485" not in got[1][0]
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", got[1][0])[0].replace(" ", "")
    assert surrogates._luhn(card[:-1]) == int(card[-1]) and card != "4539148803436467"
    assert "Weber" not in got[2][0] and "Иванов" not in got[2][0] and "0641917e" not in got[2][0]
    again = {r["doc_id"]: r["text"] for r in surrogates.replace(docs.repartition(3), key="k").collect()}
    assert again == {k: v[0] for k, v in got.items()}
    assert surrogates.replace(odd, key="k").count() == odd.count() and surrogates.replace(empty, key="k").count() == 0


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_surrogates_stay_distinct(spark, broadcast_rows):
    mails = [f"{a}{b}@mail.example.com" for a in "abcdefgh" for b in "aeioubcd"]
    docs = spark.createDataFrame([(k, m) for k, m in enumerate(mails)], "doc_id long, text string")
    made = [r["text"] for r in surrogates.replace(docs, key="k", broadcast_rows=broadcast_rows).collect()]
    assert len(set(made)) == len(mails) and not set(made) & set(mails)


@pytest.mark.parametrize(
    ("text", "left"),
    [
        ("Frau Dr. Weber kam mit Herr Prof. Dr. Abelein-Müller.", "Frau Dr. # kam mit Herr Prof. Dr. #."),
        ("Mr McDonald met Mr O'Brien and Mr Dvořák; McDonald's car.", "Mr # met Mr # and Mr #; #'s car."),
        ("Mr Dvor\u030ca\u0301k and Mr John Fitzgerald Kennedy", "Mr # and Mr # # #"),
        ("Mr Karl Weber, Mr Weber, Dr. Karl Weber. Weber left, KARL WEBER too.", "Mr # #, Mr #, Dr. # #. # left, # # too."),
        ("Frau von der Leyen, Mr J. Smith Jr. said. Leyen and weber.", "Frau von der #, Mr #. # Jr. said. # and weber."),
        ("Die Frau. Dann kam niemand. Mr the end", "Die Frau. Dann kam niemand. Mr the end"),
    ],
)
def test_surrogates_find_whole_names(text, left):
    out, end = [], 0
    for m in surrogates.mentions(text):
        out += [text[end : m.start], "#"]
        end = m.end
    assert "".join([*out, text[end:]]) == left


def test_surrogates_of_one_person_agree(spark):
    texts = [
        "Mr Karl Weber met Mr Weber and Dr. Karl Weber. Weber left. Webers Haus. KARL WEBER",
        "Mr Karl Weber and Mr Karl Dvořák. Mr John Fitzgerald Kennedy, J. Kennedy, Mr J. Kennedy",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_replaced"]) for r in surrogates.replace(docs, key="k").collect()}
    name = r"([\w-]+)"
    found = re.fullmatch(rf"Mr {name} {name} met Mr {name} and Dr. {name} {name}. {name} left. {name} Haus. {name} {name}", got[0][0])
    given, family = found[1], found[2]
    assert found.groups() == (given, family, family, given, family, family, family + "s", given.upper(), family.upper())
    assert got[0][1] == 6 and not {given, family} & {"Karl", "Weber"}
    found = re.fullmatch(rf"Mr {name} {name} and Mr {name} {name}. Mr {name} {name} {name}, J. {name}, Mr (\w). {name}", got[1][0])
    assert found.groups()[:3] == (given, family, given)
    assert found[4] != family and found[8] == found[7] == found[10] and found[9] == found[5][0]


def test_shingles_of_words():
    texts = ["A b  c\td", None, "", "a b c", "a b c d e", "ab c d e"]
    found = [len(s) for s in textarrays.shingles(pa.array(texts), 4)]
    assert found == [1, 0, 0, 1, 2, 1]
    a, _, _, d, e, f = textarrays.shingles(pa.array(texts), 4)
    assert a[0] in e and d[0] not in e and f[0] not in e
    blocks = list(textarrays.bounded(pa.array([LONG] * 20), limit=1 << 20))
    assert [at for at, _ in blocks] == sorted({at for at, _ in blocks}) and sum(len(p) for _, p in blocks) == 20


def test_pipeline(spark, folder):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, folder))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    left = {r["doc_id"] for r in docs.collect()}
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in packed} == left and left


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert Path(queries.__file__).parent.name == "llm"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stage_takes_odd_rows(spark, odd, empty, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, folder)
    rows = out.collect()
    if name == corpus_pipeline.STAGES[-1][0]:
        assert sum(r["piece"] == 0 for r in rows) == odd.count()
    else:
        assert out.columns == odd.columns
        before, after = Counter(map(tuple, odd.select("doc_id", "lang", "shard", "score", "offset").collect())), Counter(tuple(r[c] for c in ("doc_id", "lang", "shard", "score", "offset")) for r in rows)
        assert not after - before
        assert {0, 1, 2, None} <= {r["doc_id"] for r in rows}  # texts without words, and rows without an id
        copies = sum(r["doc_id"] == 3 for r in rows)
        assert copies == (1 if name == "near_duplicates" else 3)
    assert stage(spark, empty, folder).count() == 0
