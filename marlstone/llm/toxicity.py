"""Toxicity by a subsequence string kernel with Nyström landmarks and a linear support vector machine.

Two words are as similar as the subsequences of three letters they share, each weighted down by the span it
takes, so letters put in or left out cost little. Landmarks are words of labelled texts. A text's value for a
landmark is that of its most similar word; values are whitened by the landmarks' own kernel matrix (Nyström)
and a support vector machine with squared hinge loss separates them. Words are read whole: marks inside a word
are left out and letters standing alone one after another are joined before comparing.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.memo import Memo, turn_to
from marlstone.plans.durable import durable

DECAY = 0.6
SPAN = 5
LONGEST = 32
LEAST_SIMILAR = 0.5
CERTAIN = 3.0
REMEMBERED_BYTES = 48_000_000
GROUP = 64
GROUP_CHARS = 2_000_000
TASKS = 48
_RECORD = np.dtype([("at", "<u2"), ("value", "<f4")])
_SINGLE = b"\0"  # a single letter like no landmark
# Look-alike signs are read as the letters they stand for.
_ALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
_STEPS = [s for s in itertools.product(range(1, SPAN), repeat=2) if sum(s) < SPAN]


def letters(token: str) -> str:
    """The letters of a token, lower case; look-alike signs only where there are letters beside them."""
    token = token.strip(".,;:!?\"'()[]")
    if token.isascii() and token.isalpha():
        return token.lower()
    token = unicodedata.normalize("NFKC", token).lower()
    if any(c.isalpha() for c in token):
        token = token.translate(_ALIKE)
    return "".join(c for c in token if c.isalpha())


def units(word: str) -> list[str]:
    """A word, or overlapping stretches of a very long one, none of which is left out."""
    if len(word) <= LONGEST:
        return [word] if len(word) >= 3 else []
    step = LONGEST // 2
    return [word[at : at + LONGEST] for at in range(0, len(word) - step, step)]


def subsequences(words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For words of one length at a time: their places in ``words``, letter triples and weights."""
    by_length: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        by_length.setdefault(len(word), []).append(at)
    for n, places in by_length.items():
        triples = [(i, i + a, i + a + b, DECAY ** (a + b)) for a, b in _STEPS for i in range(n - a - b)]
        if not triples:
            continue
        i, j, k, weight = (np.array(c) for c in zip(*triples, strict=True))
        raw = "".join([words[p] for p in places]).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, np.uint32).reshape(len(places), n).astype(np.int64)
        found = (codes[:, i] << 42) | (codes[:, j] << 21) | codes[:, k]
        yield np.array(places), found, weight


def _bucket(triples: np.ndarray) -> np.ndarray:
    return ((triples ^ (triples >> 21) * 31 ^ (triples >> 42) * 1021) & ((1 << 20) - 1)).astype(np.int64)


class Kernel:
    """Similarities of words to landmarks, from 0 to 1."""

    def __init__(self, landmarks: Sequence[str]):
        self.landmarks = list(landmarks)
        rows: dict[tuple[int, int], float] = {}
        for places, found, weight in subsequences(self.landmarks):
            for place, triples in zip(places.tolist(), found.tolist(), strict=True):
                for triple, w in zip(triples, weight.tolist(), strict=True):
                    rows[triple, place] = rows.get((triple, place), 0.0) + w
        norms = np.zeros(len(self.landmarks))
        for (_, place), w in rows.items():
            norms[place] += w * w
        keys = sorted(rows)
        self.triples, counts = np.unique(np.array([k[0] for k in keys], np.int64), return_counts=True)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.place = np.array([k[1] for k in keys], np.int64)
        self.value = np.array([rows[k] / np.sqrt(norms[k[1]]) for k in keys])
        self.met = np.zeros(1 << 20, bool)
        self.met[_bucket(self.triples)] = True

    def __call__(self, words: Sequence[str]) -> np.ndarray:
        """A row for each word and a column for each landmark."""
        out = np.zeros((len(words), len(self.landmarks)))
        for places, found, weight in subsequences(words):
            # A word as similar as LEAST_SIMILAR has at least its square of its own mass in landmarks' triples.
            shared = self.met[_bucket(found)] @ (weight * weight)
            likely = np.flatnonzero(shared >= 0.8 * LEAST_SIMILAR**2 * (weight @ weight))
            for at in range(0, len(likely), 512):
                some = likely[at : at + 512]
                out[places[some]] = self._some(found[some], weight)
        return out

    def _some(self, found: np.ndarray, weight: np.ndarray) -> np.ndarray:
        order = np.argsort(found, axis=1)
        sorted_ids = np.take_along_axis(found, order, 1)
        sums = np.cumsum(weight[order], axis=1)
        last = np.ones(found.shape, bool)
        last[:, :-1] = sorted_ids[:, 1:] != sorted_ids[:, :-1]
        word, column = np.nonzero(last)
        ends = sums[word, column]
        fresh = np.concatenate([[True], word[1:] != word[:-1]])
        mass = ends - np.where(fresh, 0, np.concatenate([[0], ends[:-1]]))
        norm = np.sqrt(np.bincount(word, mass * mass, minlength=len(found)))
        ids = sorted_ids[word, column]
        row = np.minimum(np.searchsorted(self.triples, ids), len(self.triples) - 1)
        known = self.triples[row] == ids
        word, mass, row = word[known], mass[known], row[known]
        many = self.first[row + 1] - self.first[row]
        ends = np.cumsum(many)
        entry = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[row] - ends + many, many)
        cell = np.repeat(word, many) * len(self.landmarks) + self.place[entry]
        size = len(found) * len(self.landmarks)
        total = np.bincount(cell, np.repeat(mass, many) * self.value[entry], minlength=size)
        return total.reshape(len(found), -1) / norm[:, None]


class Reader:
    """Landmark values of texts; what it knows of a token serves all texts of a Python worker.

    A token's record lists only the landmarks it is like, and the memory for records is bounded (``memo``).
    """

    def __init__(self, landmarks: Sequence[str], most_bytes: int = REMEMBERED_BYTES):
        self.kernel = Kernel(landmarks)
        self.records = Memo(self._learn, most_bytes)

    def _learn(self, tokens: list[str]) -> list[bytes]:
        return [r for at in range(0, len(tokens), 2048) for r in self._learn_some(tokens[at : at + 2048])]

    def _learn_some(self, tokens: Sequence[str]) -> Iterator[bytes]:
        spelled = [letters(t) for t in tokens]
        parts = [units(s) for s in spelled]
        flat = [u for p in parts for u in p]
        found = self.kernel(flat) if flat else np.zeros((0, len(self.kernel.landmarks)))
        found = np.where(found >= LEAST_SIMILAR, found, 0).astype(np.float32)
        alike = found.any(axis=1)
        at = 0
        for word, own in zip(spelled, parts, strict=True):
            record = _SINGLE if len(word) == 1 else b""
            if alike[at : at + len(own)].any():
                best = found[at : at + len(own)].max(axis=0)
                where = np.flatnonzero(best)
                values = np.empty(len(where), _RECORD)
                values["at"], values["value"] = where, best[where]
                record = values.tobytes()
            at += len(own)
            yield record

    def read(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The largest value of any word of each text, for each landmark; zeros for a text without words."""
        for group in _groups(texts):
            split = [(t or "").split() for t in group]
            records = self.records(list(itertools.chain.from_iterable(split)))
            begin = 0
            for tokens in split:
                own = records[begin : begin + len(tokens)]
                begin += len(tokens)
                alike = set(own)
                if _SINGLE in alike and own.count(_SINGLE) >= 3:
                    alike.update(self.records(_joined(tokens, own)))
                found = np.frombuffer(b"".join(alike - {_SINGLE}), _RECORD)
                best = np.zeros(len(self.kernel.landmarks), np.float32)
                np.maximum.at(best, found["at"], found["value"])
                yield best


def _groups(texts: Sequence[str | None]) -> Iterator[list[str | None]]:
    """Runs of at most ``GROUP`` texts and ``GROUP_CHARS`` characters, or one longer text."""
    group: list[str | None] = []
    chars = 0
    for text in texts:
        size = len(text or "")
        if group and (len(group) == GROUP or chars + size > GROUP_CHARS):
            yield group
            group, chars = [], 0
        group.append(text)
        chars += size
    if group:
        yield group


def _joined(tokens: list[str], records: list[bytes]) -> list[str]:
    """Words spelled in three or more letters that stand alone one after another."""
    words, run = [], []
    for token, record in zip([*tokens, ""], [*records, b""], strict=True):
        if record == _SINGLE:
            run.append(letters(token))
            continue
        if len(run) >= 3:
            words.append("".join(run))
        run = []
    return words


def reader(landmarks: Sequence[str]) -> Reader:
    """One reader per Python worker, so that what it remembers serves all its tasks."""
    key = tuple(landmarks)
    return turn_to(("toxicity", key), lambda: Reader(key))


class Model:
    """Landmarks, their whitening and the separating direction, with a logistic scale for scores."""

    def __init__(self, landmarks: Sequence[str], values: np.ndarray, toxic: np.ndarray, weight: np.ndarray):
        self.landmarks = list(landmarks)
        own = Kernel(self.landmarks)(self.landmarks)
        scale, axes = np.linalg.eigh((own + own.T) / 2)
        self.map = axes / np.sqrt(np.maximum(scale, 1e-2))
        x = np.column_stack([values @ self.map, np.ones(len(values))])
        y = np.where(toxic, 1.0, -1.0)
        self.direction = _squared_hinge(x, y, weight)
        self.scale = _logistic(x @ self.direction, y, weight)

    def score(self, values: np.ndarray) -> np.ndarray:
        margin = values @ self.map @ self.direction[:-1] + self.direction[-1]
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * margin + self.scale[1], -500, 500)))


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Newton steps on the regularised squared hinge loss; every step solves the active rows exactly."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([*[penalty * weight.sum()] * (x.shape[1] - 1), 1e-6])
    for _ in range(50):
        active = y * (x @ w) < 1
        a = x[active] * weight[active, None]
        new = np.linalg.solve(a.T @ x[active] + ridge, a.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new if _ < 25 else (w + new) / 2
    return w


def _logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slope and offset that turn margins into shares of toxic rows."""
    x, t, p = np.column_stack([margin, np.ones(len(margin))]), (y > 0).astype(float), np.array([1.0, 0.0])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        curve = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        p = p - np.linalg.solve(curve, x.T @ (weight * (q - t)) + 1e-3 * (p - [1.0, 0.0]))
    return p


def fit(
    docs: DataFrame, labels: DataFrame, *, sample_rows: int = 12_000, landmarks: int = 256, candidates: int = 20_000
) -> Model | None:
    """A model from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``toxic``); None without rows of both.

    Bounds, on fitting only: at most ``sample_rows`` labels, up to half of either kind, those with the smallest hash
    of ``doc_id``; of their words the ``candidates`` most frequent among toxic rows are compared, and ``landmarks``
    of them kept at most. Rows without text or with another label are left out.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.distinct().withColumn("__order", F.xxhash64("doc_id"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    half = sample_rows // 2
    parts = [known.where(F.col("toxic") == t).orderBy("__order", "doc_id").limit(half) for t in (0, 1)]
    ids = durable(parts[0].unionByName(parts[1]))
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    sample = durable(texts.select("text", "toxic", "__order").repartition(TASKS, "__order"))
    taken = {t: 0 for t in (0, 1)} | {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not all(taken.values()):
        return None
    chosen = _landmarks(sample, taken, landmarks, candidates)
    if not chosen:
        return None

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [v.tobytes() for v in reader(chosen).read(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), batch.column("__order"), pa.array(rows, pa.binary())],
                ["toxic", "at", "v"],
            )

    rows = sorted(sample.mapInArrow(values, "toxic int, at long, v binary").collect())
    toxic = np.array([r["toxic"] == 1 for r in rows])
    weight = np.where(toxic, counts[1] / taken[1], counts[0] / taken[0]) / sum(counts.values()) * len(rows)
    return Model(chosen, np.array([np.frombuffer(r["v"], np.float32) for r in rows], float), toxic, weight)


def _landmarks(sample: DataFrame, taken: dict[int, int], most: int, candidates: int) -> list[str]:
    """Words that toxic rows have more often than chance explains, the most telling first.

    If none passes ``CERTAIN`` standard errors, the ten most telling words serve.
    """
    tokens = F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+"))).alias("token")
    counted = sample.select("toxic", tokens).groupBy("token").agg(
        F.count_if(F.col("toxic") == 1).alias("n1"), F.count_if(F.col("toxic") == 0).alias("n0")
    )
    # Marks around a word differ, so what is counted is added up again by its letters.
    rows = counted.where("n1 > 0").orderBy(F.desc(F.col("n1") / taken[1] - F.col("n0") / taken[0]), "token").limit(candidates)
    shares: dict[str, np.ndarray] = {}
    for r in rows.collect():
        word = letters(r["token"])
        if 3 <= len(word) <= LONGEST:
            shares[word] = shares.get(word, np.zeros(2)) + [r["n0"], r["n1"]]
    size = np.array([taken[0], taken[1]], float)

    def telling(n: np.ndarray) -> float:
        share = np.minimum((n.sum() + 1) / (size.sum() + 2), 0.5)
        return float((n[1] / size[1] - n[0] / size[0]) / np.sqrt(share * (1 - share) * (1 / size).sum()))

    ranked = sorted(((-telling(n), w) for w, n in shares.items()))
    certain = [w for z, w in ranked if -z >= CERTAIN]
    return (certain or [w for _, w in ranked[:10]])[:most]


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Null and empty texts score as texts like no landmark; repeated rows score alike; without a model every score is
    0. Input columns named like the new ones are replaced; other columns are passed through unread.
    """
    plain = docs.drop("score", "predicted")
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    at = plain.columns.index("text")

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            if model is not None:
                for begin in range(0, batch.num_rows, GROUP):
                    texts = batch.column(at).slice(begin, GROUP).to_pylist()
                    found = np.array(list(reader(model.landmarks).read(texts)), float)
                    scores[begin : begin + GROUP] = model.score(found)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], schema.names)

    return plain.mapInArrow(values, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
