"""Personal data replaced by keyed surrogates of the same type, script, gender and format.

An entity is its type and canonical form, so all its mentions get the same surrogate, each in its own format. A
surrogate follows from a secret key, the entity and an attempt. All distinct entities are checked against one
another and against every surrogate; where two would get the same one, or one that is real, all but the first
are drawn again until all differ. Only entities drawn more than once have to be known to rewrite the texts.

Persons are met behind a form of address and then known by their names over the whole document, with a title or
without. Each name is an entity of its own: a family name has one surrogate in all its mentions, so full, short and
untitled mentions of a person agree; given names follow the gender that the document's titles give them.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.graphs import BROADCAST_ROWS
from marlstone.plans.durable import durable

# Forms of address by gender, given and family names by script.
TITLES = {
    "m": ("Mr", "Mr.", "Herr", "M.", "Monsieur", "Sr.", "Señor", "Don", "господин"),
    "f": ("Mrs", "Mrs.", "Ms", "Ms.", "Miss", "Frau", "Mme", "Madame", "Sra.", "Señora", "Doña", "госпожа"),
    "n": ("Dr", "Dr.", "Prof.", "Mx", "Mx."),
}
GIVEN = {
    ("latin", "m"): "Adrian Bruno Carl Daniel Emil Felix Gustav Henri Ivan Jonas Leon Martin Nils Oscar Paul Simon",
    ("latin", "f"): "Alma Berta Clara Dora Elena Flora Greta Helena Irene Julia Lena Marta Nora Olga Paula Sara",
    ("latin", "n"): "Alex Andrea Charlie Dominique Eden Jamie Jordan Kim Luca Morgan Noel Robin Sam Sasha Toni Wren",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Игорь Кирилл Максим Олег Павел",
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Ксения Мария Ольга Полина",
    ("cyrillic", "n"): "Саша Женя Валя Слава Шура",
}
FAMILY = {
    "latin": "Abel Berger Castell Dorn Ender Falk Garner Hollis Imhof Jansen Keller Lorenz Morell Norden Olsen Perrin Quint Rossi Sander Tolman Ulmer Verano Weller Zeller",
    "cyrillic": "Алексеенко Бондаренко Гончар Дорошенко Иваненко Коваленко Лысенко Мороз Павленко Тарасенко",
}
# What may follow a title before the name, lower-case parts of names, and what may follow a name.
RANKS = ("Dr", "Prof", "Professor", "Professorin", "Doctor", "Doktor", "Ing.", "Dipl.-Ing.", "med.", "jur.", "phil.", "h.c.")
PARTICLES = set("von van vom der den de del della dello la le du da das do dos di zu zum zur ten ter af av bin ibn".split())
SUFFIXES = {"jr", "sr", "jun", "sen", "ii", "iii", "iv", "phd", "md", "esq"}


def _forms(titles: list[str]) -> str:
    return "|".join(re.escape(t) for t in sorted(titles, key=len, reverse=True))


_LETTER = r"[^\W\d_][\u0300-\u036f]*"
_TITLE_NAMES = [t for names in TITLES.values() for t in names]
_GAP = r"(?:(?<=\.)|[ \t\u00a0\u202f]*(?:\r?\n)?[ \t\u00a0\u202f]*(?<=\s))"
_TITLE = re.compile(rf"(?<!\w)(?P<title>{_forms(_TITLE_NAMES)}){_GAP}(?=[^\W\d_])")
_STACKED = [t for t in _TITLE_NAMES if t not in ("M.", "Miss", "Don")]
_RANK = re.compile(rf"(?:{_forms([*RANKS, *_STACKED])}){_GAP}(?=[^\W\d_])")
# A run of letters with apostrophes and hyphens inside; the s of a possessive is not part of it.
_WORD = re.compile(rf"{_LETTER}(?:{_LETTER})*(?:(?:['’ʼ](?![sS](?![\w\u0300-\u036f]))|[-‐‑]){_LETTER}(?:{_LETTER})*)*")
_INITIAL = re.compile(rf"{_LETTER}\.(?!\w*@)")
_BETWEEN = re.compile(r"[ \t\u00a0\u202f]+")
_GENDER = {t.rstrip("."): g for g, names in TITLES.items() for t in names}
_MARKED = re.compile(
    r"(?P<email>[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
    r"|(?P<secret>\bAKIA[0-9A-Z]{12,}\b|\b(?:ghp|sk|pk)[-_][A-Za-z0-9_-]{16,}"
    r"|(?<=password=)[^\s\"']+|(?<=token = \")[^\"\s]+|(?<=token=)[^\s\"']+|(?<=api_key=)[^\s\"']+)"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\w)|(?<![\w.])\+\d{8,14}(?!\w))"
)
_MAY_HOLD = re.compile(r"[0-9@]|password|token|api_key|AKIA|(?:ghp|sk|pk)[-_]")
_VOWELS, _CONSONANTS = "aeiou", "bcdfghjklmnprstvwz"


class Mention(NamedTuple):
    kind: str
    start: int
    end: int
    canonical: str
    opens: bool = True  # false for further names of one mention of a person


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _canonical(kind: str, text: str) -> str:
    if kind in ("card", "ssn"):
        return _digits(text)
    if kind == "phone":
        return _digits(text)[-10:]
    if kind == "email":
        return text.lower()
    return text.replace(" ", "") if kind == "iban" else text


def _name(word: str) -> str:
    """The canonical form of a name: the same for all spellings of its letters, hyphens and apostrophes."""
    plain = unicodedata.normalize("NFC", word) if not word.isascii() else word
    return re.sub("[‐‑]", "-", re.sub("[’ʼ]", "'", plain)).casefold()


def _titled(text: str) -> list[tuple[str, list[tuple[int, int, bool]]]]:
    """Gender and names (start, end, whether an initial) of every mention behind a form of address."""
    found, at = [], 0
    while m := _TITLE.search(text, at):
        gender, at = _GENDER[m["title"].rstrip(".")], m.end()
        while rank := _RANK.match(text, at):
            own = _GENDER.get(rank.group().strip().rstrip("."), "n")
            gender, at = own if gender == "n" else gender, rank.end()
        names, place = [], at
        while True:
            word, letter = _WORD.match(text, place), _INITIAL.match(text, place)
            if not word or (names and _RANK.match(text, place)):
                break
            shown, gap = word.group(), _BETWEEN.match(text, word.end())
            if letter and letter.end() == word.end() + 1 and not shown.islower() and len(_name(shown)) == 1:
                names.append((word.start(), word.end(), True))
                gap = _BETWEEN.match(text, letter.end())
                place = gap.end() if gap else letter.end()
                continue
            if shown.islower():
                if not (gap and shown in PARTICLES):
                    break
                place = gap.end()
                continue
            if len(_name(shown)) == 1 and (shown in "IA" or not gap):
                break
            names.append((word.start(), word.end(), len(_name(shown)) == 1 and not _alone(shown)))
            if not gap:
                break
            place = gap.end()
        while names and (names[-1][2] or _name(text[slice(*names[-1][:2])]) in SUFFIXES):
            names.pop()
        if names:
            found.append((gender, names))
            at = names[-1][1]
    return found


def _alone(name: str) -> bool:
    # One character is a whole name in scripts without case.
    return name.lower() == name.upper()


def _persons(text: str) -> list[Mention]:
    titled = _titled(text)
    if not titled:
        return []
    # What the document says of each name: whether it is a family name, and of given names the gender.
    families, given, initials = set(), {}, {}
    for gender, names in titled:
        *before, last = [_name(text[a:b]) for a, b, _ in names]
        families.add(last)
        for name, (_, _, initial) in zip(before, names, strict=False):
            if not initial and given.get(name, "n") == "n":
                given[name] = gender
            if not initial:
                initials.setdefault((name[0], last), name)
    # A given name keeps its gender where a mention of the same person has none: the family's, if it has one only.
    genders: dict[str, set[str]] = {}
    for gender, names in titled:
        if gender != "n":
            genders.setdefault(_name(text[names[-1][0] : names[-1][1]]), set()).add(gender)
    for gender, names in titled:
        known = genders.get(_name(text[names[-1][0] : names[-1][1]]), set())
        for a, b, _ in names[:-1]:
            if given.get(_name(text[a:b])) == "n" and len(known) == 1:
                given[_name(text[a:b])] = next(iter(known))

    def entity(name: str) -> str:
        return "person-family" if name in families else f"person-{given[name]}"

    out, taken = [], set()
    for gender, names in titled:
        last = _name(text[names[-1][0] : names[-1][1]])
        for k, (a, b, initial) in enumerate(names):
            name = _name(text[a:b])
            if initial:
                whole = initials.get((name[0], last))
                kind = f"initial-{gender}" if whole is None else f"initial-{entity(whole)}"
                out.append(Mention(kind, a, b, whole or name, k == 0))
            else:
                out.append(Mention(entity(name), a, b, name, k == 0))
            taken.add(a)
    end = -1
    for m in _WORD.finditer(text):
        if m.start() in taken:
            end = m.end()
            continue
        word = m.group()
        if word.islower():
            continue
        parts = [(m.start(), m.end())]
        if _known(word, families, given) is None:
            parts = [(m.start() + p.start(), m.start() + p.end()) for p in re.finditer(r"[^-‐‑]+", word)]
        for a, b in parts:
            name = _known(text[a:b], families, given)
            if name is not None and not text[a:b].islower() and (len(name) > 1 or _alone(name)):
                b -= len(_name(text[a:b])) - len(name)
                out.append(Mention(entity(name), a, b, name, not (a - 1 == end and text[end] in " \u00a0")))
                end = b
    return out


def _known(word: str, families: set[str], given: dict[str, str]) -> str | None:
    """The name that a word is, or is the genitive of."""
    name = _name(word)
    for form in (name, name[:-1] if name.endswith("s") else name):
        if form in families or form in given:
            return form
    return None


def mentions(text: str) -> list[Mention]:
    """Entities of a text in order, none inside another."""
    found = []
    if _MAY_HOLD.search(text):
        for m in _MARKED.finditer(text):
            found.append(Mention(m.lastgroup, m.start(), m.end(), _canonical(m.lastgroup, m.group())))
    found += _persons(text)
    found.sort(key=lambda m: (m.start, -m.end))
    apart, end = [], 0
    for m in found:
        if m.start >= end:
            apart.append(m)
            end = m.end
    return apart


class _Stream:
    """Numbers that follow from a key and a label."""

    def __init__(self, key: bytes, label: str):
        self.key, self.label, self.pool, self.block = key, label.encode(), 0, 0
        self.size = 1

    def below(self, n: int) -> int:
        if self.size < n << 32:
            self.block += 1
            raw = hmac.new(self.key, self.label + b"\0%d" % self.block, hashlib.sha256).digest()
            self.pool, self.size = int.from_bytes(raw, "big"), 1 << 256
        self.pool, out = divmod(self.pool, n)
        self.size //= n
        return out


def _luhn(digits: str) -> int:
    """The check digit that makes ``digits`` followed by it valid."""
    total = 0
    for at, c in enumerate(reversed(digits)):
        value = int(c) * (2 if at % 2 == 0 else 1)
        total += value - 9 if value > 9 else value
    return -total % 10


def _alike(c: str, s: _Stream) -> str:
    low = c.lower()
    if c.isdigit():
        return str(s.below(10))
    if not low.isascii() or not low.isalpha():
        return c
    letters = _VOWELS if low in _VOWELS else _CONSONANTS
    out = letters[s.below(len(letters))]
    return out.upper() if c.isupper() else out


def surrogate(key: bytes, kind: str, canonical: str, attempt: int) -> str:
    """The canonical form of an entity's replacement. Later attempts at short forms grow, so they never run out."""
    s = _Stream(key, f"{kind}\0{canonical}\0{attempt}")
    grown = "".join(str(s.below(10)) for _ in range(attempt // 8))
    if kind == "card":
        body = canonical[0] + "".join(str(s.below(10)) for _ in canonical[1:-1])
        valid = _luhn(canonical[:-1]) == int(canonical[-1])
        last = _luhn(body)
        return body + str(last if valid else (last + 1 + s.below(9)) % 10)
    if kind in ("phone", "ssn"):
        return str(2 + s.below(8)) + "".join(str(s.below(10)) for _ in canonical[1:])
    if kind == "ip":
        first = canonical.split(".")[0]
        kept = first if first in ("10", "127", "192") else str(next(n for n in iter(lambda: 1 + s.below(223), 0) if n not in (10, 127, 192)))
        return ".".join([kept, *[str(s.below(256)) for _ in range(2)], str(1 + s.below(254))])
    if kind == "email":
        local, _, domain = canonical.partition("@")
        made = "".join(_alike(c, s) for c in local) + grown
        labels = domain.split(".")
        of_domain = _Stream(key, f"domain\0{domain}")
        first = "".join(_alike(c, of_domain) for c in labels[0])
        return f"{made}@{'.'.join([first, *['example'] * max(0, len(labels) - 2), labels[-1]])}"
    if kind == "iban":
        return canonical[:2] + "".join(_alike(c, s) for c in canonical[2:])
    if kind.startswith("person"):
        script = "cyrillic" if any("а" <= c <= "я" for c in canonical) else "latin"
        pool = (FAMILY[script] if kind == "person-family" else GIVEN[script, kind[-1]]).split()
        return "-".join(pool[s.below(len(pool))] for _ in range(1 + attempt // 4))
    if kind.startswith("initial"):
        return "ABCDEFGHIJKLMNOPRSTVW"[s.below(21)]
    hexadecimal = all(c in "0123456789abcdef" for c in canonical)
    made = "".join("0123456789abcdef"[s.below(16)] if hexadecimal else _alike(c, s) for c in canonical)
    return "AKIA" + made[4:] + grown if canonical.startswith("AKIA") else made + grown


def formatted(mention: str, kind: str, made: str) -> str:
    """A surrogate written as the mention was: its separators, country prefix and case."""
    if kind in ("card", "ssn", "phone", "iban"):
        take = iter(made)
        spare = len(_digits(mention)) - len(made) if kind == "phone" else 0
        out = []
        for c in mention:
            if c.isdigit() and spare > 0:
                spare -= 1
                out.append(c)
            else:
                out.append(next(take, c) if c.isalnum() else c)
        return "".join(out)
    shouted = kind == "email" or kind.startswith("person") and len(mention) > 1
    return made.upper() if shouted and mention.isupper() else made


def _of_initial(m: Mention) -> tuple[str, str]:
    """The entity whose surrogate a mention shows: of an initial the name it stands for, where the document has it."""
    return m.kind.removeprefix("initial-") if m.kind.startswith("initial-person") else m.kind, m.canonical


def _entities(text: str) -> set[tuple[str, str]]:
    """The entities of a text that need a surrogate of their own. An initial that stands alone can't have one."""
    return {e for e in map(_of_initial, mentions(text)) if not e[0].startswith("initial")}


def entities(docs: DataFrame) -> DataFrame:
    """Distinct ``kind`` and ``canonical`` over all texts; a task sends each once."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column("text"))
            found = sorted({e for t in texts for e in _entities(t)})
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found, strict=True)], ["kind", "canonical"])

    return docs.select("text").mapInArrow(find, "kind string, canonical string").distinct()


def _family(kind: str) -> str:
    # A name's surrogate must differ from any other name's, given or family, whatever the form of address.
    return kind.split("-")[0]


def _compared(kind: str, made: str) -> str:
    return _name(made) if kind.startswith("person") else made


def redrawn(known: DataFrame, key: bytes) -> DataFrame:
    """``kind``, ``canonical`` and ``attempt`` of the entities whose first surrogate is not theirs alone."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*[c.to_pylist() for c in batch.columns], strict=True))
            made = [_compared(r[0], surrogate(key, *r)) for r in rows]
            columns = [*batch.columns, pa.array([_family(r[0]) for r in rows], pa.string()), pa.array(made, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "canonical", "attempt", "family", "made"])

    schema = "kind string, canonical string, attempt int, family string, made string"
    drawn = durable(known.withColumn("attempt", F.lit(0)).mapInArrow(draw, schema))
    real = drawn.select("family", F.col("canonical").alias("made")).distinct()
    while True:
        first = drawn.groupBy("family", "made").agg(
            F.min(F.struct("canonical", "kind")).alias("first"), F.count(F.lit(1)).alias("n")
        )
        first = first.join(real.withColumn("real", F.lit(True)), ["family", "made"], "left").where("n > 1 or real")
        judged = drawn.join(first, ["family", "made"], "left")
        mine = (F.col("first.canonical") == F.col("canonical")) & (F.col("first.kind") == F.col("kind")) & F.col("real").isNull()
        again = durable(judged.where(F.col("n").isNotNull() & ~mine).select("kind", "canonical", F.col("attempt") + 1))
        if again.isEmpty():
            return durable(drawn.where("attempt > 0").select("kind", "canonical", "attempt"))
        rest = drawn.join(again.select("kind", "canonical"), ["kind", "canonical"], "left_anti")
        drawn = durable(rest.unionByName(again.toDF("kind", "canonical", "attempt").mapInArrow(draw, schema)))


def replace(docs: DataFrame, *, key: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with entities in ``text`` replaced, and how many as ``n_replaced``.

    Null texts stay null, empty ones empty; texts of any length are read whole; repeated rows get the same result;
    an input column named ``n_replaced`` is replaced, others pass through. Redrawn entities are broadcast while they
    are few; more of them are joined to the documents that mention them.
    """
    secret = key.encode()
    again = redrawn(durable(entities(docs)), secret)
    plain = docs.drop("n_replaced", "__again")
    few = again.count() <= broadcast_rows
    known = {(r[0], r[1]): r[2] for r in again.collect()} if few else {}
    shared = docs.sparkSession.sparkContext.broadcast(known)
    source = plain if few else _with_attempts(plain, again)
    schema = T.StructType([*plain.schema.fields, T.StructField("n_replaced", T.LongType())])
    at, width = plain.columns.index("text"), len(plain.columns)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = shared.value
        for batch in batches:
            texts, counts = [], []
            own = batch.column("__again").to_pylist() if not few else [None] * batch.num_rows
            for value, attempts in zip(batch.column(at), own, strict=True):
                text = value.as_py()
                local = {(a["kind"], a["canonical"]): a["attempt"] for a in attempts or ()}
                out, end, found = [], 0, mentions(text) if text else []
                for m in found:
                    kind, canonical = entity = _of_initial(m)
                    made = surrogate(secret, kind, canonical, local.get(entity, drawn.get(entity, 0)))
                    made = made[0] if m.kind.startswith("initial") else made
                    out += [text[end : m.start], formatted(text[m.start : m.end], m.kind, made)]
                    end = m.end
                texts.append("".join([*out, text[end:]]) if found else text)
                counts.append(sum(m.opens for m in found))
            columns = list(batch.columns[:width])
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], schema.names)

    return source.mapInArrow(rewrite, schema)


def _with_attempts(docs: DataFrame, again: DataFrame) -> DataFrame:
    """``docs`` with the redrawn entities each mentions as ``__again``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            found = [(k, *e) for k, t in rows for e in sorted(_entities(t or ""))]
            if found:
                types = [pa.int64(), pa.string(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["th", "kind", "canonical"])

    each = docs.select(F.xxhash64("text").alias("th"), "text").mapInArrow(find, "th long, kind string, canonical string").distinct()
    lists = each.join(again, ["kind", "canonical"]).groupBy("th").agg(
        F.collect_list(F.struct("kind", "canonical", "attempt")).alias("__again")
    )
    return docs.join(lists, F.xxhash64("text") == F.col("th"), "left").drop("th")
