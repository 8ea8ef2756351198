"""Token ids of whole texts, encoding each distinct piece of a block of texts once.

Both tokenizers split a text before they merge, and never across a single space between two characters that
are not white space. Blocks of texts are cut there as Arrow columns; only the distinct pieces of a block reach
Python, where they are encoded by the library and remembered within a bound, and the ids of all texts are put
together from theirs by position. White space of any other kind stays inside a piece. Most pieces are plain letters
with marks behind them, where the library's splitting cuts too: of these only the distinct words are encoded, by its
merge model. A text that spells one of the tokenizer's special tokens is encoded as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marlstone.llm.memo import Memo, turn_to
from marlstone.llm.textarrays import bounded

REMEMBERED_BYTES = 48_000_000
BLOCK_BYTES = 4_000_000
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
_CUT = re.compile(r"(?<=\S) (?=\S)")
_OTHER = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in _SPACES) + "]"
# Where a space is not alone between two other characters.
_ODD = rf"^ | $|  | {_OTHER}|{_OTHER} "
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", "[.,!?;:]*"
_PLAIN = f"^(?P<word>{_LETTERS})(?P<marks>{_MARKS})(?:(?P<line>\n)(?P<next>{_LETTERS})(?P<more>{_MARKS}))?$"


class PieceEncoder:
    """Encodes texts with one of the library's tokenizers; ``keep_space`` for those that read spaces."""

    def __init__(self, path: str, keep_space: bool, most_bytes: int = REMEMBERED_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or r"(?!)", re.IGNORECASE)
        self.whole = "|".join([_ODD, *[f"(?i:{s})" for s in special]])
        self.space = " " if keep_space else ""
        self.line = np.array(self.tokenizer.encode("\n", add_special_tokens=False).ids, np.uint32)
        self.spelled = {}  # each byte as the character that stands for it in the vocabulary
        spare = iter(range(256, 512))
        for byte in range(256):
            shown = 0x21 <= byte <= 0x7E or 0xA1 <= byte <= 0xAC or 0xAE <= byte
            self.spelled[byte] = chr(byte if shown else next(spare))
        self.spaced = Memo(lambda words: self._learn_words(words, self.space), most_bytes // 2)
        self.bare = Memo(lambda words: self._learn_words(words, ""), most_bytes // 8) if keep_space else self.spaced
        self.others = Memo(lambda pieces: self._learn(pieces, self.space), most_bytes // 4)
        self.leading = Memo(lambda pieces: self._learn(pieces, ""), most_bytes // 8)

    def _learn(self, pieces: Sequence[str], space: str) -> list[bytes]:
        return [np.array(i, np.uint32).tobytes() for i in self._by_library([space + p for p in pieces])]

    def _learn_words(self, words: list[str], space: str) -> list[bytes]:
        """Words of letters, by the library's merge model alone: its normalizing and splitting leave them whole."""
        tokenize, spelled = self.tokenizer.model.tokenize, self.spelled
        raw = [space + w for w in words] if self.space else [w.lower() for w in words]
        bytewise = [w if w.isascii() else w.encode().decode("latin-1") for w in raw]
        return [np.array([t.id for t in tokenize(w.translate(spelled))], np.uint32).tobytes() for w in bytewise]

    def _by_library(self, pieces: list[str]) -> Iterator[list[int]]:
        return (e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False))

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pieces after a space, one after another, and how many each has."""
        parts = pc.extract_regex(pieces, _PLAIN)
        plain = parts.is_valid()
        found = parts.filter(plain).flatten()
        tables, atoms, known = [[b"", self.line.tobytes()]], np.zeros((len(pieces), 5), np.int64), 2

        def add(column: int, rows: np.ndarray, values: pa.Array, records) -> None:
            nonlocal known
            coded = values.dictionary_encode()
            tables.append(records(coded.dictionary.to_pylist()))
            atoms[rows, column] = coded.indices.to_numpy() + known
            known += len(tables[-1])

        at = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        names = [f.name for f in parts.type]
        word, marks, line, after, more = (found[names.index(n)] for n in ("word", "marks", "line", "next", "more"))
        second = pc.equal(line, "\n")
        twice = at[second.to_numpy(zero_copy_only=False)]
        add(0, at, word, self.spaced)
        add(1, at, marks, self._marks)
        atoms[twice, 2] = 1
        add(3, twice, after.filter(second), self.bare)
        add(4, twice, more.filter(second), self._marks)
        rest = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        add(0, rest, pieces.take(pa.array(rest)), self.others)
        records = [r for table in tables for r in table]
        sizes = np.fromiter(map(len, records), np.int64, len(records)) // 4
        flat = np.frombuffer(b"".join(records), np.uint32)
        return _taken(flat, sizes, atoms.ravel()), sizes[atoms].sum(axis=1)

    def _marks(self, marks: list[str]) -> list[bytes]:
        return [self.leading([m])[0] if m else b"" for m in marks]

    def _odd(self, text: str) -> np.ndarray:
        if self.special.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        head, *tails = _CUT.split(text)
        return np.frombuffer(b"".join(self.leading([head]) + self.others(tails)), np.uint32)

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts whose spaces all stand alone."""
        lists = pc.split_pattern(texts, " ")
        first = lists.offsets.to_numpy()
        pieces = lists.values.dictionary_encode()
        number = pieces.indices.to_numpy().astype(np.int64)
        heads = lists.values.take(pa.array(first[:-1])).dictionary_encode()
        ids, sizes = self._pieces(pieces.dictionary)
        begun = self.leading(heads.dictionary.to_pylist())
        number[first[:-1]] = heads.indices.to_numpy() + len(sizes)
        ids = np.concatenate([ids, np.frombuffer(b"".join(begun), np.uint32)])
        sizes = np.concatenate([sizes, np.fromiter(map(len, begun), np.int64, len(begun)) // 4])
        ends = np.cumsum(sizes[number])
        return np.split(_taken(ids, sizes, number), ends[first[1:-1] - 1])

    def largest_id(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True) - 1

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; null and empty texts have none."""
        for _, part in bounded(column, BLOCK_BYTES):
            texts = pc.fill_null(part, "")
            odd = pc.match_substring_regex(texts, self.whole)
            even = texts.filter(pc.invert(odd))
            plain = iter(self._plain(even) if len(even) else [])
            whole = iter(texts.filter(odd).to_pylist())
            for is_odd in odd.to_pylist():
                yield self._odd(next(whole)) if is_odd else next(plain)


def _taken(flat: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` (one after another, of the given sizes) that ``numbers`` name, in their order."""
    begin, many = np.cumsum(sizes) - sizes, sizes[numbers]
    ends = np.cumsum(many)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[numbers] - ends + many, many)]


def encoder(path: str, keep_space: bool) -> PieceEncoder:
    """One encoder per Python worker, so that what it remembers serves all its tasks."""
    return turn_to(("token ids", path, keep_space), lambda: PieceEncoder(path, keep_space))


def id_arrays(column: pa.Array, path: str, keep_space: bool, end: int) -> Iterator[np.ndarray]:
    """The ids of each text of a column, followed by the id ``end``."""
    for ids in encoder(path, keep_space).encode(column):
        yield np.append(ids, np.uint32(end))
