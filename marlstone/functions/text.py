"""Token, word and span expressions over text columns."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The words left out of keyword counts.
STOP_WORDS = (
    "the and for are but not you all can had her was one our out has his how its may new now "
    "old see two way who boy did get let put say she too use"
).split()

# One character class for whitespace, read alike by Java and RE2.
WHITE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"

WORD_RUN = r"[\p{L}\p{N}_]+"
WORD = r"(?<![\p{L}\p{N}_])[a-z]{3,}+(?![\p{L}\p{N}_])"


def strip(text: Column) -> Column:
    """Remove white space at both ends, line breaks included."""
    return F.regexp_replace(text, rf"^{WHITE}+|{WHITE}+$", "")


def words(text: Column, *, keep_stop_words: bool = False) -> Column:
    """Lower-case words of three or more ASCII letters, in text order.

    A word must be a whole run of letters, digits and underscores, so ``größe`` or
    ``abc_1`` yields no fragment.
    """
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    if keep_stop_words:
        return found
    return F.filter(found, lambda w: ~w.isin(STOP_WORDS))


def bleu_tokens(text: Column) -> Column:
    """The "13a" tokens used for corpus BLEU; case is kept."""
    line = F.regexp_replace(text, rf"{WHITE}+$", "")
    for raw, plain in (("<skipped>", ""), ("-\n", ""), ("\n", " ")):
        line = F.replace(line, F.lit(raw), F.lit(plain))
    for raw, plain in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        line = F.replace(line, F.lit(raw), F.lit(plain))
    line = F.concat(F.lit(" "), line, F.lit(" "))
    # The four spacing rules of the tokenizer.
    for pattern, spaced in (
        (r"([\{-~\[-` -&\(-\+:-@/])", " $1 "),
        (r"([^0-9])([.,])", "$1 $2 "),
        (r"([.,])([^0-9])", " $1 $2"),
        (r"([0-9])(-)", "$1 $2 "),
    ):
        line = F.regexp_replace(line, pattern, spaced)
    return F.filter(F.split(line, rf"{WHITE}+"), lambda t: t != "")


def rouge_tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def sentences(text: Column) -> Column:
    """Trimmed, non-empty sentences; a sentence ends at ``.``, ``!`` or ``?`` before white space."""
    parts = F.split(text, rf"(?<=[.!?]){WHITE}+")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def matches(text: Column, pattern: str) -> Column:
    """Every match of ``pattern`` in text order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def spans(pattern: str):
    """A function of a text column: its matches as ``(start, end, entity)``.

    Offsets count characters from 0. The only per-row Python of the text operators;
    batches cross as Arrow, and nothing is shuffled.
    """

    @F.pandas_udf("array<struct<start:int,end:int,entity:string>>")
    def find(texts: pd.Series) -> pd.Series:
        rule = re.compile(pattern, re.ASCII)
        return texts.map(
            lambda t: None
            if t is None
            else [{"start": m.start(), "end": m.end(), "entity": m.group()} for m in rule.finditer(t)]
        )

    return find
