"""Language, import and docstring expressions over columns of source text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone.functions.text import strip

# The marks of each language, in tie-breaking order.
LANGUAGE_MARKS = {
    "python": [r"\bdef\s+\w+\s*\(", r"\bimport\s+\w+", r"\bfrom\s+\w+\s+import", r":\s*$"],
    "javascript": [r"\bfunction\s+\w+", r"\bconst\s+\w+\s*=", r"=>", r"require\("],
    "typescript": [r"\binterface\s+\w+", r":\s*\w+\s*[=;]", r"\btype\s+\w+\s*="],
    "java": [r"\bpublic\s+class\b", r"\bSystem\.out\.println", r"\bvoid\s+\w+\s*\("],
    "go": [r"\bfunc\s+\w+", r"\bpackage\s+\w+", r":="],
    "rust": [r"\bfn\s+\w+", r"\blet\s+mut\b", r"\bimpl\s+"],
    "cpp": [r"#include\s*<", r"\bstd::", r"\bint\s+main\s*\("],
    "sql": [r"\bSELECT\b", r"\bFROM\b", r"\bWHERE\b"],
}

# Import statements by language, and where a docstring and a name stand.
PYTHON_IMPORT = r"^(?:from\s+[\w.]+\s+)?import\s+.+$"
SCRIPT_IMPORT = r"^(?:import\s+.+from\s+['\"].+['\"]|const\s+\w+\s*=\s*require\(.+\))"
DOCSTRINGS = (r'"""(.*?)"""', r"'''(.*?)'''")
FUNCTION_NAME = r"(?:def|function|fn)\s+(\w+)"

# Multi-line, "\n" as the only line end, Unicode classes.
_LINES = "(?mdU)"


def language_scores(code: Column) -> dict[str, Column]:
    """How many of each language's marks occur anywhere in the text."""
    return {
        language: reduce(
            Column.__add__,
            [code.rlike(f"(?imdU){mark}").cast("int") for mark in marks],
        )
        for language, marks in LANGUAGE_MARKS.items()
    }


def best_language(scores: dict[str, Column]) -> Column:
    """The first language with the highest score, ``unknown`` when nothing matched."""
    top = F.greatest(*scores.values())
    choice = F.when(top == 0, F.lit("unknown"))
    for language, score in scores.items():
        choice = choice.when(score == top, F.lit(language))
    return choice


def import_lines(code: Column, language: Column) -> Column:
    none = F.array().cast("array<string>")
    return (
        F.when(
            language == "python",
            F.regexp_extract_all(code, F.lit(_LINES + PYTHON_IMPORT), F.lit(0)),
        )
        .when(
            language.isin("javascript", "typescript"),
            F.regexp_extract_all(code, F.lit(_LINES + SCRIPT_IMPORT), F.lit(0)),
        )
        .otherwise(none)
    )


def function_name(code: Column) -> Column:
    name = F.regexp_extract(code, "(?U)" + FUNCTION_NAME, 1)
    return F.when(name == "", F.lit("anonymous")).otherwise(name)


def docstring_line(code: Column) -> Column:
    """First line of the first docstring; NULL when there is none or it is blank."""
    double, single = ("(?s)" + pattern for pattern in DOCSTRINGS)
    body = F.when(code.rlike(double), F.regexp_extract(code, double, 1)).when(
        code.rlike(single), F.regexp_extract(code, single, 1)
    )
    return F.nullif(F.substring_index(strip(body), "\n", 1), F.lit(""))
