"""Language, imports and one-line summaries of source text; all row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import code as C


def language(df: DataFrame, *, code_col: str) -> DataFrame:
    """Add ``language`` and one score column per candidate language."""
    scores = C.language_scores(F.col(code_col))
    scored = df.withColumns({f"score_{name}": score for name, score in scores.items()})
    return scored.withColumn(
        "language", C.best_language({name: F.col(f"score_{name}") for name in scores})
    )


def imports(df: DataFrame, *, key: str, code_col: str, language: str | Column) -> DataFrame:
    """One row per import statement, in text order."""
    lang = F.lit(language) if isinstance(language, str) else language
    return df.select(key, F.posexplode(C.import_lines(F.col(code_col), lang)).alias("at", "statement"))


def import_counts(imports: DataFrame, *, key: str) -> DataFrame:
    """How many statements, and in how many texts, each import occurs."""
    per_text = imports.groupBy("statement", key).agg(F.count(F.lit(1)).alias("n"))
    return per_text.groupBy("statement").agg(
        F.sum("n").alias("statements"), F.count(F.lit(1)).alias("texts")
    )


def summary(df: DataFrame, *, code_col: str) -> DataFrame:
    """Add the function name, a one-line summary and whether a docstring gave it."""
    code = F.col(code_col)
    line, name = C.docstring_line(code), C.function_name(code)
    return df.withColumns(
        {
            "name": name,
            "summary": F.coalesce(line, F.concat(F.lit("Function/method named "), name)),
            "has_docstring": line.isNotNull(),
        }
    )
