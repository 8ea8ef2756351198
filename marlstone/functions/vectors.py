"""Vector arithmetic on ``array<float>`` columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COSINE_FLOOR = 1e-9


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def dot(a: Column, b: Column) -> Column:
    """Inner product; raises when the lengths differ."""
    product = _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    differ = F.raise_error(F.lit("vectors of unequal length")).cast("double")
    return F.when(F.size(a) == F.size(b), product).otherwise(differ)


def norm(v: Column) -> Column:
    return F.sqrt(_sum(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """``dot / (|a||b| + 1e-9)``; a zero vector scores 0."""
    return dot(a, b) / (norm(a) * norm(b) + F.lit(COSINE_FLOOR))


def squared_distance(a: Column, b: Column) -> Column:
    def gap(x: Column, y: Column) -> Column:
        return (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))

    return _sum(F.zip_with(a, b, gap))


def normalize(v: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    from marlstone.functions.arrays import let

    return let(
        F.struct(v.alias("v"), norm(v).alias("n")),
        lambda s: F.transform(
            s["v"],
            lambda x: F.when(s["n"] > 0, x.cast("double") / s["n"]).otherwise(F.lit(0.0)),
        ),
    )
