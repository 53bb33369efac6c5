"""Vector arithmetic on array<float> columns, in codegen-friendly higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .compat import col


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(F.aggregate(col(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def normalize(a: str | Column) -> Column:
    """Unit vector as array<double>; a zero vector stays zero."""
    n = norm(a)
    return F.transform(col(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def cosine(a: str | Column, b: str | Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)
