"""Vector expressions. Sums run in double precision; storage is float."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when one of the vectors is all zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def has_dims(a: Column, dims: int) -> Column:
    return a.isNotNull() & (F.size(a) == dims)
