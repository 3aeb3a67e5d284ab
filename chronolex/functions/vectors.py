"""Vector arithmetic on array columns, in doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """The vector at length 1; a zero vector stays."""
    n = norm(v)
    return F.when(n == 0, doubles(v)).otherwise(F.transform(doubles(v), lambda x: x / n))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))
