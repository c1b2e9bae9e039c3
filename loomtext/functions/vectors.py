"""Vector functions on array columns, in double precision."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Sum of products over the common length; null if either is null."""
    products = F.zip_with(_as_double(a), _as_double(b), lambda x, y: F.coalesce(x * y, F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(_as_double(v), F.lit(0.0), lambda acc, x: acc + F.coalesce(x * x, F.lit(0.0))))


def l2_normalize(v: Column) -> Column:
    """At unit length; a zero vector stays zero, null stays null."""
    n = l2_norm(v)
    return F.transform(_as_double(v), lambda x: x / F.when(n == 0, 1.0).otherwise(n))


def fit_width(v: Column, width: int) -> Column:
    """Padded with zeros or cut to the width."""
    return F.slice(F.concat(_as_double(v), F.array_repeat(F.lit(0.0), width)), 1, width)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0.0 if either is a zero vector, null if either is null."""
    d = l2_norm(a) * l2_norm(b)
    return F.when(d == 0, 0.0).otherwise(dot(a, b) / d)


def cosine_to(v: Column, query: list[float]) -> Column:
    """Cosine similarity to one given vector, whose norm is taken once."""
    norm = math.sqrt(sum(x * x for x in query))
    if norm == 0:
        return F.when(v.isNotNull(), 0.0)
    n = l2_norm(v)
    return F.when(n == 0, 0.0).otherwise(dot(v, F.lit([x / norm for x in map(float, query)])) / n)
