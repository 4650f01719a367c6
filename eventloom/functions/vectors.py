"""Vector expressions over array columns of floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def mean_vector(vectors: Column, size: int) -> Column:
    """Element-wise mean of an array of vectors; zeros if there are none."""
    zeros = F.array(*[F.lit(0.0)] * size)
    total = F.aggregate(vectors, zeros, lambda s, v: F.zip_with(s, v, lambda x, y: x + y.cast("double")))
    return F.when(F.size(vectors) > 0, F.transform(total, lambda x: x / F.size(vectors))).otherwise(zeros)
