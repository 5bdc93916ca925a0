"""Vector functions as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """The inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    """The Euclidean length."""
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector at length 1; a zero vector stays as it is."""
    n = norm(a)
    return F.transform(a, lambda x: (x.cast("double") / F.when(n == 0, F.lit(1.0)).otherwise(n)).cast("float"))


def cosine(a: Column, b: Column) -> Column:
    """The cosine of the angle; 0 where a vector is zero."""
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n)
