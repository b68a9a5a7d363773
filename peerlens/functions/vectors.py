"""Vector expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision, each product taken in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)


def length(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """The vector at length one, in double; null where it is null, empty, all zero or not finite."""
    n = length(v)
    return F.when((n > 0) & (n < float("inf")), F.transform(v, lambda x: x.cast("double") / n))


def softmax(scores: Column) -> Column:
    """Shifted by the greatest score, so no exponential overflows."""
    top = F.array_max(scores)
    parts = F.transform(scores, lambda x: F.exp(x - top))
    total = F.aggregate(parts, F.lit(0.0), lambda t, x: t + x)
    return F.transform(parts, lambda x: x / total)
