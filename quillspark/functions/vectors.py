"""Vector expressions, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine over the shorter length; 0 where either is zero."""
    n = norm(a) * norm(b)
    return F.when(n == 0, 0.0).otherwise(dot(a, b) / n)


def normalized(a: Column) -> Column:
    n = norm(a)
    return F.when(n == 0, F.transform(a, lambda x: x.cast("double"))).otherwise(F.transform(a, lambda x: x.cast("double") / n))


def vector_literal(a: Column) -> Column:
    """A vector as text, ``[1.0,2.5]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(a, lambda x: x.cast("string")), ","), F.lit("]"))


def parsed_vector(x: Column) -> Column:
    """The vector that such a text holds; null if any part is no number."""
    body = F.regexp_replace(x, r"[\[\]\s]", "")
    parts = F.transform(F.filter(F.split(body, ","), lambda t: t != ""), lambda t: t.try_cast("double"))
    return F.when(~F.exists(parts, lambda v: v.isNull()), parts)
