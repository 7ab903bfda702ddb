"""Arithmetic on ``ARRAY<FLOAT>`` columns, carried out in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    squares = F.aggregate(
        a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where one of the vectors has no length."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
