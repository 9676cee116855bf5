"""Dense vectors held as ``ARRAY<FLOAT>`` or ``ARRAY<DOUBLE>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    """Dot product in double precision, whatever the element type is."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def has_direction(vector: Column) -> Column:
    """Whether any part differs from 0; stops at the first that does."""
    return F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def length(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine(left: Column, left_length: Column, right: Column, right_length: Column) -> Column:
    """Cosine of two vectors whose lengths are known; lengths are worked out once per vector."""
    return dot(left, right) / (left_length * right_length)
