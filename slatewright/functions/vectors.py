"""Dense vectors held as array<double>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zeros(dims: int) -> Column:
    return F.array_repeat(F.lit(0.0), dims)


def aligned(vec: Column, dims: int) -> Column:
    """Exactly ``dims`` doubles: null vector or missing tail become zeros."""
    full = F.concat(F.coalesce(vec.cast("array<double>"), F.array().cast("array<double>")), zeros(dims))
    return F.transform(F.slice(full, 1, dims), lambda x: F.coalesce(x, F.lit(0.0)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(product: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine from a dot product and two norms; a zero vector gives 0."""
    scale = norm_a * norm_b
    return product / F.when(scale == 0, F.lit(1e-12)).otherwise(scale)


def affinity_bucket(cos: Column) -> Column:
    """low (<= .2), medium (<= .5), high (<= .8), very_high; missing gives the word nan."""
    slack = 1e-9
    return (
        F.when(cos.isNull() | F.isnan(cos) | (cos < -1.0 - slack) | (cos > 1.0 + slack), "nan")
        .when(cos <= 0.2, "low")
        .when(cos <= 0.5, "medium")
        .when(cos <= 0.8, "high")
        .otherwise("very_high")
    )
