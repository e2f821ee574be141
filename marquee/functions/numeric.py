"""Scalar and vector arithmetic.

Vectors are ``ARRAY<DOUBLE>``; everything stays inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_scale(x: Column, cap: float, divisor: float | None = None) -> Column:
    return F.least(x.cast("double"), F.lit(float(cap))) / F.lit(float(cap if divisor is None else divisor))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def vec_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row: a column named inside
    a lambda would be computed again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def softmax(a: Column) -> Column:
    """exp(x - max) / sum, so large inputs do not overflow."""

    def spread(row: Column) -> Column:
        powers = F.transform(row["a"], lambda v: F.exp(v - row["m"]))
        return once(powers, lambda e: once(vec_sum(e), lambda z: F.transform(e, lambda v: v / z)))

    return once(F.struct(a.alias("a"), F.array_max(a).alias("m")), spread)


def argmax_label(a: Column, labels: Sequence) -> Column:
    """Label at the first position that holds the maximum."""
    choices = F.array(*[F.lit(v) for v in labels])
    return F.get(choices, (F.array_position(a, F.array_max(a)) - 1).cast("int"))


def as_doubles(a: Column) -> Column:
    return a.cast("array<double>")


def vec_sub(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def vec_mul(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def dot(a: Column, b: Column) -> Column:
    return vec_sum(vec_mul(a, b))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """NULL where a vector has no length."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(vec_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def interaction_features(history: Column, candidate: Column) -> Column:
    """``[h - c, h, c, h * c]`` as one array."""
    return F.concat(vec_sub(history, candidate), history, candidate, vec_mul(history, candidate))


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("double"), dim)
