"""Categorical encoders as column expressions (M8-M12) and time helpers.

Two hash methods are offered.  ``xxhash64`` is the default and the fast one;
``md5`` is reproducible by any SQL engine that has md5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 19 genres of the catalogue, in vocabulary order.
GENRE_VOCABULARY = [
    "Film-Noir", "Action", "Adventure", "Horror", "Romance", "War", "Comedy",
    "Western", "Documentary", "Sci-Fi", "Drama", "Thriller", "Crime", "Fantasy",
    "Animation", "IMAX", "Mystery", "Children", "Musical",
]

# Bucket bounds of the word-vector scores.
W2V_SCORE_BOUNDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.93, 0.97]


def md5_int(x: Column) -> Column:
    """First 60 bits of md5 as a non-negative BIGINT."""
    return F.conv(F.substring(F.md5(x.cast("string").cast("binary")), 1, 15), 16, 10).cast("bigint")


def stable_hash(cols: Sequence[Column], method: str = "xxhash64") -> Column:
    """One hash of a tuple of values; the md5 form is length-prefixed, so that
    ('a', 'bc') and ('ab', 'c') differ."""
    if method == "xxhash64":
        return F.xxhash64(*cols)
    if method != "md5":
        raise ValueError(f"unknown hash method {method!r}")
    if len(cols) == 1:
        return md5_int(cols[0])
    parts = []
    for c in cols:
        text = F.coalesce(c.cast("string"), F.lit(""))
        parts += [F.length(text).cast("string"), F.lit(":"), text]
    return md5_int(F.concat(*parts))


def hash_bucket(x: Column, n: int, method: str = "xxhash64") -> Column:
    return F.pmod(stable_hash([x], method), F.lit(n))


def cross_bucket(cols: Sequence[Column], n: int = 10_000, method: str = "xxhash64") -> Column:
    return F.pmod(stable_hash(cols, method), F.lit(n))


def vocab_index(x: Column, vocab: Sequence[str]) -> Column:
    """Position in a short list; -1 when unknown or NULL.  For a vocabulary
    that is a table use :func:`marquee.operators.encoding.vocab_index_join`."""
    words = F.array(*[F.lit(v) for v in vocab])
    return (F.coalesce(F.array_position(words, x), F.lit(0)) - F.lit(1)).cast("int")


def identity_index(x: Column, n: int, invalid: str = "raise") -> Column:
    """The integer itself when in [0, n); otherwise an error or NULL."""
    inside = (x >= 0) & (x < n)
    if invalid == "null":
        return F.when(inside, x)
    if invalid != "raise":
        raise ValueError("invalid must be 'raise' or 'null'")
    message = F.concat(F.lit(f"id outside [0, {n}): "), F.coalesce(x.cast("string"), F.lit("NULL")))
    return F.when(inside, x).otherwise(F.raise_error(message).cast("bigint"))


def bucketize(x: Column, bounds: Sequence[float]) -> Column:
    """Left-closed buckets: the number of bounds that are <= x."""
    total = F.lit(0)
    for b in bounds:
        total = total + F.when(x >= F.lit(b), 1).otherwise(0)
    return F.when(x.isNotNull(), total)


def bucketize_by_array(x: Column, bounds: Column) -> Column:
    """As :func:`bucketize` with data-driven bounds in an array column."""
    return F.size(F.filter(bounds, lambda b: b <= x))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp, whatever the session zone."""
    day = F.unix_date(ts.cast("date")).cast("bigint")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
