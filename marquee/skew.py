"""Hot keys: find them, join around them, and window through them.

One user or one movie may own a third of all rows.  Plain aggregates survive
that by partial aggregation, but three shapes do not:

* a join against a dimension -> :func:`skew_join`
* a group total put back on every row -> :func:`with_group_totals`
* an ordered window over the key -> :func:`sliced` plus a carry table

All three are exact for *any* set of hot keys; the set only steers the work.
"""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.durable import written

# A key is hot when it is among the MAX_HOT_KEYS biggest and above HOT_ROWS.
# Every other key then holds at most max(HOT_ROWS, total / MAX_HOT_KEYS) rows,
# and the hot list is never longer than MAX_HOT_KEYS, so it may be broadcast.
MAX_HOT_KEYS = 10_000
HOT_ROWS = 1_000_000
SALTS = 64

SLICE = "_slice"
SALT = "_salt"


def hottest(counts: DataFrame, keys: Sequence[str], count_col: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hot keys from a table that already has one count per key.

    The list is fetched now and becomes a local table: it is at most
    ``MAX_HOT_KEYS`` rows, every branch of the plan sees the same list, and a
    caller that finds it empty can leave the detour out of the plan.
    """
    found = (
        counts.filter(F.col(count_col) > hot_rows)
        .orderBy(F.desc(count_col), *keys)
        .limit(MAX_HOT_KEYS)
        .select(*keys)
    )
    return counts.sparkSession.createDataFrame(found.collect(), found.schema)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """At most ``MAX_HOT_KEYS`` keys with more than ``hot_rows`` rows: one job
    that reads the key columns only and combines on the map side."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return hottest(counts, keys, "_rows", hot_rows)


def flag_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Add boolean ``_hot``; a NULL key can be hot too.  The hot list is bounded by
    construction, hence the broadcast; the big side is not moved."""
    marked = F.broadcast(hot.select(*keys).withColumn("_hot", F.lit(True)))
    return null_safe_join(df, marked, keys, "left").withColumn("_hot", F.coalesce(F.col("_hot"), F.lit(False)))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join in which a NULL key meets a NULL key; one copy of the keys is kept."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot: DataFrame,
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """``left`` join ``right`` with hot keys of the left side spread over ``salts``.

    The salt is a hash of the row itself: the same after a task is retried.
    Only the right rows of hot keys are repeated (at most ``MAX_HOT_KEYS *
    salts`` extra rows when the right key is unique).
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_join supports left and inner joins")
    keys = list(keys)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts)).cast("int")
    salted = flag_hot(left, keys, hot).withColumn(SALT, F.when(F.col("_hot"), spread).otherwise(F.lit(0))).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = flag_hot(right, keys, hot).withColumn(SALT, F.explode(copies)).drop("_hot")
    return salted.join(repeated, on=[*keys, SALT], how=how).drop(SALT)


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def bytes_of(text: str) -> int:
    """A setting such as ``10485760``, ``10m`` or ``256KB`` in bytes."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", text).groups()
    return int(number) * _UNITS[unit.lower()]


def estimated_bytes(df: DataFrame) -> float:
    """Spark's own estimate of the size of ``df``, as its cost explanation states it."""
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        df.explain(mode="cost")
    found = re.search(r"== Optimized Logical Plan ==.*?sizeInBytes=([\d.E+]+) (\w*)B", said.getvalue(), re.S)
    if found is None:
        return float("inf")
    return float(found[1]) * 1024 ** " KMGTPE".index(found[2][:1] or " ")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate puts ``df`` under its broadcast threshold,
    in which case the planner broadcasts it and no row of the other side moves.
    """
    limit = bytes_of(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    return limit > 0 and estimated_bytes(df) <= limit


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot: DataFrame | Callable[[], DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join against a dimension: by the planner's size-checked broadcast when it
    is small, salted around the hot keys of ``left`` otherwise.  ``hot`` saves
    counting when the caller already knows the keys, or says from what to count
    them; it is asked only when the dimension is too big."""
    if fits_broadcast(right):
        return left.join(right, on=list(keys), how=how)
    if hot is None:
        hot = hot_keys(left, keys, hot_rows)
    elif callable(hot):
        hot = hot()
    if hot.isEmpty():
        return left.join(right, on=list(keys), how=how)
    return salted_join(left, right, keys, hot, how)


def with_group_totals(
    df: DataFrame, keys: Sequence[str], totals: dict[str, Column], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Aggregate by ``keys`` and put the results on every row.

    A window without order would send a whole group to one task; this
    pre-aggregates on the map side and joins back, by broadcast or with salt.
    The totals are written once: they name the hot keys, and their true size
    decides how they are joined.
    """
    aggs = [expr.alias(name) for name, expr in totals.items()]
    grouped = written(df.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("_rows")), "totals")
    right = grouped.drop("_rows")
    hot = None if fits_broadcast(right) else hottest(grouped, keys, "_rows", hot_rows)
    return skew_join(df, right, keys, hot=hot)


def sliced(df: DataFrame, keys: Sequence[str], hot: DataFrame, slice_expr: Column) -> DataFrame:
    """Add ``_slice``: 0 for ordinary keys, ``slice_expr`` for hot ones.

    ``slice_expr`` must not decrease along the window order, so a window over
    (keys, _slice) plus what the earlier slices carry in equals the window over
    the keys alone, with no task ever holding a whole hot key.
    """
    return flag_hot(df, keys, hot).withColumn(
        SLICE, F.when(F.col("_hot"), slice_expr.cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    )
