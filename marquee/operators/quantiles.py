"""Exact order statistics and quantiles without a sort.

The range of values is cut into buckets, each bucket counts its rows and keeps its least and
largest value, and only the buckets that hold a wanted rank are cut again.  A round is one
scan of the column with a map-side count; the driver sees a bounded number of buckets, and no
task sees all values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.durable import written

# Buckets of an interval in a round.
CUTS = 512


def order_statistics(df: DataFrame, col: str, ranks: Sequence[int]) -> dict[int, float]:
    """The value of each 0-based rank among the column's values, NULL and NaN left out."""
    values = df.select(F.col(col).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    values = written(values, "values")
    low, high, n = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    found: dict[int, float] = {}
    # Intervals (least, largest, rows below) that hold wanted ranks.
    wanted = sorted({r for r in ranks if 0 <= r < n})
    open_ = [(low, high, 0, wanted)] if wanted else []
    while open_:
        for least, _, _, mine in [o for o in open_ if o[0] == o[1]]:
            found |= dict.fromkeys(mine, least)
        open_ = [o for o in open_ if o[0] != o[1]]
        if not open_:
            break
        cuts = sorted({x for least, largest, _, _ in open_ for x in _cuts(least, largest)})
        splits = [float("-inf"), *cuts, float("inf")]
        cutter = Bucketizer(splits=splits, inputCol="v", outputCol="b")
        inside = " or ".join(f"v between {least!r}d and {largest!r}d" for least, largest, _, _ in open_)
        counted = cutter.transform(values.filter(inside)).groupBy("b").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"))
        buckets = sorted((r.lo, r.hi, r.n) for r in counted.collect())
        following = []
        for least, largest, below, mine in open_:
            for lo, hi, n_ in buckets:
                if least <= lo and hi <= largest:
                    here = [r for r in mine if below <= r < below + n_]
                    if here:
                        following.append((lo, hi, below, here))
                    below += n_
        open_ = following
    return found


def _cuts(least: float, largest: float) -> list[float]:
    """Inner cuts of an interval, and its two ends: a bucket never reaches over an end."""
    step = largest / CUTS - least / CUTS
    inner = [x for i in range(1, CUTS) if least < (x := least + i * step) < largest]
    return [least, *inner, largest]


def exact_quantiles(df: DataFrame, col: str, fractions: Sequence[float]) -> list[float]:
    """Quantiles with linear interpolation between ranks, one for each fraction; none without values."""
    n = df.filter(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).count()
    if not n:
        return []
    at = [f * (n - 1) for f in fractions]
    value = order_statistics(df, col, [r for a in at for r in (int(a), min(int(a) + 1, n - 1))])
    return [value[int(a)] + (value[min(int(a) + 1, n - 1)] - value[int(a)]) * (a - int(a)) for a in at]
