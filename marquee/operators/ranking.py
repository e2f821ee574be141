"""Whole-table order statistics without a single-partition window.

Rows are put into range buckets that never decrease along the order.  Inside a
bucket an ordinary window runs; across buckets only one total per bucket is
summed (at most ``QUANTILES * STEPS`` rows, a proven bound).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

QUANTILES = 128
STEPS = 256
BUCKET = "_bucket"


def hash_bucket_of(hashed: Column, method: str = "xxhash64") -> Column:
    """Range bucket of a uniform hash: its leading 15 bits, no scan needed."""
    bits = 60 if method == "md5" else 64
    return F.shiftright(hashed, bits - 15).cast("int")


def with_range_bucket(df: DataFrame, by: str) -> DataFrame:
    """Buckets from approximate quantiles, each cut into equal steps.

    The quantiles follow the data, the steps keep buckets small between them.
    Any bounds give exact results; they only decide how even the buckets are.
    """
    fractions = [i / QUANTILES for i in range(QUANTILES + 1)]
    bounds = df.agg(F.percentile_approx(by, F.array(*[F.lit(f) for f in fractions])).alias("b"))
    x = F.col(by).cast("double")
    quantile = F.greatest(F.size(F.filter("_bounds", lambda b: b <= x)), F.lit(1))
    low, high = F.get("_bounds", F.col("_q") - 1), F.get("_bounds", F.col("_q"))
    step = F.coalesce(F.floor((x - low) / F.nullif(high - low, F.lit(0)) * STEPS), F.lit(0))
    inside = F.greatest(F.least(step, F.lit(STEPS - 1)), F.lit(0))
    return (
        df.withColumn("_bounds", bounds.scalar().cast("array<double>"))
        .withColumn("_q", quantile)
        .withColumn(BUCKET, (F.col("_q") * STEPS + inside).cast("int"))
        .drop("_bounds", "_q")
    )


def running_before(df: DataFrame, order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """For each row, each sum over all rows strictly before it in the whole
    table.  ``df`` has a bucket column; (bucket, order) must be a total order."""
    here = W.partitionBy(BUCKET).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = df.select("*", *[F.coalesce(F.sum(e).over(here), F.lit(0)).alias(f"_in_{n}") for n, e in sums.items()])
    totals = df.groupBy(BUCKET).agg(*[F.sum(e).alias(f"_t_{n}") for n, e in sums.items()])
    earlier = W.partitionBy(F.lit(0)).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        BUCKET, *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_off_{n}") for n in sums]
    )
    joined = local.join(F.broadcast(offsets), on=BUCKET, how="left")
    out = joined.withColumns({n: F.col(f"_in_{n}") + F.col(f"_off_{n}") for n in sums})
    return out.drop(BUCKET, *[f"_in_{n}" for n in sums], *[f"_off_{n}" for n in sums])


def global_rank(df: DataFrame, order: Sequence[str], out: str = "rank") -> DataFrame:
    """1-based row number over the whole table, in ``order``."""
    counted = running_before(df, order, {out: F.lit(1).cast("bigint")})
    return counted.withColumn(out, F.col(out) + 1)
