"""Ratings-to-samples operators: filters, labels, scalars, joins, limits
(P1-P6, J1-J4, W4, W5, O1, O4-O6, S6, S12)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.functions.encoders import stable_hash
from marquee.functions.numeric import as_doubles, zero_vector
from marquee.operators.ranking import global_rank, hash_bucket_of
from marquee.skew import HOT_ROWS, skew_join, with_group_totals

POSITIVE = 3.5


def positive_ratings(df: DataFrame, threshold: float = POSITIVE) -> DataFrame:
    """Ratings at or above the threshold; unrated rows drop out."""
    return df.filter(F.col("rating") >= threshold)


def label_of(rating: Column, threshold: float = POSITIVE, null_label: str = "negative") -> Column:
    label = F.when(rating >= threshold, 1).otherwise(0)
    if null_label == "null":
        return F.when(rating.isNotNull(), label)
    if null_label != "negative":
        raise ValueError("null_label must be 'negative' or 'null'")
    return label


def add_label(df: DataFrame, threshold: float = POSITIVE, null_label: str = "negative") -> DataFrame:
    """1 for a positive rating, else 0."""
    return df.withColumn("label", label_of(F.col("rating"), threshold, null_label))


def with_int_id(df: DataFrame, col: str, errors: str = "null", out: str | None = None) -> DataFrame:
    """Text id to INT; bad text becomes NULL or an error."""
    if errors not in ("null", "raise"):
        raise ValueError("errors must be 'null' or 'raise'")
    typed = F.col(col).try_cast("int") if errors == "null" else F.col(col).cast("int")
    return df.withColumn(out or f"{col}Number", typed)


def attach_scalar(df: DataFrame, name: str, agg: Column, source: DataFrame | None = None) -> DataFrame:
    """One aggregate of ``source`` on every row, as a scalar subquery: Spark
    computes it once and no value passes through Python (P5)."""
    one_row = (df if source is None else source).agg(agg.alias(name))
    return df.withColumn(name, one_row.scalar())


def fill_missing(df: DataFrame, value: float = 0, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL and NaN to ``value`` in numeric columns only."""
    return df.na.fill(value, subset=list(cols) if cols else None)


def join_movies(ratings: DataFrame, movies: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Left join on ``movieId`` with one key column kept; blockbusters are
    salted when the catalogue is too big to broadcast (J1)."""
    return skew_join(ratings, movies, ["movieId"], hot=hot)


def join_movie_stats(samples: DataFrame, stats: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Per-movie statistics back on every sample."""
    return join_movies(samples, stats, hot)


def join_links(movies: DataFrame, links: DataFrame) -> DataFrame:
    """External ids of a movie; both sides hold one row per movie."""
    return movies.join(links, on="movieId", how="left")


def lookup_embedding(
    df: DataFrame,
    id_col: str,
    table: DataFrame,
    dim: int,
    out: str = "emb",
    table_id: str = "id",
    table_emb: str = "emb",
    hot: DataFrame | Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """Dense row of an id, the zero vector for an unknown id.

    In a chain of look-ups pass ``hot`` from the plain samples, so that the
    earlier joins are not run again just to count ids."""
    vectors = table.select(F.col(table_id).alias(id_col), as_doubles(F.col(table_emb)).alias(out))
    joined = skew_join(df, vectors, [id_col], hot=hot)
    return joined.withColumn(out, F.coalesce(F.col(out), zero_vector(dim)))


def shuffle_samples(
    df: DataFrame, keys: Sequence[str], seed: int = 0, method: str = "xxhash64", place: str | None = None
) -> DataFrame:
    """A reproducible global shuffle: order by a seeded hash of the row key.

    Range partitions of a hash are even, and the keys break its ties.  With
    ``place`` the 1-based position in that order becomes a column, so the order
    outlives the next exchange.
    """
    mixed = stable_hash([F.lit(seed), *[F.col(k) for k in keys]], method)
    keyed = df.withColumn("_order", mixed)
    if place is None:
        return keyed.orderBy("_order", *keys).drop("_order")
    return global_rank(keyed.withColumn("_bucket", hash_bucket_of(F.col("_order"), method)), ["_order", *keys], place).drop("_order")


def preview(df: DataFrame, n: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """First n rows; the same ones each time when ``order`` is total."""
    return (df.orderBy(*order) if order else df).limit(n)


def print_preview(df: DataFrame, n: int = 10) -> None:
    df.printSchema()
    df.show(n, truncate=False)


def first_n(df: DataFrame, key: Sequence[str], n: int = 12) -> DataFrame:
    """First n rows by key (O6): a bounded top-n, not a global sort."""
    return df.orderBy(*key).limit(n)


def order_by_rating(histogram: DataFrame) -> DataFrame:
    """The rating histogram in rating order (O1): one row per distinct rating."""
    return histogram.orderBy("rating")


def order_by_count(counts: DataFrame, count_col: str, *ties: str) -> DataFrame:
    """Counts, biggest first, ties by name."""
    return counts.orderBy(F.desc(count_col), *ties)


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows of each group.

    Written as ``row_number() <= k`` so that Spark limits each group before the
    shuffle as well (WindowGroupLimit): a hot group arrives as k rows per task.
    """
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(rank) <= k)


def share_of_group(
    df: DataFrame, keys: Sequence[str], col: str, out: str = "share", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``col`` as a share of its group's sum."""
    totals = with_group_totals(df, keys, {"_total": F.sum(col)}, hot_rows)
    return totals.withColumn(out, F.col(col) / F.nullif(F.col("_total"), F.lit(0))).drop("_total")
