"""Ordered per-key operators: positions, sequences, prior statistics, recent
items and adjacent items (A6, W1-W3, O2).

All of them need "rows before this one" of a user (or a movie).  Without hot
keys that is one window per key.  Keys with too many rows for one task are cut
into slices of time, and a slice that still has too many, such as one second of a
busy key, into ranges between split points of the whole order.  The window then runs
per (key, slice), and a small carry table (hot keys only, one row per key and slice)
brings in what the earlier slices contribute.  Rows stay partitioned by (key, slice)
throughout.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marquee.durable import written
from marquee.skew import HOT_ROWS, SLICE, flag_hot, hot_keys, null_safe_join, sliced

DAY = 86_400
# Ranges of one time slice, and sampled rows for each of them.
RANKS = 1024
SAMPLES = 64
# Rows without a time come first.
NO_TIME = -(1 << 40)


@dataclass(frozen=True)
class History:
    """How rows of a key are ordered.

    ``ties`` must make the order total up to identical rows.  ``span`` is the
    width of a hot key's time slice, in units of ``time``.  Rows of one slice beyond
    ``hot_rows`` are cut further by rank; rows that agree in all columns stay together.
    """

    keys: Sequence[str] = ("userId",)
    time: str = "timestamp"
    ties: Sequence[str] = ("movieId", "rating")
    span: int = DAY
    hot_rows: int = HOT_ROWS

    @property
    def order(self) -> list[str]:
        return [self.time, *self.ties]

    def order_struct(self) -> Column:
        return F.struct(*[F.col(c) for c in self.order])

    def lay_out(self, df: DataFrame, hot: DataFrame | None = None) -> Laid:
        """Find the hot keys (unless given) and cut them into slices."""
        if hot is None:
            hot = hot_keys(df, self.keys, self.hot_rows)
        if hot.isEmpty():
            return Laid(self, df, False)
        no_key = not hot.filter(" or ".join(f"`{k}` is null" for k in self.keys)).isEmpty()
        spans = F.coalesce(F.floor(F.col(self.time) / self.span), F.lit(NO_TIME)) * RANKS
        cut = sliced(df, self.keys, hot, spans)
        return Laid(self, self._cut_by_rank(cut, df.columns), True, no_key)

    def _cut_by_rank(self, cut: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Slices with too many rows, cut at split points of (order, row hash).

        The points are quantiles of a sample taken by the row's hash, about ``SAMPLES`` for
        ``hot_rows`` rows; they steer the layout only.  A slice has at most ``RANKS`` ranges."""
        place = [*self.keys, SLICE]
        found = hot_keys(cut.filter("_hot"), place, self.hot_rows)
        if found.isEmpty():
            return cut
        row_hash = F.xxhash64(*[F.col(c) for c in columns])
        at = F.struct(*[F.col(c) for c in self.order], row_hash.alias("_hash"))
        every = max(1, self.hot_rows // SAMPLES)
        crowded = flag_hot(cut.filter("_hot").drop("_hot"), place, found).filter("_hot")
        sample = crowded.withColumn("_at", at).filter(F.pmod(F.xxhash64(F.col("_at._hash")), F.lit(every)) == 0)
        ranked = sample.select(
            *place,
            "_at",
            F.row_number().over(W.partitionBy(*place).orderBy("_at")).alias("_r"),
            F.count(F.lit(1)).over(W.partitionBy(*place)).alias("_n"),
        )
        # Every SAMPLES-th sampled row, or fewer for a slice beyond RANKS ranges.
        step = F.greatest(F.lit(min(SAMPLES, self.hot_rows)), F.ceil(F.col("_n") / (RANKS - 1)))
        points = ranked.filter(F.col("_r") % step == 0).groupBy(*place).agg(F.array_sort(F.collect_list("_at")).alias("_points"))
        # One point for hot_rows rows of at most MAX_HOT_KEYS slices.
        marked = null_safe_join(cut, F.broadcast(written(points, "split-points")), place, "left")
        rank = F.size(F.filter(F.coalesce("_points", F.array().cast(points.schema["_points"].dataType)), lambda p: p <= at))
        return marked.withColumn(SLICE, F.when(F.col("_hot"), F.col(SLICE) + rank).otherwise(F.col(SLICE))).drop("_points")


@dataclass(frozen=True)
class Laid:
    """Rows ready for per-key windows; ``cut`` when some keys are sliced, ``no_key``
    when rows without a key are."""

    history: History
    df: DataFrame
    cut: bool
    no_key: bool = False

    @property
    def place(self) -> list[str]:
        return [*self.history.keys, SLICE] if self.cut else list(self.history.keys)

    def window(self, *extra: str) -> W:
        return W.partitionBy(*self.place, *extra).orderBy(*self.history.order)

    def before(self, *extra: str) -> W:
        return self.window(*extra).rowsBetween(W.unboundedPreceding, -1)

    def slices(self) -> W:
        """Over the carry table: its rows per key are bounded by the time slices."""
        return W.partitionBy(*self.history.keys).orderBy(SLICE)

    def slices_before(self) -> W:
        return self.slices().rowsBetween(W.unboundedPreceding, -1)

    def per_slice(self, *aggs: Column) -> DataFrame:
        """One row per hot key and slice, combined before the shuffle."""
        return self.df.filter("_hot").groupBy(*self.place).agg(*aggs)

    def bring(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        """Carry values to their slice: only the small carry table moves."""
        if self.no_key:
            return null_safe_join(df, carry, self.place, "left")
        return df.join(carry, on=self.place, how="left")

    def bring_per_key(self, df: DataFrame, per_key: DataFrame) -> DataFrame:
        """A one-row-per-key table to every row, where the rows lie: for hot keys
        it is repeated once per slice they have."""
        if self.cut:
            slices = self.df.filter("_hot").select(*self.place).distinct()
            joined = null_safe_join(per_key, slices, self.history.keys, "left") if self.no_key else per_key.join(slices, on=list(self.history.keys), how="left")
            per_key = joined.withColumn(
                SLICE, F.coalesce(F.col(SLICE), F.lit(0).cast("bigint"))
            )
        return self.bring(df, per_key)

    def done(self, df: DataFrame, *helpers: str) -> DataFrame:
        return df.drop(*helpers, "_hot", SLICE)


def with_position(df: DataFrame, history: History, hot: DataFrame | None = None, name: str = "pos") -> DataFrame:
    """0-based position of each row within its key, in order."""
    laid = history.lay_out(df, hot)
    local = laid.df.withColumn(name, F.row_number().over(laid.window()).cast("bigint") - 1)
    if laid.cut:
        carry = laid.per_slice(F.count(F.lit(1)).alias("_n")).select(
            *laid.place, F.sum("_n").over(laid.slices_before()).alias("_carried")
        )
        local = laid.bring(local, carry).withColumn(name, F.col(name) + F.coalesce("_carried", F.lit(0)))
    return laid.done(local, "_carried")


def user_sequences(
    ratings: DataFrame,
    history: History = History(),
    item: str = "movieId",
    threshold: float = 3.5,
    max_len: int = 1000,
) -> DataFrame:
    """Items a user rated at least ``threshold``, in time order.

    One row per user and ``chunk`` of ``max_len`` items: every item is kept, and
    no row grows with a heavy user.  Users with fewer items have chunk 0 only.
    The skip-gram trainer cuts sentences at 1,000 items itself, so training on
    chunks of 1,000 sees the same sentences as training on whole sequences.
    """
    positive = ratings.filter(F.col("rating") >= threshold)
    placed = with_position(positive.select(*dict.fromkeys([*history.keys, *history.order, item])), history)
    chunk = F.floor(F.col("pos") / max_len).cast("bigint")
    pairs = F.array_sort(F.collect_list(F.struct("pos", item)))
    return (
        placed.groupBy(*history.keys, chunk.alias("chunk"))
        .agg(F.transform(pairs, lambda p: p[item].cast("string")).alias("movieIds"))
        .withColumn("movieIdStr", F.array_join("movieIds", " "))
    )


def time_ordered_items(events: Column, time: str = "timestamp", item: str = "movieId") -> Column:
    """Items of an array of (time, item, ...) structs, by time then item (O2)."""
    keyed = F.transform(events, lambda e: F.struct(e[time].alias("t"), e[item].alias("i")))
    return F.transform(F.array_sort(keyed), lambda e: e["i"])


def next_item(
    df: DataFrame, history: History = History(), item: str = "movieId", hot: DataFrame | None = None
) -> DataFrame:
    """Adds ``next_item``: the item of the following row of the key, NULL at its end."""
    laid = history.lay_out(df, hot)
    local = laid.df.withColumn("next_item", F.lead(item).over(laid.window()))
    if laid.cut:
        carry = laid.per_slice(F.min_by(item, history.order_struct()).alias("_first")).select(
            *laid.place, F.lead("_first").over(laid.slices()).alias("_after")
        )
        local = laid.bring(local, carry).withColumn("next_item", F.coalesce("next_item", "_after"))
    return laid.done(local, "_after")


@dataclass(frozen=True)
class PriorNames:
    """Output columns of :func:`prior_stats`."""

    count: str = "userRatingCount"
    avg: str = "userAvgRating"
    stddev: str = "userRatingStddev"


MOVIE_PRIOR = PriorNames("movieRatingCount", "movieAvgRating", "movieRatingStddev")


def _moments(value: str, over: W | None) -> list[Column]:
    """Count, sum, and sum of squared deviations from the mean."""
    x = F.col(value).cast("double")
    parts = [F.count(x), F.sum(x), F.var_pop(x)]
    n, s, v = (p.over(over) if over is not None else p for p in parts)
    return [n.alias("_n"), s.alias("_s"), (v * n).alias("_m")]


def _merged_before(laid: Laid, per_slice: DataFrame) -> DataFrame:
    """Moments of all earlier slices.  Deviations are taken around the key's own mean, so
    nothing large is subtracted when the values lie far from 0."""
    n, s, m = F.col("_n"), F.coalesce("_s", F.lit(0.0)), F.coalesce("_m", F.lit(0.0))
    whole, before = W.partitionBy(*laid.history.keys), laid.slices_before()
    centre = F.sum("_s").over(whole) / F.nullif(F.sum("_n").over(whole), F.lit(0))
    centred = per_slice.withColumn("_c", F.coalesce(centre, F.lit(0.0))).withColumn("_d", F.when(n > 0, s - n * F.col("_c")).otherwise(0.0))
    spread = m + F.when(n > 0, F.col("_d") * F.col("_d") / n).otherwise(0.0)
    sums = centred.select(
        *laid.place,
        "_c",
        F.sum("_n").over(before).alias("_n0"),
        F.sum("_s").over(before).alias("_s0"),
        F.sum("_d").over(before).alias("_d0"),
        F.sum(spread).over(before).alias("_q0"),
    )
    n0, d0 = F.col("_n0"), F.col("_d0")
    return sums.select(*laid.place, "_n0", "_s0", F.greatest(F.col("_q0") - F.when(n0 > 0, d0 * d0 / n0).otherwise(0.0), F.lit(0.0)).alias("_m0"))


def _with_moments(laid: Laid, df: DataFrame, value: str) -> DataFrame:
    """Count, sum and squared deviations over the key's earlier rows; sums of ratings, short
    binary fractions, are exact."""
    local = df.select("*", *_moments(value, laid.before()))
    if laid.cut:
        carry = _merged_before(laid, laid.per_slice(*_moments(value, None)))
        both = laid.bring(local, carry)
        n, s, m, n0, s0, m0 = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("_n", "_s", "_m", "_n0", "_s0", "_m0"))
        apart = s / F.nullif(n, F.lit(0)) - s0 / F.nullif(n0, F.lit(0))
        between = F.coalesce(apart * apart * n * n0 / F.nullif(n + n0, F.lit(0)), F.lit(0.0))
        local = both.withColumns({"_n": n + n0, "_s": s + s0, "_m": m + m0 + between})
    return local


def _named_stats(df: DataFrame, names: PriorNames) -> DataFrame:
    n, s, m = F.col("_n"), F.col("_s"), F.col("_m")
    return (
        df.withColumn(names.count, F.coalesce(n, F.lit(0)).cast("bigint"))
        .withColumn(names.avg, F.when(n > 0, s / n))
        .withColumn(names.stddev, F.when(n > 1, F.sqrt(m / (n - 1))))
    )


_MOMENT_HELPERS = ("_n", "_s", "_m", "_n0", "_s0", "_m0")


def prior_stats(
    df: DataFrame,
    history: History = History(),
    value: str = "rating",
    names: PriorNames = PriorNames(),
    hot: DataFrame | None = None,
) -> DataFrame:
    """Count, average and sample deviation over the key's *earlier* rows only.

    Count is 0 and the others NULL at the first row; the deviation is NULL
    until two earlier values exist.
    """
    laid = history.lay_out(df, hot)
    return laid.done(_named_stats(_with_moments(laid, laid.df, value), names), *_MOMENT_HELPERS)


def _with_recent(laid: Laid, df: DataFrame, item: str, threshold: float, n: int) -> DataFrame:
    """``_recent``: the last n positive items before this row, newest first.

    One window by key, the same as that of other columns over the earlier rows: it looks
    back past the rows that are not positive, so rows are sorted once and it holds no lists.
    """
    flagged = df.withColumn("_mine", F.when(F.col("rating") >= threshold, F.struct(F.col(item).alias("i"))))
    place, order = (", ".join(f"`{c}`" for c in names) for names in (laid.place, laid.history.order))
    back = [F.expr(f"lag(_mine, {k}) IGNORE NULLS OVER (PARTITION BY {place} ORDER BY {order})") for k in range(1, n + 1)]
    local = flagged.withColumn("_recent", F.array_compact(F.array(*[b["i"] for b in back])))
    if laid.cut:
        own, earlier = F.coalesce("_recent", F.array()), F.coalesce("_carried_items", F.array())
        carried = laid.bring(local, _recent_carry(laid, item, threshold, n))
        local = carried.withColumn("_recent", F.slice(F.concat(own, earlier), 1, n))
    return local


def _recent_carry(laid: Laid, item: str, threshold: float, n: int) -> DataFrame:
    """The last n positives of all earlier slices, per hot key and slice.

    Each non-empty slice offers its own newest n by a bounded group limit; the
    last n non-empty slices are then enough, so frames stay n rows wide.
    """
    hot_rows = laid.df.filter("_hot")
    newest = W.partitionBy(*laid.place).orderBy(*[F.desc(c) for c in laid.history.order])
    tops = (
        hot_rows.filter(F.col("rating") >= threshold)
        .withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") <= n)
        .groupBy(*laid.place)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_rn", item))), lambda p: p[item]).alias("_tops"))
    )
    last_n = laid.slices().rowsBetween(-(n - 1), 0)
    newest_out = F.slice(F.flatten(F.reverse(F.collect_list("_tops").over(last_n))), 1, n)
    carried_out = tops.select(*laid.place, newest_out.alias("_out"))
    every_slice = hot_rows.select(*laid.place).distinct()
    return every_slice.join(carried_out, on=laid.place, how="left").select(
        *laid.place, F.last("_out", ignorenulls=True).over(laid.slices_before()).alias("_carried_items")
    )


_RECENT_HELPERS = ("_recent", "_mine", "_carried_items")


def _recent_slots(n: int, prefix: str) -> list[Column]:
    slot = [F.get("_recent", F.lit(i)) for i in range(n)]
    return [F.coalesce(s, F.lit(0)).alias(f"{prefix}{i + 1}") for i, s in enumerate(slot)]


def recent_items(
    df: DataFrame,
    n: int = 5,
    history: History = History(),
    item: str = "movieId",
    threshold: float = 3.5,
    prefix: str = "userRatedMovie",
    hot: DataFrame | None = None,
) -> DataFrame:
    """The last ``n`` items rated at least ``threshold`` before this row, newest
    first, 0 where there are fewer (W2).  Integer item ids."""
    laid = history.lay_out(df, hot)
    local = _with_recent(laid, laid.df, item, threshold, n)
    return laid.done(local.select("*", *_recent_slots(n, prefix)), *_RECENT_HELPERS)


def _genre_carry(laid: Laid, genres: str, threshold: float) -> DataFrame:
    """Per hot key and slice, how often each genre stood among the positives of earlier slices."""
    hot_rows = laid.df.filter("_hot")
    keys, place = list(laid.history.keys), laid.place
    listed = hot_rows.filter(F.col("rating") >= threshold).select(*place, F.explode(genres).alias("_genre"))
    counted = listed.groupBy(*place, "_genre").agg(F.count(F.lit(1)).alias("_cnt"))
    every = null_safe_join(hot_rows.select(*place).distinct(), counted.select(*keys, "_genre").distinct(), keys, "inner")
    filled = null_safe_join(every, counted, [*place, "_genre"], "left")
    before = W.partitionBy(*keys, "_genre").orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    sums = filled.withColumn("_sum", F.sum("_cnt").over(before)).filter("_sum > 0")
    return sums.groupBy(*place).agg(F.collect_list(F.struct("_genre", "_sum")).alias("_earlier"))


def _top_genres(counts: dict[str, int], n: int) -> list[str | None]:
    best = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:n]]
    return best + [None] * (n - len(best))


def _favourites_after(best: list[str | None], counts: dict[str, int], genres: Sequence[str | None], n: int) -> list[str | None]:
    """The n favourites after one more row, whose genres are counted.  Only they can rise, so
    they and the favourites before are all that is ranked."""
    for g in genres:
        if g is not None:
            counts[g] = counts.get(g, 0) + 1
    return _top_genres({g: counts[g] for g in (*best, *genres) if g is not None}, n)


def _with_favourites(laid: Laid, df: DataFrame, genres: str, threshold: float, n: int, prefix: str) -> DataFrame:
    """``prefix1..n``: the genres most frequent among the positives before the row, ties by name.

    One pass over the ordered rows of a key with a running counter; a slice of a hot key
    begins with the counts of the slices before it.  Rows lie by key and slice already."""
    names = [f"{prefix}{i + 1}" for i in range(n)]
    ordered = df.withColumn("_like", F.coalesce(F.col("rating") >= threshold, F.lit(False)))
    if laid.cut:
        first = F.row_number().over(laid.window()) == 1
        carried = laid.bring(ordered.withColumn("_first", first), _genre_carry(laid, genres, threshold))
        # A join may have split a big partition: lay the rows together again.
        ordered = carried.withColumn("_earlier", F.when(F.col("_first"), F.col("_earlier"))).drop("_first").repartition(*laid.place)
    ordered = ordered.sortWithinPartitions(*laid.place, *laid.history.order)
    kept = [f for f in ordered.schema.fields if f.name not in ("_like", "_earlier", *names)]
    schema = T.StructType([*kept, *[T.StructField(name, T.StringType()) for name in names]])
    target, place = to_arrow_schema(schema), laid.place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        counts: dict[str, int] = {}
        best: list[str | None] = [None] * n
        for batch in batches:
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            keys = list(zip(*(columns[c].to_pylist() for c in place), strict=True))
            likes, listed = columns["_like"].to_pylist(), columns[genres].to_pylist()
            earlier = columns["_earlier"].to_pylist() if "_earlier" in columns else [None] * len(keys)
            out: list[list[str | None]] = []
            for now, like, of_row, before in zip(keys, likes, listed, earlier, strict=True):
                if now != key:
                    key, counts = now, {x["_genre"]: x["_sum"] for x in before or ()}
                    best = _top_genres(counts, n)
                out.append(best)
                if like and of_row:
                    best = _favourites_after(best, counts, of_row, n)
            found = {name: pa.array([b[i] for b in out], pa.string()) for i, name in enumerate(names)}
            yield pa.RecordBatch.from_arrays([(found.get(f.name, columns.get(f.name))).cast(f.type) for f in target], schema=target)

    return ordered.mapInArrow(run, schema)


def running_favourites(
    df: DataFrame, genres: str, n: int = 5, history: History = History(), threshold: float = 3.5, prefix: str = "userGenre", hot: DataFrame | None = None
) -> DataFrame:
    """Favourite genres as of each row (A7, point in time): ``prefix1..n`` from the earlier rows
    rated at least ``threshold``, most frequent first, ties by name, NULL where there are fewer.
    ``genres`` is an ``array<string>`` column."""
    laid = history.lay_out(df, hot)
    return laid.done(_with_favourites(laid, laid.df.repartition(*laid.place), genres, threshold, n, prefix))


def user_history_features(
    df: DataFrame,
    n: int = 5,
    history: History = History(),
    item: str = "movieId",
    threshold: float = 3.5,
    hot: DataFrame | None = None,
    names: PriorNames = PriorNames(),
    per_user: DataFrame | None = None,
    genres: str | None = None,
) -> DataFrame:
    """W1 and W2 together (A12, as-of form): all windows share one shuffle.

    ``per_user`` is an optional table with one row per user, left joined on the
    way while the rows still lie together.  ``genres`` names a list column whose
    running favourites become ``userGenre1..5``.
    """
    laid = history.lay_out(df, hot)
    joined = _named_stats(_with_moments(laid, laid.df, "rating"), names)
    joined = _with_recent(laid, joined, item, threshold, n)
    if genres is not None:
        joined = _with_favourites(laid, joined, genres, threshold, 5, "userGenre")
    if per_user is not None:
        joined = laid.bring_per_key(joined, per_user)
    slotted = joined.select("*", *_recent_slots(n, "userRatedMovie"))
    return laid.done(slotted, *_RECENT_HELPERS, *_MOMENT_HELPERS)
