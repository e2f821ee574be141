"""Item transition graph and random walks.

Counts, probabilities and walks are tables; nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.durable import written, written_bucketed
from marquee.functions.encoders import stable_hash
from marquee.operators.histories import History, next_item
from marquee.operators.samples import POSITIVE, attach_scalar, positive_ratings, share_of_group
from marquee.skew import HOT_ROWS, flag_hot, hot_keys, hottest, skew_join

# A hot source, and the table of all items, is summed in this many pieces.
PIECES = 1024


def adjacent_pairs(
    ratings: DataFrame, history: History = History(), item: str = "movieId", threshold: float = POSITIVE
) -> DataFrame:
    """(src, dst) for neighbours in a user's positive sequence.

    Read from the ordered rows, not from arrays, so a pair is never lost at a
    chunk border and no sequence is built in memory.
    """
    linked = next_item(positive_ratings(ratings, threshold), history, item)
    return linked.filter(F.col("next_item").isNotNull()).select(
        F.col(item).alias("src"), F.col("next_item").alias("dst")
    )


def pairs_of_sequences(seqs: DataFrame, items: str = "items") -> DataFrame:
    """(src, dst) from whole sequences held in arrays, such as walks."""
    return seqs.select(
        F.explode(
            F.arrays_zip(
                F.slice(F.col(items), F.lit(1), F.greatest(F.size(items) - 1, F.lit(0))).alias("src"),
                F.slice(F.col(items), F.lit(2), F.greatest(F.size(items) - 1, F.lit(0))).alias("dst"),
            )
        ).alias("p")
    ).select("p.src", "p.dst")


def item_pair_counts(pairs: DataFrame) -> DataFrame:
    """How often each ordered pair occurs, self-pairs included."""
    return pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("cnt"))


def transition_matrix(pair_counts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Edge table ``(src, dst, cnt, prob)``; prob sums to 1 per src."""
    return share_of_group(pair_counts, ["src"], "cnt", "prob", hot_rows)


def item_distribution(pair_counts: DataFrame) -> DataFrame:
    """Node table ``(item, cnt, prob)`` over items that start a pair (A10)."""
    nodes = pair_counts.groupBy(F.col("src").alias("item")).agg(F.sum("cnt").alias("cnt"))
    return attach_scalar(nodes, "_all", F.sum("cnt")).withColumn("prob", F.col("cnt") / F.col("_all")).drop("_all")


def _piece(item: Column, method: str) -> Column:
    return F.pmod(stable_hash([item], method), F.lit(PIECES))


def _interval_starts(edges: DataFrame) -> DataFrame:
    """``start``: sum of cnt before this edge within its src, by (piece, dst);
    ``total`` and ``fan`` of the src.  Sums run per (src, piece), so neither a
    hot source nor the root, whose edges are all items, sits in one task."""
    here = W.partitionBy("src", "_piece").orderBy("dst").rowsBetween(W.unboundedPreceding, -1)
    local = edges.withColumn("_in", F.coalesce(F.sum("cnt").over(here), F.lit(0)))
    pieces = edges.groupBy("src", "_piece").agg(F.sum("cnt").alias("_sum"), F.count(F.lit(1)).alias("_fan"))
    by_src = W.partitionBy("src").orderBy("_piece")
    whole = W.partitionBy("src")
    offsets = pieces.select(
        "src",
        "_piece",
        F.coalesce(F.sum("_sum").over(by_src.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_sum").over(whole).alias("total"),
        F.sum("_fan").over(whole).alias("fan"),
    )
    return local.join(offsets, on=["src", "_piece"], how="left").select(
        "src", "dst", "cnt", (F.col("_in") + F.col("_off")).alias("start"), "total", "fan"
    )


def sampling_table(pair_counts: DataFrame, method: str = "xxhash64", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Guide table for drawing a successor by its transition probability.

    Each src's occurrences form the interval [0, total).  It is cut into
    ``fan`` equal buckets (fan = number of successors) and every edge is listed
    in the buckets it touches: at most 2 * fan rows per src.  A draw names its
    bucket, an equi-join on (src, bucket) fetches on average at most two
    candidates, and the interval test keeps exactly one.  The size follows the
    distinct edges, not the occurrences, and a popular src spreads over buckets.
    """
    fans = pair_counts.groupBy("src").agg(F.count(F.lit(1)).alias("_fan"))
    hot = hottest(fans, ["src"], "_fan", hot_rows)
    marked = flag_hot(pair_counts, ["src"], hot)
    return _cut(marked.withColumn("_piece", F.when(F.col("_hot"), _piece(F.col("dst"), method)).otherwise(F.lit(0))).drop("_hot"))


def start_table(nodes: DataFrame, method: str = "xxhash64") -> DataFrame:
    """The same for the first item: one root whose successors are all nodes."""
    rooted = nodes.select(F.lit(0).alias("src"), F.col("item").alias("dst"), "cnt")
    return _cut(rooted.withColumn("_piece", _piece(F.col("dst"), method)))


def _cut(edges: DataFrame) -> DataFrame:
    placed = _interval_starts(edges).withColumn("width", F.ceil(F.col("total") / F.col("fan")))
    first = F.floor(F.col("start") / F.col("width"))
    last = F.floor((F.col("start") + F.col("cnt") - 1) / F.col("width"))
    return placed.select(
        "src", "dst", "start", (F.col("start") + F.col("cnt")).alias("end"), F.explode(F.sequence(first, last)).alias("bucket")
    )


def source_widths(edges: DataFrame) -> DataFrame:
    """``(src, total, width)`` per source, to turn a draw into (slot, bucket)."""
    by_src = edges.groupBy("src").agg(F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("fan"))
    return by_src.select("src", "total", F.ceil(F.col("total") / F.col("fan")).alias("width"))


def with_successor_widths(
    table: DataFrame, widths: DataFrame, hot_rows: int = HOT_ROWS, hot: Callable[[], DataFrame] | None = None
) -> DataFrame:
    """Adds the total and width of each row's ``dst``, so a walk that arrives
    there can draw its next bucket without another lookup.  NULL at dead ends.
    ``hot`` says from what to count the hot ``dst``, so that ``table`` is not computed for it."""
    ahead = widths.select(F.col("src").alias("dst"), F.col("total").alias("next_total"), F.col("width").alias("next_width"))
    return skew_join(table, ahead, ["dst"], hot=hot, hot_rows=hot_rows)


def draw(walk: Column, step: int, seed: int, method: str) -> Column:
    """A fixed number per (seed, walk, step): unlike ``rand`` it is the same when
    a lost partition is computed again."""
    return stable_hash([F.lit(seed), walk, F.lit(step)], method)


def with_draw(walks: DataFrame, step: int, seed: int, method: str) -> DataFrame:
    """``slot`` and ``bucket`` of the draw that leads to ``step``; NULL where
    the walk stands at a dead end.  They are stored with the frontier, so the
    next join compares plain columns and hashes each walk once."""
    slot = F.pmod(draw(F.col("walk_id"), step, seed, method), F.col("total"))
    drawn = walks.withColumn("slot", slot)
    return drawn.withColumn("bucket", F.floor(F.col("slot") / F.col("width"))).drop("total", "width")


def guide_table(table: DataFrame) -> DataFrame:
    """A guide table stored by (src, bucket), as :func:`walk_step` joins it."""
    return written_bucketed(table, "guide", ["src", "bucket"])


def walk_step(walks: DataFrame, table: DataFrame, step: int, seed: int = 0, method: str = "xxhash64") -> DataFrame:
    """The next item of every walk that can go on.

    ``walks`` has walk_id, at, slot and bucket; ``table`` is a guide table with
    successor widths.  The join is on (src, bucket): walks at a popular item
    spread over its successors, and each walk meets exactly one interval.
    Walks at a dead end drop out.
    """
    p, t = walks.alias("p"), table.alias("t")
    inside = (F.col("p.slot") >= F.col("t.start")) & (F.col("p.slot") < F.col("t.end"))
    on = (F.col("p.at") == F.col("t.src")) & (F.col("p.bucket") == F.col("t.bucket")) & inside
    moved = p.join(t, on=on, how="inner").select(
        "p.walk_id",
        F.lit(step).alias("step"),
        F.col("t.dst").alias("at"),
        F.col("t.next_total").alias("total"),
        F.col("t.next_width").alias("width"),
    )
    return with_draw(moved, step + 1, seed, method)


def random_walks(
    pair_counts: DataFrame,
    n: int = 20_000,
    length: int = 10,
    seed: int = 0,
    method: str = "xxhash64",
    hot_rows: int = HOT_ROWS,
    store: Callable[[DataFrame, str], DataFrame] = written,
) -> DataFrame:
    """``n`` walks of at most ``length`` items (E3): ``(walk_id, items)``.

    The first item follows the item distribution, each next one the transition
    probabilities; a walk ends early at an item without successor.  The guide
    table is written once, in sorted buckets of (src, bucket): a step moves its
    frontier to them and leaves the table where it lies.  Each step's frontier is
    written too: a lost executor repeats one step, and its true size lets the
    planner broadcast a small frontier instead.
    """
    edges = store(pair_counts, "edges")
    widths = source_widths(edges)
    # On average an edge has at most two rows in the guide table; the stored edges name the hot ``dst``.
    table = guide_table(
        with_successor_widths(sampling_table(edges, method, hot_rows), widths, hot_rows, lambda: hot_keys(edges, ["dst"], hot_rows // 2))
    )
    nodes = item_distribution(edges).select("item", "cnt")
    roots = with_successor_widths(start_table(nodes, method), widths, hot_rows)
    root = nodes.agg(
        F.struct(F.sum("cnt").alias("total"), F.ceil(F.sum("cnt") / F.count(F.lit(1))).alias("width")).alias("root")
    )
    starts = (
        pair_counts.sparkSession.range(n)
        .withColumn("_root", root.scalar())
        .select(F.col("id").alias("walk_id"), F.lit(0).alias("at"), "_root.total", "_root.width")
    )
    first = store(with_draw(starts, 0, seed, method), "walk-starts")
    steps = [store(walk_step(first, roots, 0, seed, method), "walk-0")]
    for step in range(1, length):
        steps.append(store(walk_step(steps[-1], table, step, seed, method), f"walk-{step}"))
    visited = steps[0]
    for frontier in steps[1:]:
        visited = visited.unionByName(frontier)
    # At most ``length`` rows per walk.
    places = F.array_sort(F.collect_list(F.struct("step", "at")))
    return visited.groupBy("walk_id").agg(F.transform(places, lambda s: s["at"]).alias("items"))
