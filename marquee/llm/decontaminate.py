"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The n-grams of the benchmark items are counted in the corpus by distinct contexts, the words
around them: a copy that stands in a thousand documents counts once, a common phrase as often
as it is used.  An item's seeds are its n-grams in at most ``RARE_CONTEXTS`` contexts and, in
any case, the ``ALWAYS_SEEDS`` rarest of those that occur.  A seed joins the passage around it
to the item, and the local alignment of their words (case and punctuation don't count) scores
exact, edited and paraphrased copies alike: its score over that of the whole item.

The corpus is filtered against bitmaps of n-grams of fixed size before anything is shuffled; a
false hit ends in the exact join that follows.  A seed with very many places, as an item of
common phrases may have, is spread over tasks.

Defined results: NULL and empty texts, items without words and rows with a NULL id
match nothing; an item shorter than a seed seeds as a whole; equal rows give one
match; of several places in a document the best is reported, the first of equals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.durable import written
from marquee.llm.bitmap import BITS, collect_bits, has, slot_of
from marquee.llm.frames import bounded_batches, record_batch, thrifty
from marquee.llm.words import blocks, mix, split_words
from marquee.skew import hottest, salted_join

SEED_WORDS = 3
RARE_CONTEXTS = 64
ALWAYS_SEEDS = 8
# Words on either side that make a context.
CONTEXT_WORDS = 4
# Places of a seed from which on they are spread over tasks.
HOT_PLACES = 10_000
_PLACES_AT_ONCE = 200_000
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BATCH_CELLS = 4_000_000

_ITEMS = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("words", T.ArrayType(T.LongType())), T.StructField("grams", T.ArrayType(T.LongType()))]
)
_HITS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("gram", T.LongType()), T.StructField("at", T.IntegerType())])
_CONTEXTS = T.StructType([T.StructField(n, T.LongType()) for n in ("gram", "context", "n")])
_TEXTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("words", T.ArrayType(T.LongType()))])
_SCORED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("start_word", T.IntegerType()),
        T.StructField("end_word", T.IntegerType()),
    ]
)


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, word hashes (as signed integers), text of each word, and bounds."""
    for batch in batches:
        values = batch.column(1).to_pylist()
        for begin, end in blocks(values):
            words = split_words(values[begin:end], bare=True)
            yield batch.column(0).slice(begin, end - begin), words.hashes(lower=False), words.doc, words.bounds


def _grams(hashes: np.ndarray, doc: np.ndarray, bounds: np.ndarray, width: int = SEED_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``width`` words and the index of their first words; a shorter text is one run."""
    n = len(hashes)
    counts = np.diff(bounds)[doc] if n else np.zeros(0, np.int64)
    place = np.arange(n) - bounds[:-1][doc] if n else np.zeros(0, np.int64)
    wide = np.minimum(counts, width)
    at = np.flatnonzero(place + wide <= counts) if n else np.zeros(0, np.int64)
    gram = np.full(len(at), 0xDEC0, dtype=np.uint64)
    for k in range(width):
        follow = mix(gram * np.uint64(0x9E3779B97F4A7C15) + hashes[np.minimum(at + k, max(n - 1, 0))]) if n else gram
        gram = np.where(k < wide[at], follow, gram)
    return gram, at


def item_words(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, doc, bounds in _word_lists(batches):
            gram, at = _grams(hashes, doc, bounds)
            cuts = bounds[1:-1]
            yield record_batch(
                {
                    "item_id": ids,
                    "words": [w.view(np.int64) for w in np.split(hashes, cuts)],
                    "grams": [g.view(np.int64) for g in np.split(gram, np.searchsorted(at, cuts))],
                },
                _ITEMS,
            )

    source = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text")).filter("item_id is not null")
    return source.mapInArrow(thrifty(run), _ITEMS).filter("size(words) > 0")


def _hits(source: tuple, widths: list[int], bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-grams that the bitmap lets through, the places of their first words, and their widths."""
    _, hashes, doc, bounds = source
    runs = [_grams(hashes, doc, bounds, width) for width in widths]
    gram, at = (np.concatenate(x) for x in zip(*runs, strict=True))
    wide = np.repeat(widths, [len(g) for g, _ in runs])
    hit = np.flatnonzero(has(bitmap, (gram & np.uint64(_LOW)).astype(np.int64)))
    return gram[hit], at[hit], wide[hit]


# The bitmap's slot of an n-gram is its low bits, so that numpy can look it up.
_LOW = (1 << BITS) - 1


def _bitmap_of(grams: DataFrame) -> np.ndarray:
    return collect_bits(grams, F.col("gram").bitwiseAND(_LOW))


def contexts_of(hashes: np.ndarray, doc: np.ndarray, bounds: np.ndarray, at: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Hash of the words on both sides of runs, as far as the text goes."""
    out = np.full(len(at), 0xC0DE, dtype=np.uint64)
    if not len(at):
        return out
    low, high = bounds[:-1][doc[at]], bounds[1:][doc[at]]
    for k in range(1, CONTEXT_WORDS + 1):
        for place in (at - k, at + wide + k - 1):
            inside = (place >= low) & (place < high)
            word = np.where(inside, hashes[place.clip(0, len(hashes) - 1)], np.uint64(0))
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + word)
    return out


def gram_contexts(docs: DataFrame, grams: DataFrame, widths: list[int]) -> DataFrame:
    """(gram, contexts, places): in how many distinct contexts, and how often, an n-gram that the
    bitmap lets through stands in the corpus.  A task sends each context once with its count."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap_of(grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            gram, context, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((context, gram))
            gram, context, n = gram[order], context[order], n[order]
            head = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])]))
            return record_batch({"gram": gram[head].view(np.int64), "context": context[head].view(np.int64), "n": np.add.reduceat(n, head)}, _CONTEXTS)

        for source in _word_lists(batches):
            gram, at, wide = _hits(source, widths, shared.value)
            if len(gram):
                held.append((gram, contexts_of(*source[1:], at, wide), np.ones(len(gram), dtype=np.int64)))
            if sum(len(h[0]) for h in held) > _PLACES_AT_ONCE:
                yield flush()
        if held:
            yield flush()

    found = docs.mapInArrow(thrifty(run), _CONTEXTS).groupBy("gram", "context").agg(F.sum("n").alias("n"))
    return found.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("places"))


def seeds_of(placed: DataFrame, counts: DataFrame) -> DataFrame:
    """The rows of ``placed`` (one for each n-gram of an item) that seed."""
    occurring = placed.join(counts.select("gram", "contexts"), "gram")
    rarest = Window.partitionBy("item_id", "m").orderBy("contexts", "gram", "item_at")
    ranked = occurring.withColumn("_rank", F.row_number().over(rarest))
    return ranked.filter((F.col("contexts") <= RARE_CONTEXTS) | (F.col("_rank") <= ALWAYS_SEEDS)).drop("_rank", "contexts")


def seed_hits(docs: DataFrame, grams: DataFrame, widths: list[int]) -> DataFrame:
    """(doc_id, gram, at): places in the corpus of n-grams that the bitmap lets through.
    ``widths`` are the lengths of seeds in words: the usual one, and those of shorter items."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap_of(grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in _word_lists(batches):
            ids, _, doc, bounds = source
            gram, at, _ = _hits(source, widths, shared.value)
            owner = doc[at]
            yield record_batch({"doc_id": ids.take(pa.array(owner)), "gram": gram.view(np.int64), "at": (at - bounds[:-1][owner]).astype(np.int32)}, _HITS)

    return docs.mapInArrow(thrifty(run), _HITS).filter("doc_id is not null")


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignments of pairs of word lists, all pairs at once.

    Returns the scores and the first and past-the-last word in the passages.  A cell
    holds score and start together, so that the maximum carries both; gaps along
    the passage are a running maximum.
    """
    n = len(items)
    rows, columns = max(map(len, items)), max(map(len, passages))
    item = np.zeros((n, rows), dtype=np.int64)
    passage = np.zeros((n, columns), dtype=np.int64)
    item_ok, passage_ok = np.zeros((n, rows), dtype=bool), np.zeros((n, columns), dtype=bool)
    for i, (a, b) in enumerate(zip(items, passages, strict=True)):
        item[i, : len(a)], item_ok[i, : len(a)] = a, True
        passage[i, : len(b)], passage_ok[i, : len(b)] = b, True
    unit = np.int64(1 << 24)
    place = np.arange(columns, dtype=np.int64)
    fresh = unit - 1 - place  # score 0 that starts here; the earlier start wins a tie
    gap_run = -GAP * unit * place
    above = np.broadcast_to(unit - 1 - np.arange(columns + 1, dtype=np.int64), (n, columns + 1)).copy()
    best = np.zeros(n, dtype=np.int64)
    best_end = np.zeros(n, dtype=np.int64)
    for r in range(rows):
        same = (item[:, r : r + 1] == passage) & item_ok[:, r : r + 1] & passage_ok
        cell = above[:, :-1] + np.where(same, MATCH, MISMATCH) * unit
        np.maximum(cell, above[:, 1:] + GAP * unit, out=cell)
        np.maximum(cell, fresh, out=cell)
        cell = np.maximum.accumulate(cell + gap_run, axis=1) - gap_run
        np.maximum(cell, fresh, out=cell)
        matched = np.where(same, cell, 0)
        end = matched.argmax(axis=1)
        top = matched[np.arange(n), end]
        better = top > best
        best = np.where(better, top, best)
        best_end = np.where(better, end + 1, best_end)
        above[:, 1:] = cell
    return best >> 24, np.where(best > 0, unit - 1 - (best & (unit - 1)), 0), best_end


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = [np.array(x, dtype=np.int64) for x in batch.column(3).to_pylist()]
        passages = [np.array(x, dtype=np.int64) for x in batch.column(4).to_pylist()]
        score, start, end = (np.zeros(len(items), dtype=np.int64) for _ in range(3))
        # Pairs of like size together, as many as the bound of cells allows.
        order = sorted(range(len(items)), key=lambda i: (len(passages[i]), len(items[i])))
        begin = 0
        while begin < len(order):
            stop = begin + 1
            while stop < len(order) and (stop - begin + 1) * len(passages[order[stop]]) <= BATCH_CELLS // 16:
                stop += 1
            chosen = order[begin:stop]
            score[chosen], start[chosen], end[chosen] = align([items[i] for i in chosen], [passages[i] for i in chosen])
            begin = stop
        offset = batch.column(2).to_numpy()
        yield record_batch(
            {
                "doc_id": batch.column(0),
                "item_id": batch.column(1),
                "score": score / (MATCH * np.array([len(x) for x in items], dtype=np.float64)),
                "start_word": (start + offset).astype(np.int32),
                "end_word": (end + offset).astype(np.int32),
            },
            _SCORED,
        )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): the best alignment of each
    document and item that reaches ``min_score`` of a perfect copy."""
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    items = written(item_words(benchmark, item_id, text).dropDuplicates(["item_id", "words"]), "items")
    placed = items.select("item_id", F.size("words").alias("m"), F.posexplode("grams").alias("item_at", "gram"))
    widths = sorted({SEED_WORDS} | {r["m"] for r in placed.filter(F.col("m") < SEED_WORDS).select("m").distinct().collect()})
    counts = written(gram_contexts(source, placed.select("gram"), widths), "gram-contexts")
    seeds = written(seeds_of(placed, counts), "seeds")
    hits = seed_hits(source, seeds.select("gram"), widths)
    hot = hottest(counts.join(seeds.select("gram").distinct(), "gram", "left_semi"), ["gram"], "places", HOT_PLACES)
    # A window of three item lengths around each stretch that a seed points to.
    start = F.col("at") - F.col("item_at")
    windows = written(
        salted_join(hits, seeds, ["gram"], hot, how="inner")
        .select("doc_id", "item_id", F.floor(start / F.greatest("m", F.lit(8))).cast("int").alias("slot"), F.greatest("m", F.lit(8)).alias("m"))
        .distinct(),
        "seed-windows",
    )
    shared = spark.sparkContext.broadcast(collect_bits(windows, slot_of(F.col("doc_id"))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = has(shared.value, batch.column(2).fill_null(0).to_numpy()) & np.array(batch.column(0).is_valid())
                if mask.any():
                    yield batch.filter(pa.array(mask))

        for ids, hashes, _, bounds in _word_lists(passed()):
            yield record_batch({"doc_id": ids, "words": [w.view(np.int64) for w in np.split(hashes, bounds[1:-1])]}, _TEXTS)

    texts = source.select("doc_id", "text", slot_of(F.col("doc_id")).alias("slot")).mapInArrow(thrifty(cut), _TEXTS)
    first = F.greatest(F.lit(0), F.col("slot") * F.col("m") - F.expr("m div 2"))
    pairs = (
        windows.join(texts, "doc_id")
        .select("doc_id", "item_id", first.cast("int").alias("offset"), F.slice("words", first + 1, F.col("m") * 3).alias("passage"))
        .filter("size(passage) > 0")
        .join(items.select("item_id", F.col("words").alias("item")), "item_id")
        .select("doc_id", "item_id", "offset", "item", "passage")
    )
    scored = pairs.mapInArrow(_aligned, _SCORED).filter(F.col("score") >= min_score)
    best = scored.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("score", (-F.col("start_word")).alias("minus_start"), "start_word", "end_word")).alias("best")
    )
    return best.select(F.col("doc_id").alias(doc_id), F.col("item_id").alias(item_id), "best.score", "best.start_word", "best.end_word")
