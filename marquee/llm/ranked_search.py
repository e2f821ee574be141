"""Ranked lexical search: dense blocked matrix products, exact integer scores.

The distinct terms of the items make up a compact vocabulary.  A task lays the impacts
of a tile of documents out as a dense float64 matrix over a tile of that vocabulary and
multiplies it (BLAS) by the items' weights over the same tile.  Weights go in limbs of
22 bits, so that a product of ``VOCABULARY_TILE`` columns stays below 2**53 whatever the
data: every partial sum is an exact integer, and limbs and tiles are summed in 64 bits.
Each task keeps the ``k`` best documents of each item, ties by the smaller id, and Spark
merges these lists: first by (item, slice of ids), then by item.

Items are the stated query set.  They are taken in passes of bounded text size, and what
is sent to the tasks is one pass's vocabulary; documents are read twice a pass (counts,
then scores) and never moved.

Defined results: NULL text has no terms.  An item without terms, or whose terms occur in
no document, has no rows; a document without terms is never listed.  Repeated rows of
documents are documents of their own, and repeated item rows each get their rows.  NULL
ids of documents come after all others among equal scores.  Empty tables give no rows.
Extra columns are ignored.  Ids of documents are integers.  A text of any length is read
whole, in pieces when it is long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.frames import ROWS_AT_ONCE, bounded_batches, record_batch
from marquee.llm.words import blocks, split_words

TOP_K = 20
# A pass holds so many characters of item texts at most, or one longer text.
PASS_CHARS = 16_000_000
ITEM_TILE = 512
DOCUMENT_TILE = 512
VOCABULARY_TILE = 2048
LIMB_BITS = 22
IMPACT_UNIT = 1_000_000_000
# The largest impact is below IMPACT_UNIT / 1000.
assert VOCABULARY_TILE * ((1 << LIMB_BITS) - 1) * (IMPACT_UNIT // 1000) < 1 << 53

# Candidates a task holds before it keeps the best of them only.
_HELD = 1 << 18
_PIECE_CHARS = 4_000_000
_TERM_BREAK = [chr(c) for c in range(128) if not chr(c).isalnum()]


def _pieces(text: str) -> Iterator[str]:
    """The text cut between terms into pieces of about ``_PIECE_CHARS``; a term stays whole."""
    begin = 0
    while len(text) - begin > _PIECE_CHARS:
        end = begin + _PIECE_CHARS
        while end < len(text) and text[end] not in _TERM_BREAK:
            end += 1
        yield text[begin:end]
        begin = end
    yield text[begin:]


def term_hashes(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, hash) of every term, in blocks of bounded size."""
    cut = [(i, piece) for i, t in enumerate(texts) if t for piece in (_pieces(t) if len(t) > _PIECE_CHARS else (t,))]
    for begin, end in blocks([p for _, p in cut]):
        number = np.array([i for i, _ in cut[begin:end]], dtype=np.int64)
        words = split_words([p for _, p in cut[begin:end]], bare=True, fold=False)
        yield number[words.doc], words.hashes(lower=True)


@dataclass
class Queries:
    """Items of a pass: ``vocabulary`` sorted hashes, and the items' counts as (item, term, count)."""

    ids: list
    vocabulary: np.ndarray
    item: np.ndarray
    term: np.ndarray
    count: np.ndarray

    def weights(self, documents: int, frequency: np.ndarray) -> np.ndarray:
        """Count times term weight, for each (item, term)."""
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequency], dtype=np.int64)
        return self.count * weight[self.term]


def queries_of(rows: Sequence[tuple[object, str | None]]) -> Queries:
    found = list(term_hashes([text for _, text in rows]))
    item = np.concatenate([i for i, _ in found]) if found else np.zeros(0, np.int64)
    hashes = np.concatenate([h for _, h in found]) if found else np.zeros(0, np.uint64)
    vocabulary, term = np.unique(hashes, return_inverse=True)
    pairs, count = np.unique(item * max(1, len(vocabulary)) + term, return_counts=True)
    return Queries([i for i, _ in rows], vocabulary, pairs // max(1, len(vocabulary)), pairs % max(1, len(vocabulary)), count.astype(np.int64))


def _passes(items: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple[object, str | None]]]:
    held: list[tuple[object, str | None]] = []
    size = 0
    for row in items.select(item_id, text).toLocalIterator():
        n = len(row[1] or "")
        if held and size + n > limit:
            yield held
            held, size = [], 0
        held.append((row[0], row[1]))
        size += n
    if held:
        yield held


def _in_vocabulary(vocabulary: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each hash in the vocabulary, and whether it is there."""
    place = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
    return place, vocabulary[place] == hashes if len(vocabulary) else np.zeros(len(hashes), dtype=bool)


def term_counts(texts: Sequence[str | None], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and (text, vocabulary place, occurrences) of those in the vocabulary."""
    length = np.zeros(len(texts), dtype=np.int64)
    keys, counts = [], []
    for number, hashes in term_hashes(texts):
        length += np.bincount(number, minlength=len(texts))
        place, there = _in_vocabulary(vocabulary, hashes)
        key, count = np.unique(number[there] * len(vocabulary) + place[there], return_counts=True)
        keys.append(key)
        counts.append(count)
    if not keys:
        none = np.zeros(0, np.int64)
        return length, none, none, none
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.bincount(which, np.concatenate(counts), minlength=len(key)).astype(np.int64)
    width = max(1, len(vocabulary))
    return length, key // width, key % width, count


def corpus_counts(docs: DataFrame, text: str, vocabulary: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms in all, and the document frequency of each vocabulary term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary) + 2, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                length, _, place, _ = term_counts(batch.column(0).slice(at, ROWS_AT_ONCE).to_pylist(), vocabulary)
                total[:-2] += np.bincount(place, minlength=len(vocabulary))
                total[-2] += np.count_nonzero(length)
                total[-1] += length.sum()
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], names=["slot", "n"])

    counted = docs.select(text).mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(len(vocabulary) + 2, dtype=np.int64)
    total[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    return int(total[-2]), int(total[-1]), total[:-2]


@dataclass
class Best:
    """The ``k`` best documents of each item among those seen so far."""

    items: int
    k: int

    def __post_init__(self):
        self.threshold = np.ones(self.items, dtype=np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, first_item: int, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        """``scores``: items x documents, for the items from ``first_item`` on."""
        item, doc = np.nonzero(scores >= self.threshold[first_item : first_item + len(scores), None])
        self.parts.append((item + first_item, scores[item, doc], unnamed[doc], ids[doc]))
        self.held += len(item)
        if self.held > _HELD:
            self.keep()

    def keep(self) -> tuple[np.ndarray, ...]:
        item, score, unnamed, ids = (np.concatenate(x) for x in zip(*self.parts, strict=True)) if self.parts else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((ids, unnamed, -score, item))
        item, score, unnamed, ids = item[order], score[order], unnamed[order], ids[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.k - 1
        self.threshold[item[last]] = score[last]
        kept = tuple(x[place < self.k] for x in (item, score, unnamed, ids))
        self.parts, self.held = [kept], len(kept[0])
        return kept


def _scatter(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    out = np.zeros(shape)
    out[rows, columns] = values
    return out


def tile_scores(
    doc: np.ndarray, term: np.ndarray, impact: np.ndarray, documents: int, item: np.ndarray, query_term: np.ndarray, weight: np.ndarray, items: int
) -> np.ndarray:
    """Scores, items x documents, of triples sorted by nothing in particular.

    Only vocabulary columns that both sides use are laid out, ``VOCABULARY_TILE`` at a time."""
    scores = np.zeros((items, documents), dtype=np.int64)
    used = np.intersect1d(term, query_term)
    for at in range(0, len(used), VOCABULARY_TILE):
        columns = used[at : at + VOCABULARY_TILE]
        place, there = _in_vocabulary(columns, term)
        left = _scatter(doc[there], place[there], impact[there], (documents, len(columns)))
        place, there = _in_vocabulary(columns, query_term)
        rows, cells, rest, shift = item[there], place[there], weight[there], 0
        while rest.any():
            right = _scatter(rows, cells, rest & ((1 << LIMB_BITS) - 1), (items, len(columns)))
            scores += (right @ left.T).astype(np.int64) << shift
            rest, shift = rest >> LIMB_BITS, shift + LIMB_BITS
    return scores


def _scored(docs: DataFrame, doc_id: str, text: str, queries: Queries, counts: tuple[int, int, np.ndarray], k: int) -> DataFrame:
    documents, all_terms, frequency = counts
    vocabulary, item, term, items = queries.vocabulary, queries.item, queries.term, len(queries.ids)
    weight = queries.weights(documents, frequency)
    schema = T.StructType([T.StructField("item_no", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(items, k)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENT_TILE):
                tile = batch.slice(at, DOCUMENT_TILE)
                length, doc, place, count = term_counts(tile.column(1).to_pylist(), vocabulary)
                m = 100 - 25 + (25 * length * documents) // max(1, all_terms)
                impact = (IMPACT_UNIT * count) // (1000 * count + 12 * m[doc])
                ids = tile.column(0)
                unnamed = ids.is_null().to_numpy(zero_copy_only=False)
                named = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                for first in range(0, items, ITEM_TILE):
                    begin, end = np.searchsorted(item, [first, first + ITEM_TILE])
                    scores = tile_scores(doc, place, impact, tile.num_rows, item[begin:end] - first, term[begin:end], weight[begin:end], min(ITEM_TILE, items - first))
                    best.add(first, scores, named, unnamed)
        number, score, unnamed, ids = best.keep()
        yield record_batch({"item_no": number, "doc_id": pa.array(ids, mask=unnamed.astype(bool)), "score": score}, schema)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def ranked_search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", k: int = TOP_K, pass_chars: int = PASS_CHARS
) -> DataFrame:
    """(item_id, item_no, rank, doc_id, score): the ``k`` best documents of each item.

    ``item_no`` numbers the rows of ``items``, so that rows with one id stay apart.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    id_type = items.schema[item_id].dataType
    found = spark.createDataFrame([], T.StructType([T.StructField("item_no", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType()), T.StructField("item_id", id_type)]))
    offset = 0
    for rows in _passes(items, item_id, text, pass_chars):
        queries = queries_of(rows)
        if len(queries.vocabulary) and (counts := corpus_counts(docs, text, queries.vocabulary))[0]:
            names = spark.createDataFrame(list(enumerate(queries.ids)), T.StructType([T.StructField("item_no", T.LongType()), T.StructField("item_id", id_type)]))
            best = _scored(docs, doc_id, text, queries, counts, k).join(names, "item_no")
            found = found.unionByName(best.withColumn("item_no", F.col("item_no") + offset))
        offset += len(rows)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    sliced = Window.partitionBy("item_no", F.pmod(F.xxhash64("doc_id"), F.lit(32))).orderBy(*order)
    whole = Window.partitionBy("item_no").orderBy(*order)
    firsts = found.withColumn("rank", F.row_number().over(sliced)).filter(F.col("rank") <= k)
    ranked = firsts.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "item_no", "rank", "doc_id", "score")
