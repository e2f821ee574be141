"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams are counted: one of the target
texts, one of all raw texts.  A text's importance is the log ratio of its
probability under both; a sample without replacement in proportion to importance
is the top k of log importance plus Gumbel noise.  The noise is a hash of the id
and the seed, so that a repeated task draws the same.

Both counts are dense vectors of ``BUCKETS`` numbers per task, summed by Spark.  The
k-th largest key is found by range buckets, with no sort in one task.

Defined results: NULL and empty texts have log importance 0; equal rows get equal
keys, and of rows with equal keys and ids any may fill the sample's last place; a
NULL id draws the noise of a NULL; without target texts all importances are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.durable import written
from marquee.llm.bitmap import collect_bits, has, slot_of
from marquee.llm.frames import ROWS_AT_ONCE, bounded_batches, map_text, record_batch
from marquee.llm.words import blocks, mix, split_words
from marquee.operators.ranking import global_rank, with_range_bucket

BUCKETS = 65_536
SMOOTHING = 1.0
SEED = 11

_COUNTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("target", T.LongType()), T.StructField("raw", T.LongType())])


def ngram_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and the text of each."""
    words = split_words(texts)
    hashes = words.hashes(lower=False)
    pair = np.flatnonzero(words.doc[1:] == words.doc[:-1])
    pairs = mix(hashes[pair] * np.uint64(0x9E3779B97F4A7C15) + hashes[pair + 1])
    buckets = (np.concatenate([mix(hashes ^ np.uint64(1)), pairs]) % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.concatenate([words.doc, words.doc[pair]])


def _among(source: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``source`` (doc_id, text) with an id among ``ids``.  A bitmap of fixed size
    drops nearly all other texts before the exact join moves any."""
    shared = source.sparkSession.sparkContext.broadcast(collect_bits(ids, slot_of(F.col("doc_id"))))
    schema = source.schema

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = has(shared.value, batch.column(2).fill_null(0).to_numpy()) & np.array(batch.column(0).is_valid())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(hit)), batch.column(1).filter(pa.array(hit))], names=schema.names)

    found = source.select("*", slot_of(F.col("doc_id")).alias("slot")).mapInArrow(passed, schema)
    return found.join(ids.hint("merge"), "doc_id", "left_semi")


def ngram_counts(docs: DataFrame) -> np.ndarray:
    """(text, is_target) to counts of each bucket in the target texts and in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, raw = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(at, ROWS_AT_ONCE)
                texts, marks = rows.column(0).to_pylist(), np.array(rows.column(1).to_pylist(), dtype=bool)
                for begin, end in blocks(texts):
                    buckets, owner = ngram_buckets(texts[begin:end])
                    raw += np.bincount(buckets, minlength=BUCKETS)
                    target += np.bincount(buckets[marks[begin:end][owner]], minlength=BUCKETS)
        found = np.flatnonzero(raw)
        yield record_batch({"bucket": found.astype(np.int32), "target": target[found], "raw": raw[found]}, _COUNTS)

    sums = docs.mapInArrow(run, _COUNTS).groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow()
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    counts[:, sums.column("bucket").to_numpy()] = sums.column("target").to_numpy(), sums.column("raw").to_numpy()
    return counts


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of each bucket."""
    if not counts[0].sum():
        return np.zeros(BUCKETS)
    smoothed = counts + SMOOTHING
    shares = smoothed / smoothed.sum(axis=1, keepdims=True)
    return np.log(shares[0]) - np.log(shares[1])


def gumbel(key: Column, seed: int) -> Column:
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def importance(docs: DataFrame, ratios: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with ``log_importance``."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    added = T.StructType([T.StructField("log_importance", T.DoubleType())])

    def of(batches: Iterator[pa.Array]) -> Iterator[dict]:
        for column in batches:
            values = column.to_pylist()
            for begin, end in blocks(values):
                buckets, owner = ngram_buckets(values[begin:end])
                yield {"log_importance": np.bincount(owner, weights=shared.value[buckets], minlength=end - begin)}

    return map_text(docs, text, added, of)


def resample(docs: DataFrame, target_ids: DataFrame, share: float, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: id, ``log_importance``, ``key`` and ``kept``, true for
    the ``round(share * rows)`` largest keys.  ``target_ids`` has the ids of the target texts."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    targets = target_ids.select(F.col(doc_id).cast("bigint").alias("doc_id")).filter("doc_id is not null").distinct()
    whole = source.select("text", F.lit(False).alias("is_target"))
    aimed = _among(source, targets).select("text", F.lit(True).alias("is_target"))
    raw, target = ngram_counts(whole)[1], ngram_counts(aimed)[0]
    scored = importance(source, log_ratios(np.stack([target, raw])))
    keyed = written(scored.select("doc_id", "log_importance", (F.col("log_importance") + gumbel(F.col("doc_id"), seed)).alias("key")), "resampled")
    size = round(share * keyed.count())
    ranked = global_rank(with_range_bucket(keyed.withColumn("_down", -F.col("key")), "_down"), ["_down", "doc_id"], "_rank")
    return ranked.select(F.col("doc_id").alias(doc_id), "log_importance", "key", (F.col("_rank") <= size).alias("kept"))
