"""Toxicity scores by a convolutional text classifier, trained in numpy.

Words (in lower case, without punctuation) are hashed to embeddings, a word's being
the sum of its own and that of its first bytes, which inflected forms share; filters of
several widths slide over the whole text, their maxima over the text are pooled,
and a logistic layer gives the score.  Every labelled text is trained on: texts are
dealt to blocks by the hash of their id, a task fits the broadcast weights to a block,
and the fits are averaged by texts, a word's embedding over the blocks that changed it.
One threshold per language comes from all labelled texts too: each half of the blocks is
scored by a network that learned from the other half.  What the driver gathers is
bounded by the buckets of words.

Defined results: NULL and empty texts have the score of a text without known
words; equal texts get equal scores; with no or only one class of labels every
score is the share of positive labels (0.5 without labels).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.durable import written
from marquee.llm.bitmap import collect_bits, has, slot_of
from marquee.llm.frames import ROWS_AT_ONCE, bounded_batches, give_back, map_text, record_batch, squeeze, thrifty, unsqueeze
from marquee.llm.words import blocks, mix, split_words

BLOCK_TEXTS = 16_384
FAN_IN = 8  # fits that are averaged together
BUCKET_BITS = 20
PREFIX_BYTES = 4
LEAST_TEXTS = 3  # words in fewer labelled texts have no embedding
WIDTHS = (1, 2, 3)
FILTERS = 8
DIMENSION = 8
EPOCHS = 5
LEAST_STEPS = 600  # a small block is gone through more often
BATCH = 32
BLOCK_CHARS = 500_000
HELD_BYTES = 4 << 20  # of buckets on their way into a block
MIN_LANGUAGE_ROWS = 20
SCORE_RANGES = 16  # ranges of a unit of the logit in which thresholds are sought


@dataclass
class Model:
    slot: np.ndarray  # bucket to row of ``embedding``; row 0 is the zero vector
    embedding: np.ndarray
    filters: list[np.ndarray]  # per width: (width, dimension, filters)
    filter_bias: list[np.ndarray]
    weight: np.ndarray
    bias: float
    prior: float = 0.0
    constant: float | None = None

    def pooled(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Maxima over each text (texts, widths x filters), and where they are:
        the windows' values and the padded starts, by width."""
        counts = np.diff(bounds)
        pad = max(WIDTHS)
        # Each text is followed by zero vectors, so that no window sees two texts.
        starts = bounds[:-1] + np.arange(len(counts)) * pad
        rows = np.zeros((int(counts.sum()) + len(counts) * pad, 2), dtype=np.int64)
        owner = np.repeat(np.arange(len(counts)), counts)
        rows[np.arange(len(ids)) + owner * pad] = ids
        x = self.embedding[rows[:, 0]] + self.embedding[rows[:, 1]]
        out, places = [], []
        for k, width in enumerate(WIDTHS):
            z = x @ self.filters[k][0]
            for shift in range(1, width):
                z[:-shift] += (x @ self.filters[k][shift])[shift:]
            # Windows begin at a word or right behind the last one; later ones would reach the next text.
            edges = np.stack([starts, starts + counts + 1], axis=1).ravel()
            out.append(np.maximum.reduceat(z, edges, axis=0)[::2] if len(starts) else np.zeros((0, FILTERS), np.float32))
            places.append((z, starts))
        return np.concatenate(out, axis=1) + np.concatenate(self.filter_bias), [(z, rows) for z, _ in places]

    def logits(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.maximum(self.pooled(ids, bounds)[0], 0) @ self.weight + self.bias + self.prior

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        buckets, bounds = word_buckets(texts)
        return 1 / (1 + np.exp(-np.clip(self.logits(self.slot[buckets], bounds).astype(np.float64), -40, 40)))


def word_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and of its beginning, (words, 2), and the bounds of texts."""
    words = split_words(texts, bare=True)
    low = np.uint64((1 << BUCKET_BITS) - 1)
    whole, begin = words.hashes(lower=False), words.hashes(lower=False, first=PREFIX_BYTES)
    return np.stack([whole & low, mix(begin) & low], axis=1).astype(np.int32), words.bounds


def _bucketed(texts: list[str | None]) -> list[np.ndarray]:
    buckets, bounds = word_buckets(texts)
    return np.split(buckets, bounds[1:-1])


@dataclass
class Texts(Sequence):
    """Texts as pairs of numbers, one of each word, whose distinct ones are held once."""

    pairs: np.ndarray
    places: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def __getitem__(self, i):
        if isinstance(i, slice):
            return [self[k] for k in range(*i.indices(len(self)))]
        return self.pairs[self.places[self.bounds[i] : self.bounds[i + 1]]]

    def renamed(self, to: np.ndarray) -> Texts:
        """With ``to[number]`` in place of each number."""
        return Texts(to[self.pairs], self.places, self.bounds)


class _Adam:
    """Adam on dense arrays, and on rows of an array."""

    def __init__(self, rate: float):
        self.rate, self.first, self.second, self.step = rate, {}, {}, 0

    def update(self, name: str, value: np.ndarray, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        m = self.first.setdefault(name, np.zeros_like(value))
        v = self.second.setdefault(name, np.zeros_like(value))
        m[rows] = 0.9 * m[rows] + 0.1 * gradient
        v[rows] = 0.999 * v[rows] + 0.001 * gradient * gradient
        value[rows] -= self.rate * (m[rows] / (1 - 0.9**self.step)) / (np.sqrt(v[rows] / (1 - 0.999**self.step)) + 1e-7)


def _fresh(texts_of: np.ndarray, rng: np.random.Generator) -> Model:
    """An untrained network whose words are the buckets in enough texts."""
    known = np.flatnonzero(texts_of >= LEAST_TEXTS)
    slot = np.zeros(1 << BUCKET_BITS, dtype=np.int32)
    slot[known] = np.arange(1, len(known) + 1)
    embedding = rng.normal(0, 0.1, (len(known) + 1, DIMENSION)).astype(np.float32)
    embedding[0] = 0
    return Model(
        slot,
        embedding,
        [rng.normal(0, 0.3, (w, DIMENSION, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32),
        0.0,
    )


def train(buckets: list[np.ndarray], labels: np.ndarray, seed: int = 17) -> Model:
    """Fit on texts as arrays of buckets, in one place."""
    rng = np.random.default_rng(seed)
    texts_of = np.zeros(1 << BUCKET_BITS, dtype=np.int32)
    for b in buckets:
        texts_of[np.unique(b)] += 1
    model = _fresh(texts_of, rng)
    fit_texts(model, [model.slot[b] for b in buckets], labels, max(EPOCHS, -(-LEAST_STEPS * BATCH // len(buckets))), rng)
    return model


def fit_texts(model: Model, texts: Sequence[np.ndarray], labels: np.ndarray, passes: int, rng: np.random.Generator) -> None:
    """Adam from the weights of ``model``, which change, over texts as rows of its embedding."""
    adam = _Adam(0.01)
    bias = np.array([model.bias], np.float32)
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            picked = [texts[i] for i in chosen]
            counts = [len(t) for t in picked]
            bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            model.bias = float(bias[0])
            pooled, windows = model.pooled(np.concatenate(picked), bounds)
            active = np.maximum(pooled, 0)
            p = 1 / (1 + np.exp(-(active @ model.weight + model.bias)))
            error = ((p - labels[chosen]) / len(chosen)).astype(np.float32)
            adam.step += 1
            back = np.outer(error, model.weight) * (pooled > 0)
            starts = bounds[:-1] + np.arange(len(chosen)) * max(WIDTHS)
            row_ids, row_gradients = [], []
            spans = np.array(counts) + max(WIDTHS)
            owner = np.repeat(np.arange(len(chosen)), spans)
            # Behind a text there is one window, which sees nothing of the next.
            inner = np.arange(len(owner)) - np.repeat(starts, spans) <= np.repeat(counts, spans)
            for k, width in enumerate(WIDTHS):
                z, rows = windows[k]
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                best = pooled[:, k * FILTERS : (k + 1) * FILTERS] - model.filter_bias[k]
                # First window with the maximum, of each text and filter that learns.
                least = np.where(part != 0, best - np.float32(1e-6), np.float32(np.inf))
                place, of = np.divmod(np.flatnonzero(z >= np.repeat(least, spans, axis=0)), FILTERS)
                place, of = place[inner[place]], of[inner[place]]
                key, first = np.unique(owner[place] * FILTERS + of, return_index=True)
                change = part.ravel()[key][:, None]
                gradient = np.zeros_like(model.filters[k])
                for shift in range(width):
                    seen = rows[np.minimum(place[first] + shift, len(rows) - 1)]
                    x = model.embedding[seen].sum(axis=1) * change
                    gradient[shift] = np.stack([np.bincount(key % FILTERS, weights=x[:, d], minlength=FILTERS) for d in range(DIMENSION)])
                    moved = change * model.filters[k][shift].T[key % FILTERS]
                    row_ids += [seen[:, 0], seen[:, 1]]
                    row_gradients += [moved, moved]
                adam.update(f"filter{k}", model.filters[k], gradient)
                adam.update(f"filter_bias{k}", model.filter_bias[k], part.sum(axis=0))
            adam.update("weight", model.weight, active.T @ error + 1e-4 * model.weight)
            adam.update("bias", bias, np.array([error.sum()], np.float32))
            ids, inverse = np.unique(np.concatenate(row_ids), return_inverse=True)
            moves = np.concatenate(row_gradients)
            summed = np.stack([np.bincount(inverse, weights=moves[:, d], minlength=len(ids)) for d in range(DIMENSION)], axis=1).astype(np.float32)
            real = ids > 0
            adam.update("embedding", model.embedding, summed[real], ids[real])
    model.bias = float(bias[0])


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The threshold with the best F1; halfway between two scores."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + max(labels.sum(), 1))
    last = np.append(scores[order][1:] != scores[order][:-1], True)
    k = int(np.argmax(np.where(last, f1, -1)))
    below = scores[order][k + 1] if k + 1 < len(order) else 0.0
    return float((scores[order][k] + below) / 2)


@dataclass
class Fitted:
    model: Model
    thresholds: dict[str, float]
    default_threshold: float


_TEXT = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("lang", T.StringType()),
        T.StructField("buckets", T.BinaryType()),
    ]
)
_BLOCK = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("labels", T.ArrayType(T.IntegerType())),
        T.StructField("langs", T.ArrayType(T.StringType())),
        T.StructField("counts", T.BinaryType()),
        T.StructField("pairs", T.BinaryType()),
        T.StructField("words", T.ArrayType(T.BinaryType())),
    ]
)
_IN_TEXTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("half", T.IntegerType()), T.StructField("n", T.LongType())])
_FIT = T.StructType([T.StructField(n, T.LongType()) for n in ("slot", "n")] + [T.StructField(n, T.BinaryType()) for n in ("dense", "rows", "sums", "held")])
_JUDGED = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("range", T.IntegerType()),
    ]
)


class Packer:
    """The texts of a block in turn as one row: the distinct pairs of buckets once, the words
    as places among them.  A row takes fewer bytes than the buckets
    of its texts (0.29 of them for 11,400 texts)."""

    def __init__(self, block: int):
        self.block = block
        self.labels: list[int] = []
        self.langs: list[str | None] = []
        self.counts: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, bytes]] = []

    def add(self, batch: pa.RecordBatch) -> None:
        """Rows of the block, as in ``_TEXT``."""
        self.labels += batch.column(2).to_pylist()
        self.langs += batch.column(3).to_pylist()
        texts = [np.frombuffer(b, np.int32).reshape(-1, 2) for b in batch.column(4).to_pylist()]
        self.counts.append(np.array([len(t) for t in texts], dtype=np.int32))
        words = np.concatenate(texts).astype(np.uint64)
        distinct, index = np.unique(words[:, 0] << np.uint64(BUCKET_BITS) | words[:, 1], return_inverse=True)
        self.parts.append((distinct, squeeze(index, np.uint32)))

    def row(self) -> pa.RecordBatch:
        every = np.unique(np.concatenate([d for d, _ in self.parts]))
        words = [squeeze(np.searchsorted(every, d)[unsqueeze(w, np.uint32)], np.uint32) for d, w in self.parts]
        columns = {"counts": np.concatenate(self.counts).tobytes(), "pairs": squeeze(np.diff(every, prepend=np.uint64(0)), np.uint64), "words": words}
        return record_batch({"block": [self.block], "labels": [self.labels], "langs": [self.langs], **{k: [v] for k, v in columns.items()}}, _BLOCK)


def text_blocks(docs: DataFrame, marked: DataFrame, total: int) -> DataFrame:
    """Every labelled text as buckets, a row for each block of about ``BLOCK_TEXTS`` texts at most.

    The number of blocks is even, so that they have halves.  No text is moved: a bitmap of the
    labelled ids says where buckets are worth while, and these go to their block once, where
    they meet their labels."""
    number = 2 * -(-total // (2 * BLOCK_TEXTS))
    key = F.col("doc_id").cast("bigint")
    block = F.pmod(F.xxhash64(key), F.lit(number)).alias("block")
    named = docs.filter("doc_id is not null").select(block, key.alias("doc_id"), slot_of(key).alias("slot"), "lang", "text")
    bits = docs.sparkSession.sparkContext.broadcast(collect_bits(marked, slot_of(key)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            likely = batch.filter(pa.array(has(bits.value, batch.column(2).to_numpy())))
            texts = likely.column(4).to_pylist()
            for a, b in blocks(texts):
                part = likely.slice(a, b - a)
                columns = {"block": part.column(0), "doc_id": part.column(1), "label": [None] * (b - a), "lang": part.column(3)}
                yield record_batch({**columns, "buckets": [x.tobytes() for x in _bucketed(texts[a:b])]}, _TEXT)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer: Packer | None = None
        for batch in batches:
            of = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b > a:
                    if packer is not None and packer.block != of[a]:
                        yield packer.row()
                        packer = None
                    packer = packer or Packer(int(of[a]))
                    packer.add(batch.slice(a, b - a))
        if packer is not None:
            yield packer.row()

    none = F.lit(None)
    given = marked.select(block, key.alias("doc_id"), "label", none.cast("string").alias("lang"), none.cast("binary").alias("buckets"))
    both = named.mapInArrow(thrifty(cut), _TEXT).unionByName(given)
    placed = both.repartition("block").sortWithinPartitions("block", "doc_id", F.col("buckets").isNotNull(), "label", "lang", "buckets")
    return written(placed.mapInArrow(thrifty(lambda batches: pack(_labelled(batches))), _BLOCK), "toxicity-blocks")


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each of their labels, from rows in which the labels of an id (without buckets)
    come before its texts; ids that only one side has give nothing."""
    rows: list[tuple] = []
    size = 0
    for row in _joined(batches):
        rows.append(row)
        size += len(row[-1])
        if size >= HELD_BYTES or len(rows) >= ROWS_AT_ONCE:
            yield record_batch(dict(zip(_TEXT.names, zip(*rows, strict=True), strict=True)), _TEXT)
            rows, size = [], 0
    if rows:
        yield record_batch(dict(zip(_TEXT.names, zip(*rows, strict=True), strict=True)), _TEXT)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as in ``_TEXT``: of each id by label, each text as often as the label is given."""
    of, labels, texts = None, Counter(), []
    for batch in batches:
        for block, doc_id, label, lang, buckets in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if doc_id != of:
                yield from _by_label(labels, texts)
                of, labels, texts = doc_id, Counter(), []
            if buckets is None:
                labels[label] += 1
            elif len(labels) == 1:
                yield from _by_label(labels, [(block, doc_id, lang, buckets)])
            elif labels:
                texts.append((block, doc_id, lang, buckets))
    yield from _by_label(labels, texts)


def _by_label(labels: Counter, texts: list[tuple]) -> Iterator[tuple]:
    for label, times in sorted(labels.items()):
        for block, doc_id, lang, buckets in texts:
            yield from [(block, doc_id, label, lang, buckets)] * times


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Texts]]:
    """One block at a time, and its texts as buckets."""
    low = np.uint64((1 << BUCKET_BITS) - 1)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            keys = np.cumsum(unsqueeze(row.pop("pairs"), np.uint64), dtype=np.uint64)
            pairs = np.stack([keys >> np.uint64(BUCKET_BITS), keys & low], axis=1).astype(np.int32)
            counts = np.frombuffer(row.pop("counts"), np.int32)
            places = np.concatenate([unsqueeze(w, np.uint32) for w in row.pop("words")])
            yield row, Texts(pairs, places, np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]))


def bucket_counts(packed: DataFrame) -> np.ndarray:
    """In how many texts each bucket is, by half of the blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts in _block_rows(batches):
            found = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
            for t in texts:
                found[np.unique(t)] += 1
            ids = np.flatnonzero(found)
            yield record_batch({"bucket": ids.astype(np.int32), "half": np.full(len(ids), row["block"] % 2), "n": found[ids]}, _IN_TEXTS)

    sums = packed.mapInArrow(thrifty(count), _IN_TEXTS).groupBy("bucket", "half").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, 1 << BUCKET_BITS), dtype=np.int64)
    counts[sums.column("half").to_numpy(), sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return counts


def _dense(model: Model) -> np.ndarray:
    return np.concatenate([x.ravel() for x in (*model.filters, *model.filter_bias, model.weight, np.array([model.bias]))]).astype(np.float64)


def _with_dense(model: Model, values: np.ndarray) -> Model:
    shapes = [x.shape for x in (*model.filters, *model.filter_bias, model.weight)]
    parts, at = [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        parts.append(values[at : at + size].reshape(shape).astype(np.float32))
        at += size
    k = len(WIDTHS)
    return Model(model.slot, model.embedding, parts[:k], parts[k : 2 * k], parts[-1], float(values[at]))


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    """Sums of weighted fits, in order of the blocks they come from; ``held`` counts the texts
    behind a row of the embedding, all those of a single block."""
    try:
        return _sum_of(group)
    finally:
        give_back()


def _sum_of(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["slot", "n"])
    rows = [np.frombuffer(b, np.int32) for b in group["rows"]]
    every = np.unique(np.concatenate(rows))
    sums, held = np.zeros((len(every), DIMENSION)), np.zeros(len(every), dtype=np.int64)
    for own, s, h, n in zip(rows, group["sums"], group["held"], group["n"], strict=True):
        at = np.searchsorted(every, own)
        sums[at] += np.frombuffer(s, np.float32).reshape(-1, DIMENSION)
        held[at] += n if h is None else np.frombuffer(h, np.int64)
    dense = sum(np.frombuffer(b, np.float64) for b in group["dense"])
    blobs = {"dense": dense.tobytes(), "rows": every.tobytes(), "sums": sums.astype(np.float32).tobytes(), "held": held.tobytes()}
    return pd.DataFrame({"slot": [group["slot"].iloc[0] // FAN_IN], "n": [group["n"].sum()], **{k: [v] for k, v in blobs.items()}})


def train_blocks(packed: DataFrame, texts_of: np.ndarray, number: int, seed: int = 17) -> Model:
    """``EPOCHS`` rounds over all texts of ``number`` packed blocks: local fits, averaged by texts."""
    rng = np.random.default_rng(seed)
    model = _fresh(texts_of, rng)
    for turn in range(EPOCHS):
        shared = packed.sparkSession.sparkContext.broadcast(model)

        def fit_block(batches: Iterator[pa.RecordBatch], turn: int = turn, shared=shared) -> Iterator[pa.RecordBatch]:
            whole = shared.value
            for row, buckets in _block_rows(batches):
                # Rows of the embedding in this block, and their places in a local one.
                mark = np.arange(len(whole.embedding)) == 0
                mark[whole.slot[buckets.pairs]] = True
                own, place = np.flatnonzero(mark).astype(np.int32), np.cumsum(mark, dtype=np.int32) - 1
                local = _with_dense(whole, _dense(whole))
                local.embedding = whole.embedding[own]
                passes = max(1, round(LEAST_STEPS * BATCH / (EPOCHS * len(buckets))))
                here = buckets.renamed(place[whole.slot])
                fit_texts(local, here, np.array(row["labels"], np.float32), passes, np.random.default_rng([seed, turn, row["block"]]))
                n, moved = len(buckets), np.flatnonzero((local.embedding != whole.embedding[own]).any(axis=1))
                blobs = {"dense": (_dense(local) * n).tobytes(), "rows": own[moved].tobytes(), "sums": (local.embedding[moved] * n).astype(np.float32).tobytes()}
                yield record_batch({"slot": [row["block"]], "n": [n], **{k: [v] for k, v in blobs.items()}, "held": [None]}, _FIT)

        fits, left = packed.mapInArrow(thrifty(fit_block), _FIT), number
        while left > 1:
            fits = fits.withColumn("_over", F.expr(f"slot div {FAN_IN}")).groupBy("_over").applyInPandas(_summed, _FIT)
            left = -(-left // FAN_IN)
        rows = fits.toArrow().to_pylist()
        if not rows:
            break
        found = _summed(pd.DataFrame(rows)).iloc[0]
        model = _with_dense(model, np.frombuffer(found["dense"], np.float64) / found["n"])
        model.embedding = model.embedding.copy()
        held = np.frombuffer(found["held"], np.int64)[:, None]
        model.embedding[np.frombuffer(found["rows"], np.int32)] = np.frombuffer(found["sums"], np.float32).reshape(-1, DIMENSION) / held
        shared.unpersist()
    return model


def judged(packed: DataFrame, models: list[Model]) -> DataFrame:
    """(lang, label, score, range) of every text, scored by the model of the other half."""
    shared = packed.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, buckets in _block_rows(batches):
            model = shared.value[1 - row["block"] % 2]
            for at in range(0, len(buckets), BATCH):
                part = buckets[at : at + BATCH]
                bounds = np.concatenate([[0], np.cumsum([len(b) for b in part])]).astype(np.int64)
                z = np.clip(model.logits(model.slot[np.concatenate(part)], bounds).astype(np.float64), -40, 40)
                langs = [lang or "" for lang in row["langs"][at : at + BATCH]]
                columns = {"lang": langs, "label": row["labels"][at : at + BATCH], "score": 1 / (1 + np.exp(-z))}
                yield record_batch({**columns, "range": np.floor(z * SCORE_RANGES).astype(np.int32)}, _JUDGED)

    return packed.mapInArrow(thrifty(run), _JUDGED)


def best_thresholds(scores: DataFrame, *keys: str) -> DataFrame:
    """As :func:`best_threshold` for each group of rows (score, label, range), with the number of
    rows ``n`` and of positive ones ``hits``.  ``range`` ascends with the score, and the rows
    of one are ordered together; the ranges of a group are few."""
    same = scores.groupBy(*keys, "range", "score").agg(F.sum("label").alias("hits"), F.count(F.lit(1)).alias("n"))
    per_range = same.groupBy(*keys, "range").agg(F.sum("hits").alias("_hits"), F.sum("n").alias("_n"), F.max("score").alias("_highest"))
    above = W.partitionBy(*keys).orderBy(F.desc("range"))
    before, whole = above.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(*keys)

    def sums(column: str, over: W) -> Column:
        return F.coalesce(F.sum(column).over(over), F.lit(0))

    carried = per_range.select(
        *keys, "range", sums("_hits", before).alias("_hits0"), sums("_n", before).alias("_n0"), F.lead("_highest").over(above).alias("_below"),
        sums("_hits", whole).alias("_positive"), sums("_n", whole).alias("_rows"),
    )
    here = W.partitionBy(*keys, "range").orderBy(F.desc("score"))
    found = same.join(carried, [*keys, "range"])
    hits, n = F.sum("hits").over(here) + F.col("_hits0"), F.sum("n").over(here) + F.col("_n0")
    below = F.coalesce(F.lead("score").over(here), F.col("_below"), F.lit(0.0))
    f1 = 2 * hits / (n + F.greatest("_positive", F.lit(1)))
    each = found.select(*keys, "_positive", "_rows", F.struct(f1.alias("f1"), F.col("score"), ((F.col("score") + below) / 2).alias("threshold")).alias("_at"))
    best = each.groupBy(*keys).agg(F.max("_at").alias("_at"), F.first("_positive").alias("hits"), F.first("_rows").alias("n"))
    return best.select(*keys, "n", "hits", F.col("_at.threshold").alias("threshold"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Fitted:
    """Train on ``docs`` (doc_id, text, lang) with ``labels`` (doc_id and a 0/1 column).

    Rows to be kept out of training must not be in ``labels``.
    """
    bounded_batches(docs.sparkSession)
    marked = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
    shares = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(shares.values())
    if len(shares) < 2:
        constant = shares.get(1, 0) / total if total else 0.5
        return Fitted(Model(np.zeros(0), np.zeros(0), [], [], np.zeros(0), 0.0, constant=constant), {}, 0.7)
    packed = text_blocks(docs, marked, total)
    each = packed.select("block", F.explode("labels").alias("label")).groupBy((F.col("block") % 2).alias("half"))
    trained = {r["half"]: r for r in each.agg(F.sum("label").alias("hits"), F.count(F.lit(1)).alias("n"), F.count_distinct("block").alias("blocks")).collect()}
    if not trained:  # no text of a label
        return Fitted(Model(np.zeros(0), np.zeros(0), [], [], np.zeros(0), 0.0, constant=shares[1] / total), {}, 0.7)

    def model_of(halves: tuple[int, ...]) -> Model:
        rows = [trained[h] for h in halves if h in trained]
        model = train_blocks(packed.filter((F.col("block") % 2).isin(*halves)), counts[list(halves)].sum(axis=0), sum(r["blocks"] for r in rows))
        hits, n = sum(r["hits"] for r in rows), sum(r["n"] for r in rows)
        model.prior = float(np.log(shares[1] / shares[0]) - np.log(max(hits, 1) / max(n - hits, 1)))
        return model

    counts = bucket_counts(packed)
    scores = written(judged(packed, [model_of((0,)), model_of((1,))]), "toxicity-judged")
    default = best_thresholds(scores).collect()
    # Languages with enough rows of both classes only.
    able = best_thresholds(scores, "lang").filter((F.col("n") >= MIN_LANGUAGE_ROWS) & F.col("hits").between(1, F.col("n") - 1))
    thresholds = {r["lang"]: r["threshold"] for r in able.collect()}
    return Fitted(model_of((0, 1)), thresholds, default[0]["threshold"] if default else 0.7)


def score_toxicity(docs: DataFrame, fitted: Fitted, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``score``, the ``threshold`` of the row's language and ``flagged``."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted.model)
    added = T.StructType([T.StructField("score", T.DoubleType())])

    def of(batches: Iterator[pa.Array]) -> Iterator[dict]:
        for column in batches:
            values = column.to_pylist()
            for a, b in blocks(values, BLOCK_CHARS):
                yield {"score": shared.value.scores(values[a:b])}

    scored = map_text(docs, text, added, of)
    threshold = F.lit(fitted.default_threshold)
    if fitted.thresholds:
        listed = F.create_map(*[F.lit(x) for pair in fitted.thresholds.items() for x in pair])
        threshold = F.coalesce(F.try_element_at(listed, F.coalesce(F.col(lang), F.lit(""))), threshold)
    return scored.withColumn("threshold", threshold).withColumn("flagged", F.col("score") >= F.col("threshold"))
