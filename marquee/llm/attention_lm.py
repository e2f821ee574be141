"""Language-model scores by causal self-attention on subword ids, trained in numpy.

Tokens are words (A-Z in lower case) and one end per text.  Passes over all
training texts, through shuffles that grow with the corpus, gather the count of
every word (the base model) and the count of every subword id; the network learns
from windows that cover every training text, in the partitions where they stand.  It
has one causal attention layer over windows of subword ids and predicts the class of
every id from the ids before it; the id inside its class follows its corpus count.
Every id of a text is trained on and scored.  A token is the class of its first id and
then one of two: a token of the corpus, by its count, or, by the chance that the class
brings a new one, its ids one by one.

Windows overlap: each id is scored once, in the window where it has the most
context, and the last ``OVERLAP`` ids of a window are the first of the next.  Windows
start at the beginning of each text, so equal texts have equal scores.

Texts are cut into words once and kept as packed blocks in the shared folder.  Word
counts travel between blocks and ranges of the word space as packed arrays; no
count table is broadcast or collected.  Training runs in as many tasks as the blocks
have partitions, and Spark sums their weights ``FAN_IN`` at a time.  What the driver
gathers is bounded: counts per subword id, and the last of these sums.

Defined results: NULL and empty texts are one end token; equal texts get equal
results, but for the last digits of single-precision sums; without training texts every count is 0 and the network stays untrained;
a row with a NULL id is scored and counted like the others.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.durable import written
from marquee.llm.frames import bounded_batches, record_batch, squeeze, unsqueeze
from marquee.llm.ngram_join import pack, unpack
from marquee.llm.words import _LOWER, blocks, split_words

VOCABULARY = "byte_bpe_50k.tiktoken"
N_IDS = 50_257
END = 50_256
CHUNK_CHARS = 2_000_000
ROWS_AT_ONCE = 1024
LINE_FEED = 198
WINDOW, OVERLAP = 32, 8
DIMENSION, HIDDEN = 8, 16
SINGLE_CLASSES, BAND_CLASSES = 96, 32
INPUT_IDS, INPUT_BUCKETS = 2048, 256
# The blocks are dealt to the rounds, so that together they pass over all windows once.
ROUNDS, BATCH = 3, 256
LOCAL_STEPS = 300  # at least so many in a round of a task, and one pass over its windows
FAN_IN = 256  # weights that are summed together
WINDOWS_PER_STEP = 200
REMEMBERED_WORDS = 1 << 19


_WHITE, _ASCII_WHITE = re.compile(r"\s"), re.compile(r"[\x1c-\x1f]")
# First and second bytes of white space beyond ASCII in UTF-8.
_WIDE_WHITE, _WIDE_WHITE_NEXT = np.zeros((2, 256), dtype=bool)
for _first, _second, *_ in (chr(c).encode() for c in range(0x80, 0x10000) if chr(c).isspace()):
    _WIDE_WHITE[_first] = _WIDE_WHITE_NEXT[_second] = True


@lru_cache(maxsize=1)
def _encoding(vocabulary: str) -> tiktoken.Encoding:
    import public_tokenizers

    with open(public_tokenizers.path(vocabulary), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


_CHUNK = T.StructType(
    [
        T.StructField("chunk", T.StringType()),
        T.StructField("doc_id", T.ArrayType(T.LongType())),
        T.StructField("held", T.ArrayType(T.BooleanType())),
        T.StructField("bounds", T.BinaryType()),
        T.StructField("words", T.BinaryType()),
        T.StructField("hashes", T.BinaryType()),
        T.StructField("pieces", T.BinaryType()),
        T.StructField("piece_counts", T.BinaryType()),
    ]
)


def _of_lines(encoding: tiktoken.Encoding, text: str, number: int, alone: dict[int, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids and counts of ``number`` words: those of ``alone`` are there, the others in the lines of ``text``."""
    ids = encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
    feeds = np.flatnonzero(ids == LINE_FEED)
    lengths, plain, odd = np.zeros(number, dtype=np.int64), np.ones(number, dtype=bool), sorted(alone)
    plain[odd] = False
    lengths[plain] = np.diff(np.append(feeds, len(ids))) - 1
    lengths[odd] = [len(alone[i]) for i in odd]
    flat = np.empty(int(lengths.sum()), dtype=np.int64)
    of_plain = np.repeat(plain, lengths)
    flat[of_plain] = ids[ids != LINE_FEED]
    flat[~of_plain] = [x for i in odd for x in alone[i]]
    return flat, lengths


def pieces_of(encoding: tiktoken.Encoding, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of all words, each with a blank before it, and how many each has.  Words are
    stretches of ``raw``, A-Z in lower case.

    Words are encoded in one text, a line each: no piece of the pattern crosses a line
    feed that a blank and a word follow.  Words with white space of their own go alone;
    only words with bytes that may be white space are looked at one by one.
    """
    doubtful = np.flatnonzero((raw >= 0x1C) & (raw <= 0x1F) | _WIDE_WHITE[raw] & _WIDE_WHITE_NEXT[np.append(raw[1:], 0)])
    alone: dict[int, list[int]] = {}
    for i in np.flatnonzero(np.searchsorted(doubtful, ends) > np.searchsorted(doubtful, starts)).tolist():
        word = _LOWER[raw[starts[i] : ends[i]]].tobytes().decode("utf-8", "replace")
        if (_ASCII_WHITE if word.isascii() else _WHITE).search(word):
            alone[i] = encoding.encode_ordinary(" " + word)
    plain = np.ones(len(starts), dtype=bool)
    plain[list(alone)] = False
    starts, sizes = starts[plain], ends[plain] - starts[plain]
    lines = np.cumsum(sizes + 2) - sizes
    text = np.full(int((sizes + 2).sum()), 0x20, dtype=np.uint8)
    text[lines - 2] = 0x0A
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text[np.repeat(lines, sizes) + within] = _LOWER[raw[np.repeat(starts, sizes) + within]]
    return _of_lines(encoding, text.tobytes().decode("utf-8", "replace"), len(plain), alone)


class Pieces:
    """Subword ids of words by their hash; words that were there are not encoded again.

    At most ``REMEMBERED_WORDS`` and the words of one block are kept."""

    def __init__(self, encoding: tiktoken.Encoding):
        self.encoding = encoding
        self.forget()

    def forget(self) -> None:
        self.hashes, self.at, self.lengths = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint16)

    def __call__(self, hashes: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words with ascending ``hashes`` that are stretches of ``raw``."""
        place = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == hashes[inside]
        if not known.all():
            if len(self.hashes) > REMEMBERED_WORDS:
                self.forget()
                known[:] = False
            flat, lengths = pieces_of(self.encoding, raw, starts[~known], ends[~known])
            at = len(self.flat) + np.cumsum(lengths) - lengths
            self.flat = np.concatenate([self.flat, flat.astype(np.uint16)])
            every = np.concatenate([self.hashes, hashes[~known]])
            order = np.argsort(every, kind="stable")
            self.hashes = every[order]
            self.at, self.lengths = np.concatenate([self.at, at])[order], np.concatenate([self.lengths, lengths])[order]
            place = np.searchsorted(self.hashes, hashes)
        at, lengths = self.at[place], self.lengths[place]
        first = np.cumsum(lengths) - lengths
        return self.flat[np.repeat(at - first, lengths) + np.arange(int(lengths.sum()))], lengths


def word_chunks(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text, held) to packed blocks: each text as indexes of the block's
    distinct words, which ascend by hash, with their subword ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces_by_hash = Pieces(_encoding(vocabulary))
        number = 0
        pieces_of_batch = (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE))
        for batch in pieces_of_batch:
            texts = batch.column(1).to_pylist()
            for begin, end in blocks(texts, CHUNK_CHARS):
                words = split_words(texts[begin:end])
                hashed = np.maximum(words.hashes(lower=True), np.uint64(1))
                distinct, first, index = np.unique(hashed, return_index=True, return_inverse=True)
                flat, lengths = pieces_by_hash(distinct, words.raw, words.starts[first], words.ends[first])
                part = batch.slice(begin, end - begin)
                columns = {
                    "chunk": [f"{TaskContext.get().partitionId()}-{number}"],
                    "doc_id": [part.column(0).to_pylist()],
                    "held": [part.column(2).to_pylist()],
                    "bounds": [words.bounds.astype(np.int32).tobytes()],
                    "words": [squeeze(index, np.uint32)],
                    "hashes": [squeeze(np.diff(distinct, prepend=np.uint64(0)), np.uint64)],
                    "pieces": [squeeze(flat, np.uint16)],
                    "piece_counts": [squeeze(lengths, np.uint32)],
                }
                number += 1
                yield record_batch(columns, _CHUNK)

    return docs.mapInArrow(run, _CHUNK)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One block at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


@dataclass
class Chunk:
    held: np.ndarray
    bounds: np.ndarray
    words: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Chunk:
        return cls(
            np.array([bool(h) for h in row["held"]], dtype=bool),
            np.frombuffer(row["bounds"], np.int32),
            unsqueeze(row["words"], np.uint32).astype(np.int64),
            np.cumsum(unsqueeze(row["hashes"], np.uint64), dtype=np.uint64),
        )

    @staticmethod
    def first_ids(row: dict) -> np.ndarray:
        lengths = unsqueeze(row["piece_counts"], np.uint32).astype(np.int64)
        return unsqueeze(row["pieces"], np.uint16)[np.cumsum(lengths) - lengths]

    def training_counts(self) -> np.ndarray:
        counted = np.repeat(~self.held, np.diff(self.bounds))
        return np.bincount(self.words[counted], minlength=len(self.hashes))


@dataclass
class Classes:
    """Class of each id, and its row of the input table."""

    of: np.ndarray
    slot: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray, firsts: np.ndarray) -> Classes:
        """The most frequent ids are classes of their own, the others bands of like frequency,
        those that mostly begin tokens (``firsts`` counts these) before those that go on."""
        by_count = np.argsort(-counts, kind="stable")
        of = np.zeros(N_IDS, dtype=np.int64)
        of[by_count[:SINGLE_CLASSES]] = np.arange(SINGLE_CLASSES)
        rest = by_count[SINGLE_CLASSES:]
        rest = rest[np.argsort(2 * firsts[rest] < counts[rest], kind="stable")]
        mass = np.cumsum(counts[rest] + 1)
        of[rest] = SINGLE_CLASSES + np.minimum((mass - 1) * BAND_CLASSES // mass[-1], BAND_CLASSES - 1)
        slot = INPUT_IDS + np.arange(N_IDS) % INPUT_BUCKETS
        slot[by_count[:INPUT_IDS]] = np.arange(INPUT_IDS)
        return cls(of, slot)

    def log_shares(self, counts: np.ndarray) -> np.ndarray:
        """Natural log of each id's share of its class, by counts smoothed by one."""
        smooth = counts + 1.0
        return np.log(smooth / np.bincount(self.of, weights=smooth)[self.of])


_SENT = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("chunk", T.StringType()),
        T.StructField("hashes", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
        T.StructField("classes", T.BinaryType()),
    ]
)
_ANSWER = T.StructType(
    [
        T.StructField("chunk", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("counts", T.BinaryType()),
        T.StructField("class", T.IntegerType()),
        T.StructField("tokens", T.LongType()),
        T.StructField("distinct", T.LongType()),
    ]
)


def word_counts(chunks: DataFrame, classes: Classes) -> DataFrame:
    """Per block and range of the word space the corpus counts of the block's words;
    rows without a block have the sums of a range by class."""
    shared = chunks.sparkSession.sparkContext.broadcast(classes.of)
    parts = 8 * int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk.of(row)
            if not len(chunk.hashes):
                continue
            counts = chunk.training_counts().astype(np.uint32)
            kinds = shared.value[chunk.first_ids(row)].astype(np.uint8)
            part = ((chunk.hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            found, starts = np.unique(part, return_index=True)
            yield record_batch(
                {
                    "part": found.astype(np.int32),
                    "chunk": [row["chunk"]] * len(found),
                    "hashes": [pack(h) for h in np.split(chunk.hashes, starts[1:])],
                    "counts": [c.tobytes() for c in np.split(counts, starts[1:])],
                    "classes": [c.tobytes() for c in np.split(kinds, starts[1:])],
                },
                _SENT,
            )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        hashes = [unpack(b) for b in group["hashes"]]
        counts = [np.frombuffer(b, np.uint32) for b in group["counts"]]
        distinct, first, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
        kinds = np.concatenate([np.frombuffer(b, np.uint8) for b in group["classes"]])[first]
        back = np.split(total[inverse], np.cumsum([len(h) for h in hashes])[:-1])
        out = pd.DataFrame({"chunk": group["chunk"], "part": group["part"], "counts": [b.astype("<i8").tobytes() for b in back]})
        found = np.unique(kinds)
        sums = pd.DataFrame(
            {
                "part": group["part"].iloc[0],
                "class": found,
                "tokens": np.bincount(kinds, weights=total)[found].astype(np.int64),
                "distinct": np.bincount(kinds, weights=total > 0)[found].astype(np.int64),
            }
        )
        both = pd.concat([out.astype(object), sums.astype(object)], ignore_index=True).reindex(columns=_ANSWER.names)
        return both.astype(object).where(both.notna(), None)

    sent = chunks.select("chunk", "held", "bounds", "words", "hashes", "pieces", "piece_counts").mapInArrow(send, _SENT)
    return sent.groupBy("part").applyInPandas(add, _ANSWER)


_ID_COUNT = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("firsts", T.LongType())])


def subword_counts(chunks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Count of each subword id, the end included, in the training texts: of all, and
    of those that begin a token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, firsts = np.zeros(N_IDS, dtype=np.int64), np.zeros(N_IDS, dtype=np.int64)
        for row in _rows(batches):
            chunk = Chunk.of(row)
            lengths = unsqueeze(row["piece_counts"], np.uint32)
            pieces = unsqueeze(row["pieces"], np.uint16)
            trained = chunk.training_counts()
            total += np.bincount(pieces, weights=np.repeat(trained, lengths), minlength=N_IDS).astype(np.int64)
            firsts += np.bincount(chunk.first_ids(row), weights=trained, minlength=N_IDS).astype(np.int64)
            total[END] += int((~chunk.held).sum())
        firsts[END] = total[END]
        ids = np.flatnonzero(total)
        yield record_batch({"id": ids.astype(np.int32), "n": total[ids], "firsts": firsts[ids]}, _ID_COUNT)

    sums = chunks.select("held", "bounds", "words", "hashes", "pieces", "piece_counts").mapInArrow(count, _ID_COUNT)
    found = sums.groupBy("id").agg(F.sum("n").alias("n"), F.sum("firsts").alias("firsts")).toArrow()
    counts = np.zeros((2, N_IDS), dtype=np.int64)
    counts[:, found.column("id").to_numpy()] = found.column("n").to_numpy(), found.column("firsts").to_numpy()
    return counts[0], counts[1]


def sequences(row: dict, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subword ids of all texts of a block, each with its end; the starts of the words,
    ends included, and of the texts."""
    pieces = np.append(unsqueeze(row["pieces"], np.uint16).astype(np.int64), END)
    lengths = np.append(unsqueeze(row["piece_counts"], np.uint32).astype(np.int64), 1)
    starts = np.cumsum(lengths) - lengths
    words = np.insert(chunk.words, chunk.bounds[1:], len(lengths) - 1)
    size = lengths[words]
    word_starts = np.cumsum(size) - size
    ids = pieces[np.repeat(starts[words] - word_starts, size) + np.arange(int(size.sum()))]
    text_words = chunk.bounds[:-1] + np.arange(len(chunk.bounds) - 1)
    return ids, word_starts, word_starts[text_words] if len(text_words) else np.zeros(0, np.int64)


def training_windows(row: dict, chunk: Chunk) -> np.ndarray:
    """Windows that cover every training text of a block from end to end, a row each: the
    id before it and its ids, each as twice the id, plus one if it is of the text."""
    ids, _, text_starts = sequences(row, chunk)
    ends = np.append(text_starts[1:], len(ids))[~chunk.held]
    text_starts = text_starts[~chunk.held]
    marked = 2 * ids + 1
    per_text = -(-(ends - text_starts) // WINDOW)
    number = np.arange(int(per_text.sum())) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    text = np.repeat(np.arange(len(per_text)), per_text)
    at = (text_starts[text] + number * WINDOW)[:, None] + np.arange(-1, WINDOW)
    inside = (at >= text_starts[text][:, None]) & (at < ends[text][:, None])
    return np.where(inside, marked[np.where(inside, at, 0)], 2 * END).astype(np.int32)


SHAPES = {
    "embedding": (INPUT_IDS + INPUT_BUCKETS, DIMENSION),
    "position": (WINDOW, DIMENSION),
    "query": (DIMENSION, DIMENSION),
    "key": (DIMENSION, DIMENSION),
    "value": (DIMENSION, DIMENSION),
    "own": (DIMENSION, HIDDEN),
    "mixed": (DIMENSION, HIDDEN),
    "hidden_bias": (HIDDEN,),
    "out": (HIDDEN, SINGLE_CLASSES + BAND_CLASSES),
    "out_bias": (SINGLE_CLASSES + BAND_CLASSES,),
}
_SEEN = np.tril(np.ones((WINDOW, WINDOW), dtype=np.float32))
# Exponents beyond this are cut, so that sums of exponentials stay finite in single precision.
_LARGEST = np.float32(60)


def _row_sums(x: np.ndarray) -> np.ndarray:
    """Sums along the last axis, which stays: a product is faster than a reduction."""
    return (x @ np.ones(x.shape[-1], x.dtype))[..., None]


def _views(values: np.ndarray) -> dict[str, np.ndarray]:
    """Weights by name in their common array."""
    weights, at = {}, 0
    for n, s in SHAPES.items():
        size = int(np.prod(s))
        weights[n] = values[at : at + size].reshape(s)
        at += size
    return weights


class Network:
    """Weights by name, and the forward and backward pass over windows of input slots."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, counts: np.ndarray, classes: Classes, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        weights = {n: (rng.normal(0, s[0] ** -0.5 if len(s) > 1 else 0.0, s)).astype(np.float32) for n, s in SHAPES.items()}
        weights["embedding"] = rng.normal(0, 0.5, SHAPES["embedding"]).astype(np.float32)
        share = np.bincount(classes.of, weights=counts + 1.0, minlength=SHAPES["out_bias"][0])
        weights["out_bias"] = np.log(share / share.sum()).astype(np.float32)
        return cls(weights)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[n].ravel() for n in SHAPES])

    @classmethod
    def unflat(cls, values: np.ndarray) -> Network:
        return cls(_views(values.astype(np.float32)))

    def hidden(self, slots: np.ndarray, wanted: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, ...]:
        """States of the wanted places of the windows, and what led to them."""
        w = self.w
        x = w["embedding"][slots] + w["position"]
        flat = x.reshape(-1, DIMENSION)
        q, k, v = ((flat @ w[n]).reshape(x.shape) for n in ("query", "key", "value"))
        s = np.matmul(q * np.float32(DIMENSION**-0.5), np.ascontiguousarray(k.transpose(0, 2, 1)))
        np.clip(s, -_LARGEST, _LARGEST, out=s)
        np.exp(s, out=s)
        s *= _SEEN
        s /= _row_sums(s)
        c = np.matmul(s, v)
        own, mixed = flat[wanted], c.reshape(-1, DIMENSION)[wanted]
        h = np.tanh(own @ w["own"] + mixed @ w["mixed"] + w["hidden_bias"])
        return h, x, q, k, v, s, own, mixed

    def log_classes(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probability of the target class of each row."""
        z = self.class_weights(h)
        chosen = z[np.arange(len(target)), target]
        np.exp(z, out=z)
        return chosen - np.log(_row_sums(z)[:, 0])

    def class_weights(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.w["out"]
        z += self.w["out_bias"]
        # States are between -1 and 1, so that most weights can't reach the bound.
        if (np.abs(self.w["out"]).sum(axis=0) + np.abs(self.w["out_bias"])).max() < _LARGEST:
            return z
        return np.clip(z, -_LARGEST, _LARGEST, out=z)

    def gradients(self, slots: np.ndarray, target: np.ndarray, valid: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        wanted = np.flatnonzero(valid)
        h, x, q, k, v, a, own, mixed = self.hidden(slots, wanted)
        p = self.class_weights(h)
        np.exp(p, out=p)
        p *= 1 / (_row_sums(p) * p.dtype.type(max(len(wanted), 1)))
        p[np.arange(len(p)), target.ravel()[wanted]] -= p.dtype.type(1 / max(len(wanted), 1))
        flat, scale = x.reshape(-1, DIMENSION), np.float32(DIMENSION**-0.5)
        g = {"out": h.T @ p, "out_bias": np.ones(len(p), p.dtype) @ p}
        back = (p @ w["out"].T) * (1 - h * h)
        g["own"], g["mixed"], g["hidden_bias"] = own.T @ back, mixed.T @ back, back.sum(axis=0)
        dx, dc = np.zeros_like(flat), np.zeros_like(flat)
        dx[wanted] = back @ w["own"].T
        dc[wanted] = back @ w["mixed"].T
        dc = dc.reshape(x.shape)
        dv = np.matmul(a.transpose(0, 2, 1), dc)
        ds = np.matmul(dc, np.ascontiguousarray(v.transpose(0, 2, 1)))
        ds -= np.einsum("ijk,ijk->ij", ds, a)[:, :, None]
        ds *= a
        ds *= scale
        dq, dk = np.matmul(ds, k), np.matmul(ds.transpose(0, 2, 1), q)
        for n, d in (("query", dq), ("key", dk), ("value", dv)):
            d = d.reshape(-1, DIMENSION)
            g[n] = flat.T @ d
            dx += d @ w[n].T
        g["position"] = dx.reshape(x.shape).sum(axis=0)
        place = slots.ravel()
        sums = [np.bincount(place, weights=dx[:, k], minlength=SHAPES["embedding"][0]) for k in range(DIMENSION)]
        g["embedding"] = np.stack(sums, axis=1).astype(dx.dtype)
        return g


def fit_windows(network: Network, classes: Classes, windows: np.ndarray, seed: int, epochs: int = 1, rate: float = 0.01) -> Network:
    """Adam over the windows (see ``training_windows``) on all ids of the texts."""
    n = len(windows)
    slots, target, valid = classes.slot[windows[:, :-1] >> 1], classes.of[windows[:, 1:] >> 1], (windows[:, 1:] & 1).astype(bool)
    flat = network.flat()
    fitted = Network(_views(flat))
    first, second, rng, step = np.zeros_like(flat), np.zeros_like(flat), np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for begin in range(0, n, BATCH):
            rows = order[begin : begin + BATCH]
            step += 1
            found = fitted.gradients(slots[rows], target[rows], valid[rows])
            g = np.concatenate([found[k].ravel() for k in SHAPES])
            first *= 0.9
            first += 0.1 * g
            second *= 0.999
            second += 0.001 * g * g
            by = np.sqrt(second / (1 - 0.999**step))
            by += 1e-7
            move = first / (1 - 0.9**step)
            move *= rate
            move /= by
            flat -= move
    return fitted


_WEIGHTS = T.StructType([T.StructField("slot", T.LongType()), T.StructField("n", T.LongType()), T.StructField("weights", T.BinaryType())])


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    """Sum of weighted weights, in order of the slots they come from."""
    group = group.sort_values(["slot", "n", "weights"])
    total = sum(np.frombuffer(w, np.float64) for w in group["weights"])
    return pd.DataFrame({"slot": [group["slot"].iloc[0] // FAN_IN], "n": [group["n"].sum()], "weights": [total.tobytes()]})


def averaged(fits: DataFrame) -> np.ndarray | None:
    """Mean weights of all tasks, by window count: a tree of sums of ``FAN_IN`` each."""
    for _ in range(3):
        fits = fits.withColumn("_over", F.expr(f"slot div {FAN_IN}")).groupBy("_over").applyInPandas(_summed, _WEIGHTS)
    rows = fits.toArrow().to_pylist()
    n = sum(r["n"] for r in rows)
    return sum(np.frombuffer(r["weights"], np.float64) for r in rows) / n if n else None


def train(chunks: DataFrame, counts: np.ndarray, classes: Classes) -> Network:
    """Rounds of local fits, one for each partition of the blocks, over all windows of the
    round's blocks where they stand; their weights are averaged by window count."""
    network = Network.fresh(counts, classes)
    dealt = chunks.select("chunk", "held", "bounds", "words", "hashes", "pieces", "piece_counts")
    for number in range(ROUNDS):
        shared = chunks.sparkSession.sparkContext.broadcast((network.flat(), classes))

        def fit(batches: Iterator[pa.RecordBatch], number: int = number, shared=shared) -> Iterator[pa.RecordBatch]:
            values, of = shared.value
            fitted, seen = Network.unflat(values), 0
            waiting: list[np.ndarray] = []
            for row in _rows(batches):
                waiting.append(training_windows(row, Chunk.of(row)))
                if sum(map(len, waiting)) >= LOCAL_STEPS * BATCH:
                    rows = np.concatenate(waiting)
                    fitted, seen, waiting = fit_windows(fitted, of, rows, number), seen + len(rows), []
            if sum(map(len, waiting)):
                rows = np.concatenate(waiting)
                epochs = 1 if seen else -(-LOCAL_STEPS * BATCH // len(rows))
                fitted, seen = fit_windows(fitted, of, rows, number, epochs), seen + len(rows)
            if seen:
                weights = (fitted.flat().astype(np.float64) * seen).tobytes()
                yield record_batch({"slot": [TaskContext.get().partitionId()], "n": [seen], "weights": [weights]}, _WEIGHTS)

        mine = dealt.filter(F.pmod(F.crc32(F.col("chunk").cast("binary")), F.lit(ROUNDS)) == number).drop("chunk")
        mean = averaged(mine.mapInArrow(fit, _WEIGHTS))
        if mean is not None:
            network = Network.unflat(mean)
    return network


def class_log_probabilities(network: Network, classes: Classes, ids: np.ndarray, places: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Natural log probability of the class of the id at each of ``places``, given the ids before it."""
    out = np.zeros(len(ids))
    lengths = np.diff(np.append(text_starts, len(ids)))
    step = WINDOW - OVERLAP
    per_text = 1 + np.maximum(0, -(-(lengths - WINDOW) // step))
    text = np.repeat(np.arange(len(lengths)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    slots, target = classes.slot[ids], classes.of[ids]
    asked = np.zeros(len(ids), dtype=bool)
    asked[places] = True
    previous = np.concatenate([[0], slots[:-1]])
    previous[text_starts] = classes.slot[END]
    offsets = np.arange(WINDOW)
    for begin in range(0, len(text), WINDOWS_PER_STEP):
        t, k = text[begin : begin + WINDOWS_PER_STEP], number[begin : begin + WINDOWS_PER_STEP]
        place = (k * step)[:, None] + offsets
        last = lengths[t][:, None] - 1
        at = text_starts[t][:, None] + np.minimum(place, last)
        scored = ((place <= last) & ((offsets >= OVERLAP) | (k == 0)[:, None]) & asked[at]).ravel()
        h = network.hidden(previous[at], scored)[0]
        at = at.ravel()[scored]
        out[at] = network.log_classes(h, target[at])
    return out[places]


def token_log_probabilities(
    by_class: np.ndarray, in_class: np.ndarray, word_starts: np.ndarray, count: np.ndarray, tokens: np.ndarray, distinct: np.ndarray
) -> np.ndarray:
    """Natural log probability of each token, from those of all ids: of their class and in it.

    A token has the class of its first id.  Of the ``tokens`` of that class in training,
    ``distinct`` were new when they came: by this share (Witten and Bell) the token is spelled
    id by id, else it is one of the corpus, by its ``count``."""
    first = by_class[word_starts]
    spelled = np.add.reduceat(by_class + in_class, word_starts) - first
    with np.errstate(divide="ignore"):
        both = np.logaddexp(np.log(count), np.log(distinct) + spelled) - np.log(np.maximum(tokens + distinct, 1))
    # A class that training has no token of only spells.
    return first + np.where(tokens + distinct > 0, both, spelled)


_SCORES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def score_chunks(
    chunks: DataFrame, answers: DataFrame, network: Network, classes: Classes, tokens: np.ndarray, distinct: np.ndarray, ends: int,
    shares: np.ndarray | None = None,
) -> DataFrame:
    """``tokens`` and ``distinct`` count the training tokens by class, ``ends`` the training texts.

    ``shares`` (see ``Classes.log_shares``) are those of ids in their class: every id of a text is
    scored (see ``token_log_probabilities``).  Without them a token is scored by its first id's
    class and its own count in there."""
    shared = chunks.sparkSession.sparkContext.broadcast((network.flat(), classes, shares))
    total, kinds = int(tokens.sum()), int(distinct.sum())
    by_chunk = (
        answers.filter("chunk is not null")
        .groupBy("chunk")
        .agg(F.sort_array(F.collect_list(F.struct("part", "counts"))).alias("parts"))
        .select("chunk", F.transform("parts", lambda p: p["counts"]).alias("counts"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, of, of_class = shared.value
        net = Network.unflat(weights)
        for row in _rows(batches):
            chunk = Chunk.of(row)
            counts = np.append(np.frombuffer(b"".join(row["counts"] or []), "<i8"), ends)
            ids, word_starts, text_starts = sequences(row, chunk)
            words = np.insert(chunk.words, chunk.bounds[1:], len(counts) - 1)
            count = counts[words]
            base = np.log((count + 1) / (total + kinds + 1))
            kind = of.of[ids[word_starts]]
            if of_class is None:
                inside = np.log((count + 1) / (tokens + distinct + 1)[kind])
                model = class_log_probabilities(net, of, ids, word_starts, text_starts) + inside
            else:
                by_class = class_log_probabilities(net, of, ids, np.arange(len(ids)), text_starts)
                model = token_log_probabilities(by_class, of_class[ids], word_starts, count, tokens[kind], distinct[kind])
            first = chunk.bounds[:-1] + np.arange(len(chunk.held))
            sums = lambda x, first=first: np.add.reduceat(x, first)
            yield record_batch(
                {
                    "doc_id": row["doc_id"],
                    "held_out": row["held"],
                    "n_tokens": np.diff(chunk.bounds).astype(np.int64) + 1,
                    "n_known": sums((count > 0).astype(np.int64)),
                    "train_tokens": np.full(len(chunk.held), total, dtype=np.int64),
                    "base_score": sums(base) / np.log(10),
                    "score": sums(model) / np.log(10),
                },
                _SCORES,
            )

    joined = chunks.join(by_chunk, "chunk", "left").select(
        "doc_id", "held", "bounds", "words", "hashes", "pieces", "piece_counts", "counts"
    )
    return joined.mapInArrow(run, _SCORES)


def lm_scores(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base and model scores of every text; those with ``held_out`` teach nothing."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    chunks = written(word_chunks(source), "lm-chunks")
    counts, firsts = subword_counts(chunks)
    classes = Classes.from_counts(counts, firsts)
    answers = written(word_counts(chunks, classes), "lm-counts")
    tokens, distinct = np.zeros((2, SINGLE_CLASSES + BAND_CLASSES), dtype=np.int64)
    for row in answers.filter("chunk is null").groupBy("class").agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).collect():
        tokens[row["class"]], distinct[row["class"]] = row["tokens"], row["distinct"]
    ends = int(firsts[END])
    tokens[classes.of[END]] += ends
    distinct[classes.of[END]] += ends > 0
    network = train(chunks, counts, classes)
    scored = score_chunks(chunks, answers, network, classes, tokens, distinct, ends, classes.log_shares(counts))
    return scored.withColumnRenamed("doc_id", doc_id)
