"""Substring dedup by relative Lempel-Ziv parsing against blocks of all documents.

Every document is reference text for the documents with larger ids.  The reference is dealt
into blocks by content: of the ``GRAM``-word runs of a window the one with the least hash is
the window's anchor, consecutive windows with one anchor form a segment, and a block holds
all segments of its anchors, each distinct one once.  Two equal windows have equal anchors,
so a segment needs to meet its own block only, and the work grows with the text and not with
documents times blocks.

A segment that stands in a smaller document as it is, by its 128-bit fingerprint, is one
factor.  The first occurrences of all other segments of an anchor are parsed greedily
against their block: at the cursor the block's index gives the smallest document with the
next ``least`` words; the match is extended word by word and the cursor jumps behind it; a
shorter match is a literal word.  A factor may hide a match that begins inside it, so every
window across a factor's end is looked up as well.  Factors and windows of smaller documents
become spans, and the words of the union of spans go.

Repeated passages are settled where they meet: a task sends the smallest document of each
distinct segment it has seen and settles the others itself, so a passage that a third of
all documents hold costs a row for each task's batch.  Anchors with very many distinct
segments (common phrases) are found beforehand by their counts; their windows are dealt by
the whole window instead.  That list steers the layout only and is bounded in length.

Defined results: NULL text or text without words has 0 words and keeps the empty text.
Documents without an id lose nothing and are nobody's reference.  Rows that share an id are
told apart by the checksum of their text, and are no reference for each other; equal rows get
equal results.  Texts of any length are read whole, in pieces with an overlap.  Empty tables
give no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.durable import written
from marquee.llm.bitmap import collect_bits, has, slot_of
from marquee.llm.frames import bounded_batches
from marquee.llm.words import blocks, mix, split_words

LEAST = 13
GRAM = 4
# An anchor with so many distinct segments, or more than this share of all, is dealt by whole windows.
HOT_SEGMENTS = 1_000
HOT_SHARE = 1 / 100_000
# Distinct segments of an anchor in one flush from which on it is counted at all.
HOT_IN_FLUSH = 32
# Segments a task holds before it settles them; words of a reference block (an anchor stays whole).
FLUSH_SEGMENTS = 400_000
BLOCK_WORDS = 400_000
PIECE_BYTES = 1_000_000
_ROWS_OUT = 100_000
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_ODD = np.uint64(0x9E3779B97F4A7C55)
_BACK = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_WINDOW_SALT = np.uint64(0xA0761D6478BD642F)


# ---- words, windows and segments


def pieces(data: bytes, size: int | None = None) -> Iterator[bytes]:
    """The text cut at white space into pieces of about ``size`` bytes; a word stays whole."""
    size = PIECE_BYTES if size is None else size
    begin = 0
    while len(data) - begin > size and (space := _SPACE.search(data, begin + size)):
        yield data[begin : space.start()]
        begin = space.start()
    yield data[begin:]


def word_hashes(texts: Sequence[bytes | None], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, place in the text, hash) of the words, in blocks.

    A piece of a long text begins with the last ``least - 1`` words of the one before."""
    cut: list[tuple[int, int, str]] = []
    for number, data in enumerate(texts):
        before, tail = 0, b""
        for piece in pieces(data or b""):
            if len(data or b"") <= PIECE_BYTES:
                cut.append((number, 0, piece.decode("utf-8", "surrogatepass")))
                break
            piece = tail + b" " + piece
            words = piece.split()
            cut.append((number, before, piece.decode("utf-8", "surrogatepass")))
            overlap = words[-(least - 1) :] if least > 1 else []
            before, tail = before + len(words) - len(overlap), b" ".join(overlap)
    for begin, end in blocks([p for _, _, p in cut]):
        part = cut[begin:end]
        words = split_words([p for _, _, p in part])
        number, before = np.array([x[0] for x in part]), np.array([x[1] for x in part])
        place = np.arange(len(words.doc)) - words.bounds[:-1][words.doc] + before[words.doc]
        # Pieces of one text are runs of their own.
        yield np.stack([number[words.doc], words.doc]), place, words.hashes(lower=False)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _ODD, dtype=np.uint64), np.full(size, _BACK, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Runs:
    """Fingerprints of runs of words."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        up, self.down = _powers(1 << max(16, n.bit_length()))
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * up[:n], out=self.total[1:])

    def of(self, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        return mix((self.total[to] - self.total[at]) * self.down[at] + (to - at).astype(np.uint64))


@dataclass
class Segments:
    """``key``: anchor, ``print_``: fingerprint, ``number``: text, words ``at`` to ``to``."""

    key: np.ndarray
    print_: np.ndarray
    number: np.ndarray
    at: np.ndarray
    to: np.ndarray

    @staticmethod
    def joined(parts: list[Segments]) -> Segments:
        names = ("key", "print_", "number", "at", "to")
        return Segments(*(np.concatenate([getattr(p, n) for p in parts]) if parts else np.zeros(0, np.int64) for n in names))


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values."""
    span, out = 1, values
    while 2 * span <= width:
        out, span = np.minimum(out[:-span], out[span:]), 2 * span
    return np.minimum(out[: len(values) - width + 1], out[width - span :]) if span < width else out


def segments(texts: Sequence[bytes | None], hot: np.ndarray, least: int = LEAST) -> Segments:
    """Segments of the texts; those of the sorted ``hot`` anchors are cut into single windows."""
    gram, out = min(GRAM, least), []
    for (number, run), place, hashes in word_hashes(texts, least):
        windows = len(hashes) - least + 1
        if windows <= 0:
            continue
        grams = hashes[: len(hashes) - gram + 1]
        for j in range(1, gram):
            grams = mix(grams * _ODD + hashes[j : len(hashes) - gram + 1 + j])
        anchor = _least_of(grams, least - gram + 1)
        inside = run[:windows] == run[least - 1 :]
        change = np.ones(windows, dtype=bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (run[1:windows] != run[: windows - 1])
        # Equal grams in a row would make segments of any length.
        first = np.maximum.accumulate(np.where(change, np.arange(windows), 0))
        change |= (np.arange(windows) - first) % (least - gram + 1) == 0
        common = np.isin(anchor, hot) if len(hot) else np.zeros(windows, dtype=bool)
        at = np.flatnonzero((change | common) & inside)
        ends = np.flatnonzero(np.append((change | common | ~inside)[1:], True))
        to = ends[np.searchsorted(ends, at)] + least
        prints = Runs(hashes)
        fingerprint = prints.of(at, to)
        key = np.where(common[at], mix(fingerprint ^ _WINDOW_SALT), anchor[at])
        out.append(Segments(key.view(np.int64), fingerprint.view(np.int64), number[at], place[at], place[at] + (to - at)))
    return Segments.joined(out)


# ---- settling segments


_OCCURRENCE = "key long, print long, doc long, row long, at long, to long"


def _out(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    for at in range(0, n, _ROWS_OUT):
        yield pa.RecordBatch.from_pydict({k: v[at : at + _ROWS_OUT] for k, v in columns.items()})


def _flushes(batches: Iterator[pa.RecordBatch], hot: np.ndarray, least: int) -> Iterator[tuple[Segments, np.ndarray, np.ndarray]]:
    """Segments of rows (doc, row, text) with their doc and row, many rows at once."""
    held: list[tuple[Segments, np.ndarray, np.ndarray]] = []
    size = 0

    def all_of(parts):
        return Segments.joined([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])

    for batch in batches:
        doc, row = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        found = segments(batch.column(2).to_pylist(), hot, least)
        held.append((found, doc[found.number], row[found.number]))
        size += len(found.key)
        if size >= FLUSH_SEGMENTS:
            yield all_of(held)
            held, size = [], 0
    if size:
        yield all_of(held)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a new group of equal rows begins, of sorted columns."""
    change = np.ones(len(columns[0]), dtype=bool)
    change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return change


def _merged(doc: np.ndarray, row: np.ndarray, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unions of spans that meet; both ends of a document's spans grow with their begin."""
    order = np.lexsort((at, row, doc))
    doc, row, at, to = doc[order], row[order], at[order], to[order]
    head = _heads(doc, row)
    head[1:] |= at[1:] > to[:-1]
    last = np.append(head[1:], True) if len(head) else head
    return doc[head], row[head], at[head], to[last]


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, row, data) of the documents."""
    data = F.col(text).cast("binary")
    return docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.coalesce(F.crc32(data), F.lit(-1)).cast("bigint").alias("row"), data.alias("data"))


def hot_anchors(rows: DataFrame, least: int = LEAST) -> np.ndarray:
    """Anchors with very many distinct segments, at most 1 / HOT_SHARE of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, _, _ in _flushes(batches, np.zeros(0, np.uint64), least):
            order = np.lexsort((found.print_, found.key))
            key = found.key[order][_heads(found.key[order], found.print_[order])]
            keys, counts = np.unique(key, return_counts=True)
            many = counts >= HOT_IN_FLUSH
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys[many], pa.int64()), "n": pa.array(counts[many], pa.int64())})
            yield pa.RecordBatch.from_pydict({"key": pa.array([None], pa.int64()), "n": pa.array([len(key)], pa.int64())})

    counts = rows.filter("doc is not null").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = written(counts, "anchors")
    total = counts.filter("key is null").first()
    floor = max(HOT_SEGMENTS, int((total.n if total else 0) * HOT_SHARE))
    found = counts.filter(F.col("key").isNotNull() & (F.col("n") > floor)).select("key").toArrow()
    return np.sort(found.column("key").to_numpy().astype(np.int64).view(np.uint64))


def _occurrences(rows: DataFrame, hot: np.ndarray, least: int) -> DataFrame:
    """Rows to be settled by key, and settled spans (print NULL) under a key of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, doc, row in _flushes(batches, hot, least):
            order = np.lexsort((doc, found.print_, found.key))
            key, print_, doc, row, at, to = (x[order] for x in (found.key, found.print_, doc, row, found.at, found.to))
            head = _heads(key, print_)
            smallest = doc[head][np.cumsum(head) - 1]
            still = doc == smallest
            yield from _out({"key": key[still], "print": print_[still], "doc": doc[still], "row": row[still], "at": at[still], "to": to[still]})
            done = ~still
            doc, row, at, to = _merged(doc[done], row[done], at[done], to[done])
            spread = mix((doc * 31 + at).astype(np.uint64)).view(np.int64)
            yield from _out({"key": spread, "print": pa.nulls(len(doc), pa.int64()), "doc": doc, "row": row, "at": at, "to": to})

    return rows.filter("doc is not null").mapInArrow(run, _OCCURRENCE)


def _settled(occurrences: DataFrame) -> DataFrame:
    """(key, doc, row, at, to, whole): spans that stand in a smaller document as they are
    (``whole``), and first occurrences of segments whose anchor has other segments."""
    same = Window.partitionBy("key", "print").orderBy("doc", "row", "at")
    anchor = Window.partitionBy("key").orderBy("print").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = occurrences.repartition("key").withColumn("first", F.first("doc").over(same))
    dealt = dealt.withColumns(
        {
            "mixed": F.min("print").over(anchor) != F.max("print").over(anchor),
            "shared": F.min("doc").over(anchor) < F.max("doc").over(anchor),
        }
    )
    whole = F.col("print").isNull() | (F.col("first") < F.col("doc"))
    return dealt.withColumn("whole", whole).filter("whole or (mixed and shared)").select("key", "doc", "row", "at", "to", "whole")


# ---- parsing against blocks


def factors(words: np.ndarray, bounds: np.ndarray, doc: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, at, to) of the spans of a block that stand in a smaller document.

    Segment ``i`` is ``words[bounds[i]:bounds[i + 1]]`` of document ``doc[i]``; ``doc`` is
    sorted.  All segments are parsed side by side, a factor or literal each step."""
    n = len(words)
    segment = np.repeat(np.arange(len(doc)), np.diff(bounds))
    end = bounds[1:][segment]
    starts = np.flatnonzero(np.arange(n) + least <= end)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    prints = Runs(words).of(starts, starts + least)
    # The index: the first place of each run of least words, that is, its smallest document.
    _, first, which = np.unique(prints, return_index=True, return_inverse=True)
    source = np.full(n, -1)
    origin = starts[first[which]]
    equal = np.ones(len(starts), dtype=bool)
    for j in range(least):
        equal[equal] = words[origin[equal] + j] == words[starts[equal] + j]
    source[starts] = np.where(equal, origin, -1)

    def found(at: np.ndarray) -> np.ndarray:
        return (source[at] >= 0) & (doc[segment[np.maximum(source[at], 0)]] < doc[segment[at]])

    spans = []
    cursor = bounds[:-1][np.diff(bounds) >= least]
    while len(cursor):
        match = found(cursor)
        begin = cursor[match]
        origin = source[begin]
        length = np.full(len(begin), least)
        more = np.ones(len(begin), dtype=bool)
        while more.any():
            a, b = begin + length, origin + length
            more &= (a < end[begin]) & (b < end[origin])
            more[more] = words[a[more]] == words[b[more]]
            length += more
        spans.append((begin, begin + length))
        # Windows across the factor's end.
        across = (begin + length)[:, None] - np.arange(1, least)[None, :]
        across = across[(across > begin[:, None]) & (across + least <= end[begin][:, None])]
        across = across[found(across)]
        spans.append((across, across + least))
        step = np.ones(len(cursor), dtype=np.int64)
        step[match] = length
        cursor = cursor + step
        cursor = cursor[cursor < n]
        cursor = cursor[cursor + least <= end[cursor]] if len(cursor) else cursor
    at, to = (np.concatenate(x) for x in zip(*spans, strict=True))
    return segment[at], at - bounds[:-1][segment[at]], to - bounds[:-1][segment[at]]


def _touched(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose document may be among the keys' documents; a join drops the rest."""
    bits = collect_bits(keys.select(slot_of(F.col("doc")).alias("slot")), F.col("slot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = has(bits, batch.column(3).to_numpy())
            yield batch.filter(pa.array(keep)).select(["doc", "row", "data"])

    return rows.filter("doc is not null").withColumn("slot", slot_of(F.col("doc"))).mapInArrow(run, rows.schema)


def _contents(rows: DataFrame, open_segments: DataFrame, least: int) -> DataFrame:
    """(key, doc, row, at, words): the open segments with the hashes of their words."""
    wanted = open_segments.groupBy("doc", "row").agg(F.collect_list(F.struct("key", "at", "to")).alias("wanted"))
    both = _touched(rows, open_segments).join(wanted, ["doc", "row"]).select("doc", "row", "data", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in range(0, batch.num_rows, 64):
                part = batch.slice(one, 64)
                parts: list[list[np.ndarray]] = [[] for _ in range(part.num_rows)]
                ahead = [0] * part.num_rows
                for (number, run_), place, hashes in word_hashes(part.column(2).to_pylist(), least):
                    heads = np.flatnonzero(_heads(number, run_)) if len(number) else np.zeros(0, np.int64)
                    for a, b in zip(heads, [*heads[1:], len(number)], strict=True):
                        i = number[a]
                        parts[i].append(hashes[a + ahead[i] - place[a] : b])
                        ahead[i] = place[b - 1] + 1
                out: dict[str, list] = {"key": [], "doc": [], "row": [], "at": [], "words": []}
                for i, (doc, row, wanted_) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(3).to_pylist(), strict=True)):
                    words = np.concatenate(parts[i]) if parts[i] else np.zeros(0, np.uint64)
                    for w in wanted_:
                        for name, value in zip(out, (w["key"], doc, row, w["at"], words[w["at"] : w["to"]].tobytes()), strict=True):
                            out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, pa.schema([(k, pa.int64()) for k in ("key", "doc", "row", "at")] + [("words", pa.binary())]))

    return both.mapInArrow(run, "key long, doc long, row long, at long, words binary")


def _parsed(contents: DataFrame, least: int) -> DataFrame:
    """Spans (doc, row, at, to) that parsing finds."""

    def block(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows.sort(key=lambda r: r[1])
        doc, row, at = (np.array([r[i] for r in rows], dtype=np.int64) for i in (1, 2, 3))
        words = np.frombuffer(b"".join(r[4] for r in rows), dtype=np.uint64)
        bounds = np.concatenate([[0], np.cumsum([len(r[4]) // 8 for r in rows])]).astype(np.int64)
        segment, begin, end = factors(words, bounds, doc, least)
        yield from _out({"doc": doc[segment], "row": row[segment], "at": at[segment] + begin, "to": at[segment] + end})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BLOCK_WORDS and row[0] != held[-1][0]:
                    yield from block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4]) // 8
        if held:
            yield from block(held)

    return contents.repartition("key").sortWithinPartitions("key").mapInArrow(run, "doc long, row long, at long, to long")


def duplicate_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(doc, row, at, to): words ``at`` to ``to`` (exclusive) of a document in runs of ``least``
    words and more that a document with a smaller id holds too.  ``row`` is the checksum of the text."""
    bounded_batches(docs.sparkSession)
    rows = _rows(docs, doc_id, text)
    settled = written(_settled(_occurrences(rows, hot_anchors(rows, least), least)), "segments")
    found = _parsed(_contents(rows, settled.filter("not whole"), least), least)
    return settled.filter("whole").select("doc", "row", "at", "to").unionByName(found)


# ---- removal


def _without(data: bytes, spans: list[dict] | None) -> tuple[int, int, bytes]:
    """(words, words removed, kept words joined by one space)."""
    size = max((s["to"] for s in spans or ()), default=0)
    steps = np.zeros(size + 1, dtype=np.int64)
    for s in spans or ():
        steps[s["at"]] += 1
        steps[s["to"]] -= 1
    gone = np.cumsum(steps)[:size] > 0
    total, kept = 0, []
    for piece in pieces(data):
        words = piece.split()
        here = gone[total : total + len(words)]
        total += len(words)
        if here.any():
            words = [w for w, out in zip(words, here, strict=False) if not out] + words[len(here) :]
        if words:
            kept.append(b" ".join(words))
    return total, int(gone.sum()), b" ".join(kept)


def remove_spans(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; only texts with spans are shuffled."""
    spans = written(spans.groupBy("doc", "row").agg(F.collect_list(F.struct("at", "to")).alias("spans")), "spans")
    bits = collect_bits(spans.select(slot_of(F.col("doc")).alias("slot")), F.col("slot"))
    rows = _rows(docs, doc_id, text).withColumn("slot", F.when(F.col("doc").isNotNull(), slot_of(F.col("doc"))))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("doc", "row", "n_words", "n_removed")] + [T.StructField("data", T.BinaryType())])

    def batch_of(doc: pa.Array, row: pa.Array, results: list[tuple]) -> pa.RecordBatch:
        n_words, n_removed, data = zip(*results, strict=True) if results else ((), (), ())
        arrays = [doc, row, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(data, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column(3)
            touched = ~slots.is_null().to_numpy(zero_copy_only=False) & has(bits, slots.fill_null(0).to_numpy(zero_copy_only=False))
            results = [(None, None, d) if t else _without(d or b"", None) for t, d in zip(touched, batch.column(2).to_pylist(), strict=True)]
            yield batch_of(batch.column(0), batch.column(1), results)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2, 6)]
            results = [(n, r, d) if n is not None else _without(d or b"", s) for n, r, d, s in zip(*columns, strict=True)]
            yield batch_of(batch.column(0), batch.column(1), results)

    alone = rows.filter("doc is null").mapInArrow(untouched, schema)
    named = rows.filter("doc is not null").mapInArrow(untouched, schema)
    joined = named.join(spans, ["doc", "row"], "left").select("doc", "row", "n_words", "n_removed", "data", "spans")
    done = joined.mapInArrow(rest, schema).unionByName(alone)
    return done.select(F.col("doc").alias(doc_id), "n_words", "n_removed", F.col("data").cast("string").alias("kept"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Every document without the runs of ``least`` words and more that a smaller id holds."""
    return remove_spans(docs, duplicate_spans(docs, doc_id, text, least), doc_id, text)
