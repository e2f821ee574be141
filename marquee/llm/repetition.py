"""Quality rules on repetition inside a text, by suffix arrays.

The suffixes of all texts of a block are sorted together by prefix doubling; two
suffixes of different texts never compare equal, so each text gets its own suffix
array.  Longest-common-prefix intervals give the maximal repeated substrings; the
union of their spans and the longest of them decide.

Defined results: NULL or a text without words has all counts 0 and fails the base
rule (fewer than ``min_words`` words); equal rows get equal results; extra columns
stay as they are unless they have the name of a result column, which the result
replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.frames import map_text
from marquee.llm.words import Words, blocks, split_words

MIN_WORDS = 50
MAX_REPEAT_WORDS_PCT = 50
MIN_REPEAT = 8
MAX_COVERED_PCT = 30
MAX_LONGEST = 100
_SYMBOLS = np.zeros(256, dtype=np.int8)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = 1
_SPACES = " \t\n\r\x0b\x0c"

FIELDS = T.StructType(
    [
        T.StructField(n, T.LongType())
        for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat")
    ]
)


def _dense(keys: np.ndarray) -> np.ndarray:
    """Ranks 0.. of the values; equal values share a rank."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    rank = np.empty(len(keys), dtype=np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) if len(keys) else 0
    return rank


def window_levels(words: Words, ids: np.ndarray) -> list[np.ndarray]:
    """``levels[k][i]``: rank, among all suffixes, of the ``2**k`` words at ``i``.

    A window that passes the end of its text is its own class.  Once a rank is
    unique it stays so and is not sorted again; doubling ends when all are unique.
    """
    n = len(ids)
    last = words.bounds[1:][words.doc] if n else np.zeros(0, np.int64)
    rank = _dense(words.doc.astype(np.int64) * (ids.max(initial=0) + 1) + ids)
    levels, width = [rank], 1
    while True:
        active = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1) if n else np.zeros(0, np.int64)
        if not len(active):
            return levels
        follow = active + width
        inside = follow < last[active]
        second = np.where(inside, rank[np.minimum(follow, n - 1)] + 1, 0)
        # Classes are renumbered by the place of their first member, so ranks of untouched suffixes keep their order.
        order = np.lexsort((second, rank[active]))
        first, after = rank[active][order], second[order]
        new_class = np.concatenate([[True], first[1:] != first[:-1]])
        new_rank = np.concatenate([[True], (first[1:] != first[:-1]) | (after[1:] != after[:-1])])
        place = np.arange(len(order))
        class_start = np.maximum.accumulate(np.where(new_class, place, 0))
        rank_start = np.maximum.accumulate(np.where(new_rank, place, 0))
        updated = _places(rank) if width == 1 else rank.copy()
        base = updated[active][order]
        updated[active[order]] = base + (rank_start - class_start)
        rank = updated
        levels.append(rank)
        width *= 2


def _places(rank: np.ndarray) -> np.ndarray:
    """Rank as the number of suffixes in smaller classes, leaving room to split a class."""
    counts = np.bincount(rank)
    return (np.cumsum(counts) - counts)[rank]


def longest_repeats(words: Words, levels: list[np.ndarray]) -> np.ndarray:
    """For each word the length in words of the longest substring that starts there
    and occurs elsewhere in its text: the larger common prefix with its two
    neighbours in the suffix array."""
    n = len(levels[0])
    best = np.zeros(n, dtype=np.int64)
    if n < 2:
        return best
    suffixes = np.argsort(levels[-1], kind="stable")
    a, b = suffixes[:-1], suffixes[1:]
    tied = levels[0][a] == levels[0][b]
    a, b = a[tied], b[tied]
    common = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        ok = (i < n) & (j < n)
        i, j = np.minimum(i, n - 1), np.minimum(j, n - 1)
        same = ok & (i != j) & (levels[k][i] == levels[k][j]) & (words.doc[i] == words.doc[a]) & (words.doc[j] == words.doc[b])
        common += np.where(same, 1 << k, 0)
    np.maximum.at(best, a, common)
    np.maximum.at(best, b, common)
    return best


def _covered(words: Words, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Number of words of each text inside the union of the given spans."""
    steps = np.zeros(len(words.doc) + 1, dtype=np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, begin + length, -1)
    inside = np.cumsum(steps[:-1]) > 0
    return np.bincount(words.doc[inside], minlength=len(words.texts))


def _dup_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def measure(texts: list[str | None], min_repeat: int) -> dict[str, np.ndarray]:
    words = split_words(texts)
    ids = _dense(words.hashes(lower=False))
    levels = window_levels(words, ids)
    best = longest_repeats(words, levels)
    triple = np.flatnonzero(best >= 3)
    long = np.flatnonzero(best >= min_repeat)
    longest = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(longest, words.doc, best)
    not_space = ~np.isin(words.raw, [0x20, *range(0x09, 0x0E)])
    return {
        "n_words": words.counts,
        "word_chars": words.per_text(not_space & ((words.raw & 0xC0) != 0x80)),
        "n_symbols": words.per_text(_SYMBOLS[words.raw]),
        "n_dup_lines": np.array([_dup_lines(t) for t in words.texts], dtype=np.int64),
        "n_repeat_words": _covered(words, triple, np.full(len(triple), 3)),
        "n_covered_words": _covered(words, long, best[long]),
        "longest_repeat": longest,
    }


def repetition_counts(docs: DataFrame, text: str = "text", min_repeat: int = MIN_REPEAT) -> DataFrame:
    """``docs`` with the counts of ``FIELDS``."""

    def of(batches: Iterator[pa.Array]) -> Iterator[dict[str, np.ndarray]]:
        for column in batches:
            values = column.to_pylist()
            for begin, end in blocks(values):
                yield measure(values[begin:end], min_repeat)

    return map_text(docs, text, FIELDS, of)


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_words_pct: int = MAX_REPEAT_WORDS_PCT,
    min_repeat: int = MIN_REPEAT,
    max_covered_pct: int = MAX_COVERED_PCT,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``.

    ``kept``: the base rule holds, the union of repeats of ``min_repeat`` words and
    more covers at most ``max_covered_pct`` of the words, and no repeat is longer
    than ``max_longest`` words.
    """
    counted = repetition_counts(docs, text, min_repeat)
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_words_pct * F.col("n_words"))
    repeats = (100 * F.col("n_covered_words") <= max_covered_pct * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)
    return counted.withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & repeats)
