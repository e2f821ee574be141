"""Words of many texts as flat numpy arrays.

A word is a longest run of ``[^\\x20\\x09-\\x0D]``.  Texts are taken in blocks of
bounded size, so that the arrays of a task stay small whatever a partition holds;
one text is never cut.  NULL is read as an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

BLOCK_BYTES = 262_144
# Bytes hashed together; a longer word is hashed alone.
HASH_BYTES = 262_144
_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those of a very long word are not kept."""
    return _usual_powers() if size <= 2 * HASH_BYTES else _new_powers(size)


@lru_cache(maxsize=1)
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _new_powers(2 * HASH_BYTES)


def _new_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, dtype=np.uint64)
    down = np.full(size, _INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@dataclass
class Words:
    """``starts`` / ``ends`` are byte positions in ``raw``; ``doc`` numbers the text
    of each word; ``bounds[i]:bounds[i + 1]`` are the words of text ``i``."""

    texts: list[str]
    raw: np.ndarray
    text_starts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a byte-wise array over each text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        edges = np.append(self.text_starts, len(self.raw))
        return total[edges[1:]] - total[edges[:-1]]

    def hashes(self, lower: bool, first: int | None = None) -> np.ndarray:
        """64-bit hash of each word, or of its first bytes, A-Z in lower case if asked."""
        ends = self.ends if first is None else np.minimum(self.ends, self.starts + first)
        out = np.empty(len(self.starts), dtype=np.uint64)
        begin = 0
        while begin < len(self.starts):
            low = int(self.starts[begin])
            end = max(begin + 1, int(np.searchsorted(ends, low + HASH_BYTES, side="right")))
            part = self.raw[low : int(ends[end - 1])]
            up, down = _powers(len(part))
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODES[_LOWER[part] if lower else part] * up[: len(part)], out=total[1:])
            starts = self.starts[begin:end] - low
            out[begin:end] = (total[ends[begin:end] - low] - total[starts]) * down[starts]
            begin = end
        return mix(out)

    def bytes_of(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]].tobytes()


def split_words(texts: Sequence[str | None], bare: bool = False, fold: bool = True) -> Words:
    """Words of the texts.  ``bare`` words are in lower case and end at any ASCII
    character that is no letter or digit, so that case and punctuation don't count;
    without ``fold`` they keep their case."""
    plain = [(t.lower() if bare and fold else t) if t else "" for t in texts]
    parts = [t.encode("utf-8", "surrogatepass") for t in plain]
    raw = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    lengths = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    text_starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(parts) else np.zeros(0, np.int64)
    space = np.ones(len(raw) + 1, dtype=bool)
    space[1:] = (_NOT_WORD if bare else _SPACE)[raw]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[0::2], edges[1::2]
    bounds = np.append(np.searchsorted(starts, text_starts), len(starts)).astype(np.int64)
    doc = np.repeat(np.arange(len(parts)), np.diff(bounds))
    return Words(plain, raw, text_starts, starts, ends, doc, bounds)


def blocks(texts: Sequence[str | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` characters together, or of one text."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > begin and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)
