"""Byte-level BPE encoding and decoding with a pair occurrence index.

Texts are cut into pieces by the tokenizer's pattern.  The distinct new pieces of
a stretch of a partition are laid out as one linked list of symbols, and an index
maps the rank of each adjacent pair to all positions where it stands.  Ranks are
applied in ascending order: all positions of a rank merge at once, and the pairs
beside them enter the lists of their own ranks.

The vocabulary is a file of a public tokenizer (a path or a name known to the
``public_tokenizers`` package); it is read by each Python worker from its own
installation and never travels with the job.

Defined results: NULL and empty texts have no ids, and decode to the empty text;
equal texts get equal ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.llm.frames import map_text
from marquee.llm.words import blocks

VOCABULARY = "byte_bpe_50k.json"
# Bounds of memory only: distinct pieces remembered, and characters of new pieces per index.
REMEMBERED_PIECES = 150_000
INDEX_CHARS = 1_000_000

# Fixed value: the pattern of byte-level BPE, with the white space class spelt out.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    r"| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value in a byte-level vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Bpe:
    """A vocabulary with its merges as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        value = {c: b for b, c in enumerate(symbols)}
        self.byte_ids = np.array([vocab[c] for c in symbols], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes: dict[int, bytes] = {i: bytes(value[c] for c in token) for token, i in vocab.items()}
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.left, self.right = left, right
        self.width = 1 + max(*vocab.values(), *self.special.values())
        keys = left * self.width + right
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]
        self.pieces = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], -1)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece (each at least one byte), by one pair occurrence index."""
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        n = len(raw)
        symbol = self.byte_ids[raw]
        ends = np.cumsum([len(p) for p in pieces])
        after = np.arange(1, n + 1)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1)
        before[np.concatenate([[0], ends[:-1]])] = -1
        alive = np.ones(n, dtype=bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            rank = self.ranks(symbol[at], symbol[after[at]])
            known = rank >= 0
            at, rank = at[known], rank[known]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, places in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(places)

        enter(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            at = np.unique(np.concatenate(index.pop(r)))
            at = at[alive[at]]
            at = at[after[at] >= 0]
            at = at[(symbol[at] == self.left[r]) & (symbol[after[at]] == self.right[r])]
            if self.left[r] == self.right[r] and len(at) > 1:
                # Of a run of overlapping places every second one merges, from the left.
                goes_on = np.concatenate([[False], after[at[:-1]] == at[1:]])
                place = np.arange(len(at))
                start = np.maximum.accumulate(np.where(goes_on, 0, place))
                at = at[(place - start) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = self.merged[r]
            alive[gone] = False
            after[at] = after[gone]
            has_next = after[at] >= 0
            before[after[at[has_next]]] = at[has_next]
            left = before[at]
            enter(np.concatenate([left[left >= 0], at[has_next]]))
        kept = np.flatnonzero(alive)
        return np.split(symbol[kept].astype("<u4"), np.searchsorted(kept, ends[:-1]))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def cut(self, text: str) -> list[str]:
        """Pieces of a text; a special token's string is a piece of its own."""
        if self.specials is None or not self.specials.search(text):
            return self.pieces.findall(text)
        found, at = [], 0
        for match in self.specials.finditer(text):
            found += self.pieces.findall(text[at : match.start()])
            found.append(match.group())
            at = match.end()
        return found + self.pieces.findall(text[at:])


class Encoder:
    """Encodes texts, remembering the ids of a bounded number of pieces."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.known: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.known = {t: np.array([i], dtype="<u4").tobytes() for t, i in self.bpe.special.items()}

    def _learn(self, pieces: list[str]) -> None:
        begin = size = 0
        for i, piece in enumerate([*pieces, ""]):
            if i == len(pieces) or size > INDEX_CHARS:
                part = pieces[begin:i]
                if part:
                    ids = self.bpe.encode_pieces([p.encode("utf-8", "surrogatepass") for p in part])
                    self.known.update(zip(part, (x.tobytes() for x in ids), strict=True))
                begin, size = i, 0
            size += len(piece)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.bpe.cut(t) for t in texts]
        if len(self.known) > REMEMBERED_PIECES:
            self._forget()
        new = {p for pieces in cut for p in pieces if p not in self.known}
        self._learn(sorted(new))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]


@lru_cache(maxsize=2)
def load(vocabulary: str) -> Bpe:
    if os.path.isabs(vocabulary):
        return Bpe(vocabulary)
    import public_tokenizers

    return Bpe(public_tokenizers.path(vocabulary))


def _encoded(vocabulary: str, batches: Iterator[pa.Array], limit: int = 4_000_000) -> Iterator[tuple[Bpe, list[bytes]]]:
    bpe = load(vocabulary)
    encoder = Encoder(bpe)
    for column in batches:
        values = [v or "" for v in column.to_pylist()]
        for begin, end in blocks(values, limit):
            yield bpe, encoder(values[begin:end])


def _id_lists(encoded: list[bytes]) -> pa.Array:
    flat = np.frombuffer(b"".join(encoded), dtype="<u4").astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(e) // 4 for e in encoded])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(flat))


def bpe_encode(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, ids: str = "ids", digests: bool = False) -> DataFrame:
    """``docs`` with the ids of each text as an array of integers, and with the
    ``DIGESTS`` of the round trip if asked."""
    added = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType())), *(DIGESTS.fields if digests else [])])

    def of(batches: Iterator[pa.Array]) -> Iterator[dict]:
        for bpe, encoded in _encoded(vocabulary, batches):
            yield {ids: _id_lists(encoded)} | (_digests(bpe, encoded) if digests else {})

    return map_text(docs, text, added, of)


def bpe_decode(encoded: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY, decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each array of ids; bytes that are no UTF-8 become U+FFFD."""
    added = T.StructType([T.StructField(decoded, T.StringType())])

    def of(batches: Iterator[pa.Array]) -> Iterator[dict]:
        bpe = load(vocabulary)
        for column in batches:
            yield {decoded: [bpe.decode(np.array(v, dtype=np.int64)) if v else "" for v in column.to_pylist()]}

    return map_text(encoded, ids, added, of)


DIGESTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def _digests(bpe: Bpe, encoded: list[bytes]) -> dict:
    return {
        "n_tokens": np.array([len(e) // 4 for e in encoded], dtype=np.int64),
        "ids_sha256": [hashlib.sha256(e).hexdigest() for e in encoded],
        "decoded_sha256": [hashlib.sha256(bpe.decode(np.frombuffer(e, dtype="<u4")).encode()).hexdigest() for e in encoded],
    }


def round_trip_digests(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, keep: list[str] | None = None) -> DataFrame:
    """Token count and digests of the ids and of the text decoded from them, without shipping either."""

    def of(batches: Iterator[pa.Array]) -> Iterator[dict]:
        for bpe, encoded in _encoded(vocabulary, batches):
            yield _digests(bpe, encoded)

    return map_text(docs, text, DIGESTS, of, keep)
