"""Repair of conversation structure by least-cost edits, decided by one integer a state.

The turns of a conversation are kept (0), given the role user or assistant (1), deleted
(2; turns without text and repetitions must be) or preceded by an inserted empty turn (5),
so that the first letters of the roles read ``(s?(ua)+)?``; a truncated turn that stays
costs 5 more.  The value of a state of the edit graph is a single integer: its high digits
are the cost, its low digits, ``DIGIT`` bits each in a field of fixed width, the letters of
the edits to come (D, I, K, R in ASCII order) with zeros behind the last one.  The least
integer is the least cost and, among equal costs, the ASCII-least audit.

A conversation of any length is cut into chunks of bounded size.  Rows are sorted by
(conversation, turn, role, digest of the text) over range partitions, so that a long
conversation spreads over tasks; a chunk yields the least integer for each pair of states
before and after it.  Inserted turns count to the row behind them, so no audit of a chunk is
a proper prefix of another one, and chunks are chained with one integer again: cost, rank of
the edits before, rank of the chunk's edits.  Conversations that lie inside a partition and a
chunk are decided where they stand; only the others are chained by key.

Defined results: NULL roles and texts count as one space; NULL turns come first; rows of
one turn are taken by role, then by digest of the text; equal rows are repetitions of the
first one.  A NULL conversation id is a conversation.  Conversations without rows are
none.  Empty tables give empty results.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.durable import written
from marquee.llm.frames import bounded_batches, record_batch

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
CHUNK_ROWS = 256
CHUNK_CHARS = 1_000_000
DIGIT = 3
_CODES = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTERS = {v: k for k, v in _CODES.items()}
_SPACES = " \t\n\x0b\x0c\r"

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
_AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
# The one turn that may be put in by role, and the state it leads to.
_NEXT = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
_ENDS = (0, 3)
_CLOSING = ("", "II", "I", "")
_LEGAL = {"su", "ua", "au"}


# ---- one chunk


@dataclass
class Chunk:
    """``marks`` has one letter for each row: b(lank), d(uplicate), t(runcated) or a dot."""

    initials: list[str] = field(default_factory=list)
    marks: list[str] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    chars: int = 0

    def add(self, initial: str, mark: str, role: str, text: str) -> None:
        kept = mark not in "bd"
        self.initials.append(initial)
        self.marks.append(mark)
        self.roles.append(role if kept else "")
        self.texts.append(text if kept else "")
        self.chars += len(text) if kept else 0

    @property
    def full(self) -> bool:
        return len(self.marks) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS


class Weights:
    """Integers of cost and letters for audits of up to ``width`` letters."""

    def __init__(self, width: int):
        self.bits = DIGIT * width
        self.low = (1 << self.bits) - 1
        self.top = {k: v << (self.bits - DIGIT) for k, v in _CODES.items()}

    def before(self, value: int, cost: int, letter: str) -> int:
        """The value with one more edit in front of its letters."""
        return ((value >> self.bits) + cost << self.bits) + self.top[letter] + ((value & self.low) >> DIGIT)

    def audit(self, value: int) -> str:
        out, at = [], self.bits - DIGIT
        while at >= 0 and (code := (value >> at) & ((1 << DIGIT) - 1)):
            out.append(_LETTERS[code])
            at -= DIGIT
        return "".join(out)

    def cost(self, value: int) -> int:
        return value >> self.bits


def _insertions(values: list[int | None], weights: Weights) -> list[int | None]:
    """Values of the states when turns may be inserted first."""
    changed = True
    while changed:
        changed = False
        for q, (_, after) in enumerate(_NEXT):
            if values[after] is not None:
                value = weights.before(values[after], INSERT, "I")
                if values[q] is None or value < values[q]:
                    values[q], changed = value, True
    return values


def least_edits(initials: list[str], marks: list[str], weights: Weights, ends: list[int | None]) -> list[int | None]:
    """The least integer from each state before the rows to the ends given behind them."""
    values = list(ends)
    for initial, mark in zip(reversed(initials), reversed(marks), strict=True):
        now: list[int | None] = []
        more = TRUNCATED if mark == "t" else 0
        for q in range(4):
            options = [weights.before(values[q], DELETE, "D")] if values[q] is not None else []
            if mark not in "bd":
                kept, renamed = _AFTER[q].get(initial), _NEXT[q][1]
                if kept is not None and values[kept] is not None:
                    options.append(weights.before(values[kept], KEEP + more, "K"))
                if values[renamed] is not None:
                    options.append(weights.before(values[renamed], REROLE + more, "R"))
            now.append(min(options, default=None))
        values = _insertions(now, weights)
    return values


def _width(rows: int) -> int:
    # Up to three turns in a row can be inserted before a row, and two behind the last one.
    return 4 * rows + 2


def whole_audit(initials: list[str], marks: list[str]) -> tuple[int, str]:
    """(cost, audit) of a conversation."""
    weights = Weights(_width(len(marks)))
    ends = _insertions([0 if q in _ENDS else None for q in range(4)], weights)
    value = least_edits(initials, marks, weights, ends)[0]
    return weights.cost(value), weights.audit(value)


def chunk_audits(initials: list[str], marks: list[str]) -> list[list[tuple[int, str] | None]]:
    """(cost, audit) of a chunk for each state before and after it."""
    weights = Weights(_width(len(marks)))
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    for after in range(4):
        values = least_edits(initials, marks, weights, [0 if q == after else None for q in range(4)])
        for before, value in enumerate(values):
            if value is not None:
                table[before][after] = weights.cost(value), weights.audit(value)
    return table


def edited(state: int, audit: str, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """The turns (role, text) that an audit leaves of a chunk's rows."""
    row = 0
    for letter in audit:
        role, text = _NEXT[state][0], ""
        if letter != "I":
            role, text = roles[row] if letter == "K" else role, texts[row]
            row += 1
        if letter == "K":
            state = _AFTER[state][role[:1]]
        elif letter != "D":
            state = _NEXT[state][1]
        if letter != "D":
            yield role, text


# ---- rows to chunks


def _prepared(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(_conv, _turn, _role, _text, _digest, _mark): the mark is blank, truncated or a dot."""
    plain = turns.select(
        F.col(conv_id).alias("_conv"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("_role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("_text"),
    )
    trimmed = F.rtrim("_text", F.lit(_SPACES))
    mark = F.when(trimmed == "", "b").when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), ".").otherwise("t")
    return plain.withColumn("_digest", F.unhex(F.md5(F.col("_text").cast("binary")))).withColumn("_mark", mark)


_KEY = ["_conv", "_turn", "_role", "_digest"]


def _repetitions(prepared: DataFrame) -> DataFrame:
    """(key, _copies, _seen) of rows that stand several times, or earlier in their conversation."""
    copies = prepared.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_copies"))
    copies = written(copies, "turns")
    # NULL turns come first: the least of (is not null, turn).
    order = F.struct(F.col("_turn").isNotNull().alias("given"), F.col("_turn").alias("at"))
    firsts = copies.groupBy("_conv", "_role", "_digest").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    left, right = copies.alias("l"), firsts.alias("r")
    same = F.col("l._conv").eqNullSafe(F.col("r._conv")) & (F.col("l._role") == F.col("r._role")) & (F.col("l._digest") == F.col("r._digest"))
    at = F.struct(F.col("l._turn").isNotNull().alias("given"), F.col("l._turn").alias("at"))
    seen = F.col("r._first").isNotNull() & ~at.eqNullSafe(F.col("r._first"))
    return left.join(right, same, "left").select("l.*", seen.alias("_seen")).filter("_copies > 1 or _seen")


def _without_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of equal rows of a batch one travels on."""
    for batch in batches:
        keys = pa.Table.from_batches([batch]).select(_KEY).to_pandas()
        yield batch.filter(pa.array(~keys.duplicated().to_numpy()))


def _chunk_schema(conv: T.DataType) -> T.StructType:
    texts, names = T.ArrayType(T.StringType()), ("blank", "duplicate", "truncated", "illegal")
    return T.StructType(
        [T.StructField("_conv", conv), T.StructField("chunk", T.LongType()), T.StructField("whole", T.BooleanType())]
        + [T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", texts)]
        + [T.StructField(n, T.LongType()) for n in names]
        + [T.StructField("first", T.StringType()), T.StructField("last", T.StringType())]
        + [T.StructField("roles", texts), T.StructField("texts", texts)]
    )


def _chunk_row(conv: object, number: int, chunk: Chunk, whole: bool) -> dict:
    if whole:
        cost, audit = whole_audit(chunk.initials, chunk.marks)
        costs, audits = [cost], [audit]
    else:
        cells = [cell for line in chunk_audits(chunk.initials, chunk.marks) for cell in line]
        costs, audits = [c[0] if c else None for c in cells], [c[1] if c else None for c in cells]
    initials = chunk.initials
    return {
        "_conv": conv,
        "chunk": number,
        "whole": whole,
        "costs": costs,
        "audits": audits,
        "blank": chunk.marks.count("b"),
        "duplicate": chunk.marks.count("d"),
        "truncated": chunk.marks.count("t"),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "first": initials[0],
        "last": initials[-1],
        "roles": chunk.roles,
        "texts": chunk.texts,
    }


def _columns(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    return record_batch({f.name: [r[f.name] for r in rows] for f in schema}, schema)


def _rows(batches: Iterator[pa.RecordBatch], at_once: int = 256) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, at_once):
            yield from batch.slice(at, at_once).to_pylist()


def _grouped(rows: Iterator[dict], schema: T.StructType, chars: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Rows to record batches of bounded size."""
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(t or "") for v in row.values() if isinstance(v, (list, str)) for t in ([v] if isinstance(v, str) else v) if not isinstance(t, int))
        if size > chars:
            yield _columns(held, schema)
            held, size = [], 0
    yield _columns(held, schema)


def _chunks(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    prepared = _prepared(turns, conv_id, turn, role, text)
    single = prepared.mapInArrow(_without_copies, prepared.schema)
    marks = _repetitions(prepared.select(*_KEY))
    both = single.unionByName(marks, allowMissingColumns=True)
    ordered = both.repartitionByRange(*[F.col(c).asc_nulls_first() for c in _KEY])
    ordered = ordered.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in _KEY], F.col("_copies").desc_nulls_last())
    schema = _chunk_schema(prepared.schema["_conv"].dataType)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, str, str, str]]:
        """(conversation, initial, mark, role, text), copies written out."""
        key, copies, seen = None, 1, False
        for row in _rows(batches):
            now = tuple(row[c] for c in _KEY)
            if row["_copies"] is not None:
                key, copies, seen, done = now, row["_copies"], row["_seen"], False
                continue
            if now != key:
                key, copies, seen, done = now, 1, False, False
            if done:
                continue
            done = True
            initial, blank = row["_role"][:1], row["_mark"] == "b"
            yield now[0], initial, "d" if seen and not blank else row["_mark"], row["_role"], row["_text"]
            for _ in range(copies - 1):
                yield now[0], initial, "b" if blank else "d", "", ""

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """A conversation in one chunk that is neither the first nor the last of the partition is whole."""
        number = TaskContext.get().partitionId() << 32
        conv, chunk, first, cut = None, Chunk(), True, False
        for entry in entries(batches):
            if chunk.marks and (entry[0] != conv or chunk.full):
                ends = entry[0] != conv
                yield _chunk_row(conv, number, chunk, whole=ends and not first and not cut)
                number, chunk, cut = number + 1, Chunk(), not ends
                first = first and not ends
            conv = entry[0]
            chunk.add(*entry[1:])
        if chunk.marks:
            yield _chunk_row(conv, number, chunk, whole=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _grouped(chunked(batches), schema)

    return ordered.mapInArrow(run, schema)


# ---- chunks to conversations


@dataclass
class _Path:
    """Edits of the chunks so far: the chunk's own, and the path before it."""

    before: _Path | None
    state: int
    chunk: int
    audit: str


class Chain:
    """Chains the chunks of one conversation in order."""

    def __init__(self):
        self.now: list[tuple[int, int, _Path | None] | None] = [(0, 0, None), None, None, None]
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.last: str | None = None

    def add(self, row: dict) -> None:
        for name in self.counts:
            self.counts[name] += row[name]
        if self.last is not None:
            self.counts["illegal"] += self.last + row["first"] not in _LEGAL
        self.last = row["last"]
        rank = {a: i for i, a in enumerate(sorted({a for a in row["audits"] if a is not None}))}
        winners: list[tuple[int, int, int] | None] = []
        for after in range(4):
            options = [
                (self.now[q][0] + row["costs"][4 * q + after] << 16 | self.now[q][1] << 8 | rank[row["audits"][4 * q + after]], q)
                for q in range(4)
                if self.now[q] is not None and row["costs"][4 * q + after] is not None
            ]
            winners.append(min(options, default=None))
        order = {r: i for i, r in enumerate(sorted({w[0] & 0xFFFF for w in winners if w}))}
        self.now = [
            w and (w[0] >> 16, order[w[0] & 0xFFFF], _Path(self.now[w[1]][2], w[1], row["chunk"], row["audits"][4 * w[1] + after]))
            for after, w in enumerate(winners)
        ]

    def choices(self) -> Iterator[dict]:
        """One row for each chunk, the conversation's results at its last one."""
        final = [(x[0] + INSERT * len(_CLOSING[q]), x[1], _CLOSING[q], q) for q, x in enumerate(self.now) if x]
        cost, _, closing, state = min(final)
        paths, path = [], self.now[state][2]
        while path is not None:
            paths.append(path)
            path = path.before
        whole = "".join(p.audit for p in reversed(paths)) + closing
        place = 0
        for i, path in enumerate(reversed(paths)):
            last = i == len(paths) - 1
            audit = path.audit + (closing if last else "")
            summary = {"cost": cost, "audit": whole, **self.counts} if last else dict.fromkeys(("cost", "audit", *self.counts))
            yield {"chunk": path.chunk, "state": path.state, "edits": audit, "place": place, **summary}
            place += sum(letter != "D" for letter in audit)


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def _chained(chunks: DataFrame) -> DataFrame:
    """Choices for the conversations that are not whole in a chunk."""
    conv = chunks.schema["_conv"]
    schema = T.StructType(
        [conv, T.StructField("chunk", T.LongType()), T.StructField("state", T.LongType()), T.StructField("edits", T.StringType()), T.StructField("place", T.LongType())]
        + [T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]
        + [T.StructField(n, T.LongType()) for n in _COUNTS]
    )

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, chain = None, None
        for row in _rows(batches):
            if chain is not None and row["_conv"] != conv:
                yield from ({"_conv": conv, **x} for x in chain.choices())
                chain = None
            conv, chain = row["_conv"], chain or Chain()
            chain.add(row)
        if chain is not None:
            yield from ({"_conv": conv, **x} for x in chain.choices())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _grouped(chains(batches), schema)

    open_chunks = chunks.filter(~F.col("whole")).select("_conv", "chunk", "costs", "audits", *_COUNTS, "first", "last")
    return open_chunks.repartition("_conv").sortWithinPartitions("_conv", "chunk").mapInArrow(run, schema)


@dataclass
class Repair:
    """``summary``: one row a conversation with its faults, cost and audit.  ``chunks``: the
    turns that stay, in chunks; ``rows()`` writes them out, ``digests()`` reads them in order."""

    summary: DataFrame
    chunks: DataFrame
    conv_id: str

    def rows(self) -> DataFrame:
        """(conv_id, place, role, text) of the repaired conversations, place from 0."""
        schema = T.StructType([self.chunks.schema["_conv"], T.StructField("place", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

        def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for row in _rows(batches, 16):
                for i, (role, text) in enumerate(edited(row["state"], row["edits"], row["roles"], row["texts"])):
                    yield {"_conv": row["_conv"], "place": row["place"] + i, "role": role, "text": text}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _grouped(turns(batches), schema)

        return self.chunks.select("_conv", "place", "state", "edits", "roles", "texts").mapInArrow(run, schema).withColumnRenamed("_conv", self.conv_id)

    def digests(self) -> DataFrame:
        """(conv_id, sha256) of ``role:text`` lines.  A digest needs its conversation in order: one
        task reads it as a stream and holds a chunk at a time."""
        schema = T.StructType([self.chunks.schema["_conv"], T.StructField("sha256", T.StringType())])

        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            conv, digest, begun = None, None, False
            for row in _rows(batches, 16):
                if digest is not None and row["_conv"] != conv:
                    yield {"_conv": conv, "sha256": digest.hexdigest()}
                    digest, begun = None, False
                conv, digest = row["_conv"], digest or hashlib.sha256()
                for role, text in edited(row["state"], row["edits"], row["roles"], row["texts"]):
                    digest.update(f"\n{role}:{text}"[0 if begun else 1 :].encode("utf-8", "surrogatepass"))
                    begun = True
            if digest is not None:
                yield {"_conv": conv, "sha256": digest.hexdigest()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _grouped(hashed(batches), schema)

        needed = ["_conv", "chunk", "state", "edits", "roles", "texts"]
        alone = self.chunks.filter("whole").select(*needed)
        parts = self.chunks.filter("not whole").select(*needed).repartition("_conv").sortWithinPartitions("_conv", "chunk")
        found = alone.mapInArrow(run, schema).unionByName(parts.mapInArrow(run, schema))
        return found.withColumnRenamed("_conv", self.conv_id)


def repair_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Faults, cheapest edits and repaired turns of every conversation."""
    bounded_batches(turns.sparkSession)
    chunks = written(_chunks(turns, conv_id, turn, role, text), "conversation-chunks")
    chained = written(_chained(chunks), "conversation-choices")
    alone = chunks.filter("whole")
    choices = ["state", "edits", "place"]
    decided = alone.withColumns({"state": F.lit(0).cast("bigint"), "edits": F.col("audits")[0], "place": F.lit(0).cast("bigint")})
    split = chunks.filter("not whole").join(chained.select("chunk", *choices), "chunk")
    columns = ["_conv", "chunk", "whole", *choices, "roles", "texts"]
    summary = alone.select("_conv", *_COUNTS, F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit")).unionByName(
        chained.filter("audit is not null").select("_conv", *_COUNTS, "cost", "audit")
    )
    return Repair(summary.withColumnRenamed("_conv", conv_id), decided.select(*columns).unionByName(split.select(*columns)), conv_id)


# ---- damage


def _fault(conv_id: Column, turn: Column) -> Column:
    named = F.concat_ws(":", *(F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)))
    return F.pmod(F.crc32(named.cast("binary")), F.lit(20))


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with planted faults: of 20 rows one each is dropped, emptied,
    cut of its ``.!?``, repeated and given the role user, by the checksum of ``conv_id:turn``."""
    fault = _fault(F.col("conv_id"), F.col("turn"))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        turns.filter(fault != 0)
        .select(
            "conv_id",
            "turn",
            F.when(fault == 4, "user").otherwise(role).alias("role"),
            F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


def turn_gaps(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, gaps): missing numbers between a conversation's least and largest turn."""
    counted = turns.groupBy(conv_id).agg(F.max(turn).alias("_to"), F.min(turn).alias("_from"), F.count_distinct(turn).alias("_n"))
    return counted.select(conv_id, F.coalesce(F.col("_to") - F.col("_from") + 1 - F.col("_n"), F.lit(0)).alias("gaps"))
