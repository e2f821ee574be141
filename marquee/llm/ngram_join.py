"""N-gram Jaccard join by several global token orders.

A text's set are its distinct shingles (as 64-bit hashes).  Two sets with a Jaccard
similarity of t or more share a token among the first ``n - ceil(t n) + 1`` of each,
in *any* order of all tokens.  So a candidate pair must share prefix tokens under
every one of several orders; the filters are intersected before a pair is verified
on its whole sets.

* The first order puts frequent tokens last.  Document counts of all tokens are
  taken in one pass; the ``HOT_TOKENS`` most frequent ones (a fixed bound) make the
  order, the others follow their hash.  The list only steers: any list gives the
  same links.
* Equal sets are one node.  Links inside a group of near copies are not all
  written out: first every set is tried against the most typical set of each
  prefix bucket (a star), then only pairs of *different* components are tried, in
  buckets that still hold more than one component.  That loses no connection.
* A bucket is cut by rows, never held in one task: stars come from partial maxima
  and joins that can be split.

Defined results: NULL, empty and word-free texts have an empty set and link with
nothing; a text of fewer words than a shingle is one shingle; equal rows get equal
results, and rows with one id but different texts each follow their own text; a
NULL id gives a NULL component and links nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.durable import written
from marquee.llm.bitmap import collect_bits, has, slot_of
from marquee.llm.components import connected_components
from marquee.llm.frames import bounded_batches, record_batch, thrifty
from marquee.llm.words import blocks, mix, split_words
from marquee.skew import hottest, salted_join

HOT_TOKENS = 262_144  # at most so many tokens in the broadcast order: 12 bytes each
HOT_COUNT = 8  # a token in fewer documents is ordered by its hash
TOKENS_PER_SORT = 400_000  # bound of a task's buffer
ROWS_AT_ONCE = 512
ORDERS = 3
LARGE_CLASS = 500


@dataclass(frozen=True)
class Likeness:
    """Shingle width, and similarity as a fraction of whole numbers."""

    width: int = 4
    over: int = 85
    under: int = 100

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - -(-self.over * n // self.under) + 1

    def linked(self, common: Column, a: Column, b: Column) -> Column:
        return self.under * common >= self.over * (a + b - common)


@dataclass
class Sets:
    """Distinct shingles of texts: ``bounds`` cut ``tokens``, which ascend in each text."""

    tokens: np.ndarray
    doc: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)


def shingle_sets(texts: list[str | None], width: int) -> Sets:
    words = split_words(texts)
    hashes, counts = words.hashes(lower=True), words.counts
    n = len(hashes)
    wide = np.minimum(counts, width)[words.doc] if n else np.zeros(0, np.int64)
    place = np.arange(n) - words.bounds[:-1][words.doc] if n else np.zeros(0, np.int64)
    first = place + wide <= counts[words.doc] if n else np.zeros(0, bool)
    at = np.flatnonzero(first & ((place == 0) | (counts[words.doc] >= width)))
    tokens = np.full(len(at), 0x51ED27, dtype=np.uint64)
    for k in range(width):
        inside = k < wide[at]
        tokens = np.where(inside, mix(tokens * np.uint64(0x9E3779B97F4A7C15) + hashes[np.minimum(at + k, n - 1)]), tokens) if n else tokens
    doc = words.doc[at]
    order = np.lexsort((tokens, doc))
    tokens, doc = tokens[order], doc[order]
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
    tokens, doc = tokens[new], doc[new]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    return Sets(tokens, doc, bounds)


def _each_block(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            rows = batch.slice(at, ROWS_AT_ONCE)
            values = rows.column(rows.schema.get_field_index(text)).to_pylist()
            for begin, end in blocks(values):
                yield rows.slice(begin, end - begin), values[begin:end]


# ---- packed sorted integers: deltas as byte planes, which the shuffle's codec shrinks well


def pack(ascending: np.ndarray) -> bytes:
    deltas = np.diff(ascending, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(deltas.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


_PACKED = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("blob", T.BinaryType())])
_COUNTED = T.StructType([T.StructField("token", T.LongType()), T.StructField("df", T.LongType())])


def _parts_of(df: DataFrame) -> int:
    """Ranges of the token space: several per shuffle partition, so that one range is small."""
    return 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _by_part(packed: DataFrame, of: Callable[[list[bytes]], pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """``of`` the blobs of each range.  Ranges lie sorted in a partition and are taken in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blobs = None, []
        for batch in batches:
            for now, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if blobs and now != part:
                    yield of(blobs)
                    blobs = []
                part = now
                blobs.append(blob.as_py())
        if blobs:
            yield of(blobs)

    return packed.select("part", "blob").repartition("part").sortWithinPartitions("part").mapInArrow(thrifty(run), schema)


def frequent_tokens(docs: DataFrame, text: str, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens (their upper 32 bits, ascending) and their document counts."""
    parts = _parts_of(docs)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            """Each token once, with its count: a line that many documents share is one entry."""
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            part = (tokens * np.uint64(parts)) >> np.uint64(32)
            found, starts = np.unique(part, return_index=True)
            pieces = zip(np.split(tokens, starts[1:]), np.split(counts.astype("<u4"), starts[1:]), strict=True)
            return record_batch({"part": found.astype(np.int32), "blob": [pack(t) + c.tobytes() for t, c in pieces]}, _PACKED)

        for _, values in _each_block(batches, text):
            held.append(shingle_sets(values, like.width).tokens >> np.uint64(32))
            if sum(map(len, held)) > TOKENS_PER_SORT:
                yield flush()
        if sum(map(len, held)):
            yield flush()

    def counted(blobs: list[bytes]) -> pa.RecordBatch:
        # Eight bytes a token, four a count.
        sizes = [len(b) // 12 * 8 for b in blobs]
        tokens = np.concatenate([unpack(b[:n]) for b, n in zip(blobs, sizes, strict=True)])
        found = np.concatenate([np.frombuffer(b[n:], dtype="<u4") for b, n in zip(blobs, sizes, strict=True)])
        order = np.argsort(tokens, kind="stable")
        tokens = tokens[order]
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        counts = np.add.reduceat(found[order].astype(np.int64), starts)
        often = counts >= HOT_COUNT
        return record_batch({"token": tokens[starts[often]].astype(np.int64), "df": counts[often]}, _COUNTED)

    counts = _by_part(docs.select(text).mapInArrow(thrifty(packed), _PACKED), counted, _COUNTED)
    top = counts.orderBy(F.desc("df"), "token").limit(HOT_TOKENS).toArrow()
    tokens, df = top.column("token").to_numpy(), top.column("df").to_numpy()
    order = np.argsort(tokens)
    return tokens[order].astype(np.uint64), df[order].astype(np.int64)


def order_keys(tokens: np.ndarray, k: int, hot: np.ndarray | None = None, df: np.ndarray | None = None) -> np.ndarray:
    """Key of each token in the ``k``-th order; order 0 has frequent tokens last, by count."""
    keys = mix(tokens ^ mix(np.full(1, k + 1, dtype=np.uint64))) >> np.uint64(1)
    if hot is not None and len(hot):
        upper = tokens >> np.uint64(32)
        at = np.minimum(np.searchsorted(hot, upper), len(hot) - 1)
        known = hot[at] == upper
        last = np.uint64(1 << 63) + (np.minimum(df[at], (1 << 30) - 1).astype(np.uint64) << np.uint64(32)) + (keys >> np.uint64(31))
        keys = np.where(known, last, keys)
    return keys


def prefixes(sets: Sets, keys: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of each text's prefix tokens, in order, and their places in the order."""
    order = np.lexsort((keys, sets.doc))
    place = np.arange(len(order)) - sets.bounds[:-1][sets.doc[order]]
    inside = place < like.prefix(sets.sizes)[sets.doc[order]]
    return order[inside], place[inside]


_NODES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("set_id", T.BinaryType()),
        T.StructField("token", T.ArrayType(T.LongType())),
        T.StructField("at", T.ArrayType(T.IntegerType())),
        T.StructField("typical", T.FloatType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("blob", T.BinaryType()),
    ]
)
_POSTING = T.StructType(
    [
        T.StructField("token", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("at", T.IntegerType()),
        T.StructField("typical", T.FloatType()),
    ]
)


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def nodes_and_postings(docs: DataFrame, text: str, like: Likeness, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """One row per document (size, digest of its set, frequent prefix tokens), and packed
    rows with the other prefix tokens by range of the token space."""
    parts = _parts_of(docs)
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, df = shared.value
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            token, doc, n, at = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(token, kind="stable")
            token, doc, n, at = token[order], doc[order], n[order], at[order]
            part = ((token >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            found, starts = np.unique(part, return_index=True)
            cuts = [*starts[1:], len(token)]
            blobs = []
            for a, b in zip(starts, cuts, strict=True):
                columns = (token[a:b] >> np.uint64(16), doc[a:b].view(np.uint64), n[a:b].astype(np.uint64), at[a:b].astype(np.uint64))
                # Tokens ascend; the other columns are small numbers whose upper byte planes are empty.
                body = [pack(columns[0])] + [np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns[1:]]
                blobs.append(b"".join(body))
            empty = [None] * len(found)
            return record_batch(
                {"doc_id": empty, "n": empty, "set_id": empty, "token": empty, "at": empty, "typical": empty, "part": found.astype(np.int32), "blob": blobs},
                _NODES,
            )

        for batch, values in _each_block(batches, text):
            sets = shingle_sets(values, like.width)
            ids = batch.column(0)
            known = np.array(ids.is_valid())
            ids64 = ids.fill_null(0).to_numpy().astype(np.int64)
            keys = order_keys(sets.tokens, 0, frequent, df)
            is_hot = keys >= np.uint64(1 << 63)
            index, place = prefixes(sets, keys, like)
            usable = known[sets.doc[index]]
            index, place = index[usable], place[usable]
            hot_here = is_hot[index]
            rest = index[~hot_here]
            held.append((sets.tokens[rest], ids64[sets.doc[rest]], sets.sizes[sets.doc[rest]], place[~hot_here]))
            # A digest of the set: its size and two sums over its tokens.
            starts = np.minimum(sets.bounds[:-1], len(sets.tokens))
            total = np.add.reduceat(np.append(sets.tokens, np.uint64(0)), starts)
            other = np.add.reduceat(np.append(mix(sets.tokens ^ np.uint64(7)), np.uint64(0)), starts)
            hot_counts = np.bincount(sets.doc[index[hot_here]], minlength=len(values))
            empty = [None] * len(values)
            yield record_batch(
                {
                    "doc_id": ids,
                    "n": sets.sizes.astype(np.int32),
                    "set_id": [
                        None if not (k and n) else n.to_bytes(4, "little") + a.tobytes() + b.tobytes()
                        for k, n, a, b in zip(known.tolist(), sets.sizes.tolist(), total, other, strict=True)
                    ],
                    "token": _lists((sets.tokens[index[hot_here]] >> np.uint64(16)).astype(np.int64), hot_counts, pa.int64()),
                    "at": _lists(place[hot_here].astype(np.int32), hot_counts, pa.int32()),
                    "typical": (np.bincount(sets.doc, weights=is_hot, minlength=len(values)) / np.maximum(sets.sizes, 1)).astype(np.float32),
                    "part": empty,
                    "blob": empty,
                },
                _NODES,
            )
            if sum(len(x[0]) for x in held) > TOKENS_PER_SORT // 2:
                yield flush()
        if sum(len(x[0]) for x in held):
            yield flush()

    return docs.mapInArrow(thrifty(run), _NODES)


def _shared_of_part(blobs: list[bytes]) -> pa.RecordBatch:
    """Postings of the tokens of one range that more than one document has."""
    columns: list[list[np.ndarray]] = [[], [], [], []]
    for blob in blobs:
        size = len(blob) // 4
        columns[0].append(unpack(blob[:size]))
        for k in (1, 2, 3):
            planes = np.frombuffer(blob[k * size : (k + 1) * size], dtype=np.uint8).reshape(8, -1)
            columns[k].append(np.ascontiguousarray(planes.T).view("<u8").ravel())
    token, doc, n, at = (np.concatenate(c) for c in columns)
    order = np.argsort(token, kind="stable")
    token, doc, n, at = token[order], doc[order], n[order], at[order]
    same = token[1:] == token[:-1]
    often = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    found = {
        "token": token[often].astype(np.int64),
        "doc_id": doc[often].view(np.int64),
        "n": n[often].astype(np.int32),
        "at": at[often].astype(np.int32),
        "typical": np.zeros(int(often.sum()), dtype=np.float32),
    }
    return record_batch(found, _POSTING)


def could_link(like: Likeness, a: str, b: str) -> Column:
    """Sizes and the places of a shared prefix token still allow a link."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = 1 + F.least(na - F.col(f"{a}.at") - 1, nb - F.col(f"{b}.at") - 1)
    return (like.under + like.over) * most.cast("bigint") >= like.over * (na + nb).cast("bigint")


def sets_of(docs: DataFrame, like: Likeness, wanted: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` (``_PREFIXES`` or ``_WHOLE``) for the documents in ``wanted``.

    A bitmap of the wanted ids, of fixed size, keeps most other texts from being
    cut; an id it lets through for nothing is harmless.
    """
    slot = slot_of(F.col("doc_id"))
    shared = docs.sparkSession.sparkContext.broadcast(collect_bits(wanted, slot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value

        def passed(batch: pa.RecordBatch) -> pa.RecordBatch:
            hit = has(held, batch.column(2).fill_null(0).to_numpy())
            return batch.filter(pa.array(hit & np.array(batch.column(0).is_valid())))

        for batch, values in _each_block((b for b in map(passed, batches) if b.num_rows), "text"):
            sets = shingle_sets(values, like.width)
            columns = {"doc_id": batch.column(0)}
            if schema is _WHOLE:
                columns |= {"n": sets.sizes.astype(np.int32), "tokens": _lists(sets.tokens.astype(np.int64), sets.sizes, pa.int64())}
            else:
                for k in range(1, ORDERS):
                    index, _ = prefixes(sets, order_keys(sets.tokens, k), like)
                    upper = (sets.tokens[index] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    columns[f"prefix{k}"] = _lists(upper, np.bincount(sets.doc[index], minlength=len(values)), pa.int32())
            yield record_batch(columns, schema)

    return docs.select("doc_id", "text", slot.alias("slot")).mapInArrow(thrifty(run), schema)


_PREFIXES = T.StructType(
    [T.StructField("doc_id", T.LongType())] + [T.StructField(f"prefix{k}", T.ArrayType(T.IntegerType())) for k in range(1, ORDERS)]
)
_WHOLE = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("tokens", T.ArrayType(T.LongType()))]
)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()


def _side(sets: DataFrame, end: str) -> DataFrame:
    return sets.select(*[F.col(c).alias(end if c == "doc_id" else f"{end}_{c}") for c in sets.columns])


def verified(pairs: DataFrame, docs: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (u, v) that share prefix tokens under every further order and whose
    whole sets are alike.  Whole sets are cut for what the orders let through only."""
    first = written(pairs, "ngram-pairs")
    some = written(sets_of(docs, like, _ends(first), _PREFIXES), "ngram-prefixes")
    both = first.join(_side(some, "u"), "u").join(_side(some, "v"), "v")
    for k in range(1, ORDERS):
        both = both.filter(F.arrays_overlap(f"u_prefix{k}", f"v_prefix{k}"))
    passed = written(both.select("u", "v").distinct(), "ngram-pairs")
    whole = written(sets_of(docs, like, _ends(passed), _WHOLE), "ngram-sets")
    compared = passed.join(_side(whole, "u"), "u").join(_side(whole, "v"), "v")
    common = F.size(F.array_intersect("u_tokens", "v_tokens")).cast("bigint")
    return compared.filter(like.linked(common, F.col("u_n").cast("bigint"), F.col("v_n").cast("bigint"))).select("u", "v").distinct()


def ngram_components(docs: DataFrame, id_column: str = "doc_id", text: str = "text", like: Likeness = Likeness()) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``, the
    least id reachable by links (the own one without links)."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    hot = frequent_tokens(source, "text", like)
    rows = written(nodes_and_postings(source, "text", like, hot), "ngram-rows")
    nodes = rows.filter("part is null").select("doc_id", "n", "set_id")
    # Equal sets are one node, named by its least id.
    classes = nodes.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members"))
    plain = _by_part(rows.filter("part is not null"), _shared_of_part, _POSTING)
    frequent = (
        rows.filter("part is null and size(token) > 0")
        .select("doc_id", "n", "typical", F.explode(F.arrays_zip("token", "at")).alias("p"))
        .select("p.token", "doc_id", "n", "p.at", "typical")
    )
    representatives = classes.select(F.col("rep").alias("doc_id"))
    postings = written(plain.unionByName(frequent).join(representatives, "doc_id", "left_semi"), "ngram-postings")
    # A star around the most typical set of each bucket.
    hub = (
        postings.groupBy("token")
        .agg(F.max(F.struct("typical", (-F.col("doc_id")).alias("minus_id"), "n", "at")).alias("h"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select("token", (-F.col("h.minus_id")).alias("doc_id"), F.col("h.n").alias("n"), F.col("h.at").alias("at"))
    )
    star = (
        postings.alias("a")
        .join(hub.alias("b"), "token")
        .filter("a.doc_id <> b.doc_id")
        .filter(could_link(like, "a", "b"))
        .select(F.col("a.doc_id").alias("u"), F.col("b.doc_id").alias("v"))
        .distinct()
    )
    first = written(verified(star, source, like), "ngram-links")
    merged = written(connected_components(first), "ngram-components")
    # What may still connect two components: buckets that hold more than one of them.
    placed = postings.join(merged.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    mixed = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("token")
    open_postings = placed.join(mixed, "token", "left_semi")
    across = (
        open_postings.alias("a")
        .join(open_postings.alias("b"), "token")
        .filter("a.doc_id < b.doc_id and a.component <> b.component")
        .filter(could_link(like, "a", "b"))
        .select(F.col("a.doc_id").alias("u"), F.col("b.doc_id").alias("v"))
        .distinct()
    )
    second = written(verified(across, source, like), "ngram-links")
    components = written(connected_components(first.unionByName(second)), "ngram-components")
    of_class = classes.join(components.withColumnRenamed("node", "rep"), "rep", "left").select("set_id", F.coalesce("component", "rep").alias("component_id"))
    # A class of copies beyond LARGE_CLASS is spread over the tasks of the join.
    large = hottest(classes, ["set_id"], "members", LARGE_CLASS)
    return salted_join(nodes, of_class, ["set_id"], large).select(
        F.col("doc_id").alias(id_column), F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
