"""Interactions of looked-up vectors: factorisation cross terms and history attention.

A vector table that was counted and found small enough goes to the tasks as one matrix, and
samples are scored where they lie, batch by batch.  Of a bigger one only the vectors that the
samples name go, in single precision where that keeps every number; still bigger ones are joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marquee.durable import written
from marquee.functions import numeric as N
from marquee.operators.samples import lookup_embedding
from marquee.skew import hot_keys

# Of a table of more doubles only the vectors in use are taken: 64 MB.
MATRIX_CELLS = 8_000_000
# So many times the cells in use are joined: 256 MB, of half as many bytes a number or half as many cells.
USED_SINGLES, USED_DOUBLES = 8, 4
ROWS_AT_ONCE = 8192


@dataclass
class Matrix:
    """Vectors by integer id; unknown and NULL ids have the zero vector."""

    ids: np.ndarray
    vectors: np.ndarray

    def rows(self, column: pa.Array, padding: int | None = None) -> np.ndarray:
        asked = column.cast(pa.int64())
        missing = asked.is_null().to_numpy(zero_copy_only=False)
        values = asked.fill_null(0).to_numpy(zero_copy_only=False)
        place = np.searchsorted(self.ids, values).clip(max=max(len(self.ids) - 1, 0))
        known = ~missing & (self.ids[place] == values) if len(self.ids) else np.zeros(len(values), bool)
        if padding is not None:
            known &= values != padding
        return np.where(known, place, len(self.ids))

    def of(self, column: pa.Array, padding: int | None = None) -> np.ndarray:
        return self.vectors[self.rows(column, padding)].astype(np.float64, copy=False)


def small_matrix(table: DataFrame, dim: int, used: DataFrame) -> Matrix | None:
    """The table as a matrix, or its vectors with ids in ``used`` (id); None when these are too
    many or ids are no integers."""
    if not isinstance(table.schema["id"].dataType, (T.IntegerType, T.LongType, T.ShortType)):
        return None
    number, kind = table.select(F.col("id").cast("bigint").alias("id"), N.as_doubles(F.col("emb")).alias("emb")), np.float64
    if table.count() * dim > MATRIX_CELLS:
        number = written(number.join(used.select(F.col("id").cast("bigint").alias("id")).distinct(), "id", "left_semi"), "used-vectors")
        single = F.coalesce(F.forall("emb", lambda v: v == v.cast("float").cast("double")), F.lit(False))
        found = number.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.bool_and(single).alias("single")).first()
        # An id that stands for several rows has no place in a matrix.
        if found["n"] * dim > MATRIX_CELLS * (USED_SINGLES if found["single"] else USED_DOUBLES) or found["ids"] < found["n"]:
            return None
        if found["single"]:
            number, kind = number.withColumn("emb", F.col("emb").cast("array<float>")), np.float32
    rows = number.orderBy("id").toArrow()
    vectors = np.zeros((rows.num_rows + 1, dim), dtype=kind)
    at = 0
    for chunk in rows.column("emb").chunks:
        vectors[at : at + len(chunk)] = np.asarray(chunk.flatten(), dtype=kind).reshape(-1, dim)
        at += len(chunk)
    return Matrix(rows.column("id").to_numpy(), vectors)


def _mapped(samples: DataFrame, added: list[T.StructField], of: Callable[[pa.RecordBatch], dict[str, pa.Array]]) -> DataFrame:
    """``samples`` with the columns that ``of`` computes for a batch."""
    names = {f.name for f in added}
    kept = samples.drop(*names)
    schema = T.StructType([*kept.schema.fields, *added])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                found = of(part)
                columns = [found[f.name] if f.name in names else part.column(part.schema.get_field_index(f.name)) for f in target]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return kept.mapInArrow(run, schema)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _ids_in(samples: DataFrame, names: list[str]) -> DataFrame:
    """(id): every id in the named columns."""
    return samples.select(F.explode(F.array(*[F.col(n).cast("bigint") for n in names])).alias("id")).distinct()


TERMS = ("item_user", "itemGenre_userGenre", "itemGenre_user", "item_userGenre")


def fm_cross_terms(
    samples: DataFrame, tables: dict[str, DataFrame], dim: int,
    item: str = "item", user: str = "user", item_genre: str = "itemGenre", user_genre: str = "userGenre",
) -> DataFrame:
    """The four pairwise dot products of a factorisation layer.

    ``samples`` holds an index per field; ``tables`` maps each field to its
    ``(id, emb)`` table.  The first-order part is
    :func:`marquee.operators.encoding.indicator` on the same indexes.
    """
    fields = [item, user, item_genre, user_genre]
    pairs = {"item_user": (0, 1), "itemGenre_userGenre": (2, 3), "itemGenre_user": (2, 1), "item_userGenre": (0, 3)}
    seen: dict[int, Matrix | None] = {}
    for field in fields:
        table = tables[field]
        if id(table) not in seen:
            seen[id(table)] = small_matrix(table, dim, _ids_in(samples, [f for f in fields if tables[f] is table]))
    matrices = [seen[id(tables[f])] for f in fields]
    if all(m is not None for m in matrices):
        shared = samples.sparkSession.sparkContext.broadcast(matrices)

        def of(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            found = [m.of(_column(batch, f)) for m, f in zip(shared.value, fields, strict=True)]
            return {name: pa.array(np.einsum("ij,ij->i", found[a], found[b])) for name, (a, b) in pairs.items()}

        return _mapped(samples, [T.StructField(t, T.DoubleType()) for t in TERMS], of)
    out, names = samples, [f"_e{n}" for n in range(4)]
    for field, name in zip(fields, names, strict=True):
        out = lookup_embedding(out, field, tables[field], dim, name, hot=lambda field=field: hot_keys(samples, [field]))
    return out.withColumns({t: N.dot(F.col(names[a]), F.col(names[b])) for t, (a, b) in pairs.items()}).drop(*names)


def history_attention_pool(
    samples: DataFrame, vectors: DataFrame, dim: int, item: str, history: list[str], out: str = "pooled"
) -> DataFrame:
    """Every sample with its history vectors weighted by their affinity to the candidate, summed.

    Weight is ``sigmoid(h . c)``; id 0 is padding and has no vector.
    """
    known = vectors.filter(F.col("id") != 0)
    matrix = small_matrix(vectors, dim, _ids_in(samples, [item, *history]))
    if matrix is not None:
        shared = samples.sparkSession.sparkContext.broadcast(matrix)

        def of(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            c = shared.value.of(_column(batch, item))
            pooled = np.zeros_like(c)
            for h in history:
                v = shared.value.of(_column(batch, h), padding=0)
                with np.errstate(over="ignore"):
                    pooled += v / (1 + np.exp(-np.einsum("ij,ij->i", v, c)))[:, None]
            return {out: pa.ListArray.from_arrays(np.arange(0, pooled.size + 1, dim, dtype=np.int32), pooled.ravel())}

        return _mapped(samples, [T.StructField(out, T.ArrayType(T.DoubleType()))], of)
    keys = [item, *history]
    distinct = written(samples.select(*keys).distinct().withColumn("_row", F.xxhash64(*keys)), "attended")
    attended = lookup_embedding(distinct, item, vectors, dim, "_c", hot=lambda: hot_keys(distinct, [item]))
    listed = attended.withColumn("_h", F.explode(F.array(*[F.col(h).cast("bigint") for h in history])))
    found = lookup_embedding(listed, "_h", known, dim, "_v", hot=lambda: hot_keys(listed, ["_h"]))
    weight = N.sigmoid(N.dot(F.col("_v"), F.col("_c")))
    scaled = N.once(weight, lambda w: F.transform("_v", lambda v: v * w))
    weighted = F.when(F.col("_h").isNull() | (F.col("_h") == 0), N.zero_vector(dim)).otherwise(scaled)
    summed = found.withColumn("_wv", array_to_vector(weighted)).groupBy("_row", *keys).agg(vector_to_array(Summarizer.sum(F.col("_wv"))).alias(out))
    same = [samples[k].eqNullSafe(summed[k]) for k in keys]
    # Equal ids meet by the hash of all of them, so that one popular item does not gather.
    hashed = F.xxhash64(*[samples[k] for k in keys]) == summed["_row"]
    for one in same:
        hashed = hashed & one
    return samples.join(summed, hashed, "inner").select(*[samples[c] for c in samples.columns if c != out], summed[out])
