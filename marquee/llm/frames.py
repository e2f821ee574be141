"""Running Arrow functions over one text column while keeping every other column."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows turned into Python objects together; a batch of Spark may have many more.
ROWS_AT_ONCE = 1024

Columns = dict[str, "np.ndarray | list | pa.Array"]


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 4 MB in this session, unless it has a setting of its own.

    The usual 64 MB stand several times in an executor's and its Python workers' memory.
    """
    if spark.conf.get(BATCH_BYTES) == "67108864b":
        spark.conf.set(BATCH_BYTES, "4m")


def give_back() -> None:
    """Hand freed memory back to the system: Spark keeps a task's Python worker for the next one,
    and several idle workers stand beside an executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over a partition, whose memory is given back at its end."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return over


def record_batch(columns: Columns, schema: T.StructType) -> pa.RecordBatch:
    target = to_arrow_schema(schema)
    arrays = []
    for field in target:
        values = columns[field.name]
        arrays.append(values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def squeeze(values: np.ndarray, kind: type) -> bytes:
    """Small numbers as compressed byte planes."""
    planes = values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(blob: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def map_text(
    df: DataFrame,
    text: str,
    added: T.StructType,
    of: Callable[[Iterator[pa.Array]], Iterator[Columns]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the columns ``added`` that ``of`` derives from the text column.

    ``of`` gets the texts of a partition in turn, ``ROWS_AT_ONCE`` at most at a time, and yields, in row order,
    one or more groups of columns that together have as many rows as were read so
    far, at the latest when an array is done.  ``keep`` names the columns of ``df``
    to carry along, all by default; a column of ``df`` with the name of an added
    one gives way to it.
    """
    bounded_batches(df.sparkSession)
    names = {f.name for f in added.fields}
    carried = [c for c in (df.columns if keep is None else keep) if c not in names]
    source = df.select(*dict.fromkeys([*carried, text]))
    schema = T.StructType([source.schema[c] for c in carried] + list(added.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []

        def texts() -> Iterator[pa.Array]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                    rest.append(batch.slice(at, ROWS_AT_ONCE))
                    yield rest[-1].column(batch.schema.get_field_index(text))

        offset = 0
        for columns in of(texts()):
            n = len(columns[added.fields[0].name])
            taken: Columns = dict(columns)
            part = rest[0].slice(offset, n)
            for c in carried:
                taken[c] = part.column(part.schema.get_field_index(c))
            offset += n
            if offset >= rest[0].num_rows:
                rest.pop(0)
                offset = 0
            yield record_batch(taken, schema)

    return source.mapInArrow(thrifty(run), schema)
