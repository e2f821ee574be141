"""Feature columns from a layout (M8-M14): every field has its own stretch of one vector.

A layout is a list of fields.  A number takes one position; a categorical field takes as many
as it has values, and a row has a 1 at its value's position, or none for an unknown value.
``offsets`` is the table of stretches.  Indexes are column expressions and the vectors are
built by Spark ML's encoder and assembler, which know the widths only: a field of 403,648
values costs no more to ship than one of two.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import encoders as E


@dataclass(frozen=True)
class Number:
    """A number as it is; NULL counts as 0."""

    name: str
    width = 1


@dataclass(frozen=True)
class Hashed:
    """A text by its hash modulo ``width`` (M8); NULL has no position."""

    name: str
    width: int

    def index(self, method: str) -> Column:
        return F.when(F.col(self.name).isNotNull(), E.hash_bucket(F.col(self.name), self.width, method))


@dataclass(frozen=True)
class Words:
    """The place in a word list (M9); other words have no position."""

    name: str
    words: Sequence[str]

    @property
    def width(self) -> int:
        return len(self.words)

    def index(self, method: str) -> Column:
        return E.vocab_index(F.col(self.name), self.words)


@dataclass(frozen=True)
class Identity:
    """An integer from 0 to ``width`` - 1 (M10); others have no position."""

    name: str
    width: int

    def index(self, method: str) -> Column:
        return E.identity_index(F.col(self.name), self.width, "null")


@dataclass(frozen=True)
class Bounded:
    """The interval between bounds (M11); NULL has no position."""

    name: str
    bounds: Sequence[float]

    @property
    def width(self) -> int:
        return len(self.bounds) + 1

    def index(self, method: str) -> Column:
        return F.when(F.col(self.name).isNotNull(), E.bucketize(F.col(self.name), self.bounds))


@dataclass(frozen=True)
class Crossed:
    """The hash of several values together."""

    names: Sequence[str]
    width: int

    @property
    def name(self) -> str:
        return "_x_".join(self.names)

    def index(self, method: str) -> Column:
        return E.cross_bucket([F.col(n) for n in self.names], self.width, method)


Field = Number | Hashed | Words | Identity | Bounded | Crossed


def width(layout: Sequence[Field]) -> int:
    return sum(f.width for f in layout)


def offsets(spark: SparkSession, layout: Sequence[Field]) -> DataFrame:
    """(field, position, width): where each field begins in the vector."""
    rows, at = [], 0
    for f in layout:
        rows.append((f.name, at, f.width))
        at += f.width
    return spark.createDataFrame(rows, "field string, position int, width int")


def fixed_encoder(spark: SparkSession, columns: Sequence[str], outs: Sequence[str], widths: Sequence[int]) -> OneHotEncoderModel:
    """One-hot of stated widths: an index outside [0, width) gives the zero vector.

    The encoder learns widths from a row of largest indexes; with its slot for invalid values
    as the last one, and the last one dropped, these have none."""
    largest = spark.range(1).select(*[F.lit(float(w - 1)).alias(c) for c, w in zip(columns, widths, strict=True)])
    return OneHotEncoder(inputCols=list(columns), outputCols=list(outs), dropLast=True, handleInvalid="keep").fit(largest)


def indicator(df: DataFrame, index: str, n: int, out: str) -> DataFrame:
    """Sparse one-hot of fixed width n; NULL or an index outside [0, n) gives the zero vector."""
    encoder = fixed_encoder(df.sparkSession, ["_slot"], [out], [n])
    return encoder.transform(df.withColumn("_slot", F.coalesce(F.col(index).cast("double"), F.lit(-1.0)))).drop("_slot")


def encode(df: DataFrame, layout: Sequence[Field], out: str = "features", method: str = "xxhash64") -> DataFrame:
    """``df`` with the vector of the layout (M14), all fields in the layout's order."""
    indexed, parts, encoded = {}, [], []
    for i, f in enumerate(layout):
        if isinstance(f, Number):
            indexed[f"_number{i}"] = F.coalesce(F.col(f.name).cast("double"), F.lit(0.0))
            parts.append(f"_number{i}")
        else:
            indexed[f"_index{i}"] = F.coalesce(f.index(method).cast("double"), F.lit(-1.0))
            parts.append(f"_hot{i}")
            encoded.append((f"_index{i}", f"_hot{i}", f.width))
    wide = df.withColumns(indexed)
    if encoded:
        columns, outs, widths = zip(*encoded, strict=True)
        wide = fixed_encoder(df.sparkSession, columns, outs, widths).transform(wide)
    assembled = VectorAssembler(inputCols=parts, outputCol=out).transform(wide)
    return assembled.drop(*indexed, *[o for _, o, _ in encoded])


def positions(vector: str) -> Column:
    """(position, value) pairs of a vector's stored numbers other than 0, dense or sparse."""
    raw = F.unwrap_udt(F.col(vector))
    places = F.coalesce(raw["indices"], F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    both = F.arrays_zip(places.alias("position"), raw["values"].alias("value"))
    return F.filter(both, lambda p: p["value"] != 0)
