"""Text sources.

Nothing is inferred.  Checks sit in filters, so reading a single column or only
counting rows applies them as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RATINGS = {"userId": "int", "movieId": "int", "rating": "double", "timestamp": "bigint"}
MOVIES = {"movieId": "int", "title": "string", "genres": "string"}
LINKS = {"movieId": "int", "imdbId": "string", "tmdbId": "string"}

_TYPES = {int: "int", float: "float", str: "string"}


def read_header_csv(spark: SparkSession, path: str, types: Mapping[str, str], errors: str = "null") -> DataFrame:
    """Header CSV by column name.  Text that does not fit its type becomes NULL
    or an error."""
    if errors not in ("null", "raise"):
        raise ValueError("errors must be 'null' or 'raise'")
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    typed = [
        (F.col(c).try_cast(t) if errors == "null" else F.col(c).cast(t)).alias(c) for c, t in types.items()
    ]
    return raw.select(*typed)


def read_ratings(spark: SparkSession, path: str, errors: str = "null") -> DataFrame:
    """Ratings with a numeric timestamp."""
    return read_header_csv(spark, path, RATINGS, errors)


def read_movies(spark: SparkSession, path: str, errors: str = "null") -> DataFrame:
    """Movies; titles may be quoted and hold commas."""
    return read_header_csv(spark, path, MOVIES, errors)


def read_links(spark: SparkSession, path: str, errors: str = "null") -> DataFrame:
    """External ids as text: leading zeros stay, an empty id is NULL (S3)."""
    return read_header_csv(spark, path, LINKS, errors)


def _type_of_default(default: object) -> str:
    return _TYPES[type(default)]


def _field(i: int, default: object) -> tuple[Column, Column]:
    """Value with its default for an empty field, and whether it is malformed."""
    text = F.nullif(F.get("_f", F.lit(i)), F.lit(""))
    if isinstance(default, str):
        return F.coalesce(text, F.lit(default)), F.lit(False)
    typed = text.try_cast(_type_of_default(default))
    return F.coalesce(typed, F.lit(default).cast(_type_of_default(default))), text.isNotNull() & typed.isNull()


def read_typed_tsv(
    spark: SparkSession, path: str, defaults: Mapping[str, object], on_error: str = "raise"
) -> DataFrame:
    """Headerless TSV of fixed columns, each with a default that also names its
    type (S4).

    A line of the wrong length or with text in a number is an error.
    ``on_error='quarantine'`` keeps such lines with a reason in ``_error`` and
    the text in ``_line`` (both NULL on good lines); ``'drop'`` leaves them out.
    """
    if on_error not in ("raise", "quarantine", "drop"):
        raise ValueError("on_error must be 'raise', 'quarantine' or 'drop'")
    lines = spark.read.text(path).withColumn("_f", F.split("value", "\t", -1))
    return parse_typed_lines(lines, defaults, on_error)


def parse_typed_lines(lines: DataFrame, defaults: Mapping[str, object], on_error: str = "raise") -> DataFrame:
    """The stateless half of :func:`read_typed_tsv`; works on streams too."""
    fields = {name: _field(i, default) for i, (name, default) in enumerate(defaults.items())}
    wrong_size = F.size("_f") != len(fields)
    reason = F.when(wrong_size, F.concat(F.lit("fields: "), F.size("_f").cast("string")))
    for name, (_, bad) in fields.items():
        reason = reason.when(bad, F.lit(f"not a number: {name}"))
    values = [value.alias(name) for name, (value, _) in fields.items()]
    marked = lines.withColumn("_error", reason)
    if on_error == "quarantine":
        held = [F.when(F.col("_error").isNull(), v).alias(n) for n, (v, _) in fields.items()]
        return marked.select(*held, "_error", F.when(F.col("_error").isNotNull(), F.col("value")).alias("_line"))
    if on_error == "drop":
        return marked.filter(F.col("_error").isNull()).select(*values)
    stop = F.raise_error(F.concat(F.lit("bad line, "), F.col("_error"), F.lit(": "), F.col("value"))).cast("boolean")
    return marked.filter(F.when(F.col("_error").isNull(), F.lit(True)).otherwise(stop)).select(*values)


def read_named_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str],
    label: str = "label",
    na_value: str = "0",
    drop_bad: bool = True,
) -> DataFrame:
    """Header CSV for training (S5): ``na_value`` and empty cells become the type
    default (0 or ""), malformed rows go, the label comes last.

    Every column is read as text without pruning, so the field count is always
    checked; values are then cast and checked in one filter.
    """
    mode = "DROPMALFORMED" if drop_bad else "FAILFAST"
    raw = (
        spark.read.option("header", True)
        .option("columnPruning", False)
        .option("mode", mode)
        .option("escape", '"')
        .csv(path)
    )
    missing = {c: F.nullif(F.nullif(F.col(c), F.lit(na_value)), F.lit("")) for c in types}
    typed = {c: m if types[c] == "string" else m.try_cast(types[c]) for c, m in missing.items()}
    bad = F.lit(False)
    for c in types:
        if types[c] != "string":
            bad = bad | (missing[c].isNotNull() & typed[c].isNull())
    if drop_bad:
        checked = raw.filter(~bad)
    else:
        checked = raw.filter(F.when(~bad, F.lit(True)).otherwise(F.raise_error(F.lit("malformed row")).cast("boolean")))
    order = [c for c in types if c != label] + ([label] if label in types else [])
    fill = {c: F.lit("") if types[c] == "string" else F.lit(0).cast(types[c]) for c in order}
    return checked.select(*[F.coalesce(typed[c], fill[c]).alias(c) for c in order])


def read_matrix_tsv(
    spark: SparkSession, path: str, drop_last: bool = True, columns: int | None = None, on_error: str = "raise"
) -> DataFrame:
    """Headerless TSV matrix (S11): ``label`` is field 0, ``features`` the rest,
    without the last field by default.

    A line without a cell, or with other than ``columns`` cells where that is given, or with
    text in a cell is an error; an empty cell is NULL.  ``on_error`` is as for
    :func:`read_typed_tsv`.
    """
    if on_error not in ("raise", "quarantine", "drop"):
        raise ValueError("on_error must be 'raise', 'quarantine' or 'drop'")
    parts = spark.read.text(path).withColumn("_f", F.split("value", "\t", -1))
    n = F.size("_f") - F.lit(2 if drop_last else 1)
    cells = F.transform(F.slice(F.col("_f"), F.lit(2), F.greatest(n, F.lit(0))), lambda c: F.nullif(c, F.lit("")))
    numbers = F.transform("_cells", lambda c: c.try_cast("double"))
    text = F.exists("_cells", lambda c: c.isNotNull() & c.try_cast("double").isNull())
    wrong = n < 1 if columns is None else n != columns
    reason = F.when(wrong, F.concat(F.lit("cells: "), n.cast("string"))).when(text, F.lit("not a number"))
    marked = parts.withColumn("_cells", cells).withColumn("_error", reason)
    good = F.col("_error").isNull()
    values = [F.get("_f", F.lit(0)).alias("label"), numbers.alias("features")]
    if on_error == "quarantine":
        return marked.select(*[F.when(good, v).alias(v_name) for v, v_name in zip(values, ("label", "features"))], "_error", F.when(~good, F.col("value")).alias("_line"))
    if on_error == "drop":
        return marked.filter(good).select(*values)
    stop = F.raise_error(F.concat(F.lit("bad line, "), F.col("_error"), F.lit(": "), F.col("value"))).cast("boolean")
    return marked.filter(F.when(good, F.lit(True)).otherwise(stop)).select(*values)


def default_types(defaults: Mapping[str, object]) -> dict[str, str]:
    return {c: _type_of_default(v) for c, v in defaults.items()}


def numeric_columns(defaults: Mapping[str, object], skip: Sequence[str] = ("label",)) -> list[str]:
    return [c for c, v in defaults.items() if not isinstance(v, str) and c not in skip]


def text_columns(defaults: Mapping[str, object]) -> list[str]:
    return [c for c, v in defaults.items() if isinstance(v, str)]
