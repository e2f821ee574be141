"""Scalar text functions: titles, genres, number and sequence texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_YEAR = 1990
_FINAL_YEAR = r"\((\d{4})\)\s*$"


def release_year(title: Column, default: int = DEFAULT_YEAR) -> Column:
    """Year in the final parentheses; ``default`` where there is none."""
    year = F.regexp_extract(title, _FINAL_YEAR, 1).try_cast("int")
    return F.coalesce(year, F.lit(default))


def strip_year(title: Column) -> Column:
    """Title without the final ``(year)``; NULL stays NULL."""
    return F.trim(F.regexp_replace(title, r"\s*\(\d{4}\)\s*$", ""))


def split_genres(genres: Column) -> Column:
    return F.split(genres, r"\|")


def explode_genres(genres: Column) -> Column:
    return F.explode(split_genres(genres))


def genre_slot(genres: Column, slot: int) -> Column:
    """1-based genre of the list; NULL beyond its end (no ANSI index error)."""
    return F.get(split_genres(genres), F.lit(slot - 1))


def genre_slots(genres: Column, n: int = 3, prefix: str = "movieGenre") -> list[Column]:
    return [genre_slot(genres, i).alias(f"{prefix}{i}") for i in range(1, n + 1)]


def format_2dp(x: Column) -> Column:
    """Two decimals as text, half-even on the exact binary value, with commas."""
    return F.format_number(x, 2)


def round_2dp(x: Column) -> Column:
    """Same rounding as :func:`format_2dp`, as a DOUBLE."""
    return F.regexp_replace(format_2dp(x), ",", "").cast("double")


def sequence_text(items: Column) -> Column:
    return F.array_join(items, " ")


def sequence_items(text: Column) -> Column:
    return F.split(text, " ")


def vector_text(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda v: v.cast("string")), " ")


def text_vector(text: Column) -> Column:
    return F.transform(F.split(text, " "), lambda v: v.cast("float"))


def percent_text(p: Column) -> Column:
    return F.format_string("%.2f%%", p * F.lit(100.0))


def label_text(label: Column) -> Column:
    return F.when(label != 0, F.lit("Good Rating")).otherwise(F.lit("Bad Rating"))
