"""Bitmaps of fixed size: a first filter whose false hits a later exact join drops."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24  # 2 MB, whatever is put in


def slot_of(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(1 << BITS))


def collect_bits(slots: DataFrame, slot: Column) -> np.ndarray:
    """The bitmap of a column of slots: one word per 32 slots, or-ed by Spark."""
    words = (
        slots.select(slot.alias("slot"))
        .groupBy(F.expr("slot div 32").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 32 as int))")).alias("mask"))
        .toArrow()
    )
    bitmap = np.zeros((1 << BITS) // 32, dtype=np.uint32)
    bitmap[words.column("word").to_numpy()] = words.column("mask").to_numpy().astype(np.uint32)
    return bitmap


def has(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((bitmap[slots >> 5] >> (slots & 31).astype(np.uint32)) & 1).astype(bool)
