"""Marks of few keys, by which most rows of a large frame are told from them without moving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A key's mark is one bit of 2^26, in words of 64: no more than 2^20 rows are broadcast, whatever the number of keys.
WORD_BITS = 20


def _mark(key: list[str]) -> tuple[Column, Column]:
    """The word of a key's mark, and its bit there."""
    hashed = F.xxhash64(*key)
    place = F.shiftrightunsigned(hashed, 58 - WORD_BITS).bitwiseAND(F.lit(63)).cast("int")
    return F.shiftrightunsigned(hashed, 64 - WORD_BITS), F.call_function("shiftleft", F.lit(1).cast("long"), place)


def with_marks(df: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """``df`` with ``_marked``: true for all rows whose key is among ``keys``, and for few others.

    Both frames have the columns of ``key``, of the same types.  The more keys, the more others are marked, so
    an exact join has to follow; it only gets the marked rows.
    """
    word, bit = _mark(key)
    words = keys.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    met = df.join(F.broadcast(words), word == F.col("_word"), "left")
    return met.withColumn("_marked", F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))).drop("_word", "_bits")
