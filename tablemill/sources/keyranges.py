"""Batches by key *value*: half-open ranges ``[lo, lo + size)`` from the smallest key on."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablemill.functions.values import column_named

BATCH_KEY = "batch_key"


def _key_column(df: DataFrame, pk: str) -> Column:
    """The key widened so that adding a batch size cannot overflow its type."""
    kind = df.select(column_named(pk)).schema[0].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column_named(pk).cast("bigint")
    if isinstance(kind, T.DecimalType):
        return column_named(pk).cast(f"decimal(38,{kind.scale})")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.nanvl(column_named(pk).cast("double"), F.lit(None).cast("double"))
    raise ValueError(f"key {pk} must be numeric, not {kind.simpleString()}")


def pk_bounds(df: DataFrame, pk: str) -> DataFrame:
    """One row ``(lo, hi)``: smallest and largest key, both NULL when there is none."""
    key = _key_column(df, pk)
    return df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))


def _range_start(key: Column, lo: Any, size: int) -> Column:
    if isinstance(lo, float):
        return F.lit(lo) + F.floor((key - lo) / size) * F.lit(float(size))
    # By remainders, so keys from one end of BIGINT to the other do not overflow.
    return key - F.pmod(F.pmod(key, F.lit(size)) - F.lit(lo % size), F.lit(size))


def with_pk_batches(
    df: DataFrame, pk: str, batch_size: int, *, lo: Any | None = None, into: str = BATCH_KEY
) -> DataFrame:
    """Tag each row with the start of its key range; rows without a key are left out.

    Unless the smallest key ``lo`` is given, finding it costs one pass over the key column.
    Tagging itself is row by row, so the tagged frame has no shuffle and keeps filters and
    column pruning at the scan.
    """
    if not batch_size or batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    key = _key_column(df, pk)
    kind = df.select(key.alias("key")).schema[0].dataType
    if lo is None:
        lo = pk_bounds(df, pk).first()["lo"]
    if lo is None:
        return df.where(F.lit(False)).withColumn(into, F.lit(None).cast(kind))
    return df.where(key.isNotNull()).withColumn(into, _range_start(key, lo, batch_size).cast(kind))


def batch_grid(df: DataFrame, pk: str, batch_size: int) -> DataFrame:
    """``(batch_key, n_rows)`` for every range from first to last key, empty ones included.

    The grid comes from ``spark.range``, so a long key span is generated by many tasks.
    Counts and zeros meet in one aggregation, which combines before its shuffle.
    """
    lo, hi = pk_bounds(df, pk).first()
    tagged = with_pk_batches(df, pk, batch_size, lo=lo)
    kind = tagged.schema[BATCH_KEY].dataType
    n_ranges = 0 if lo is None else int((hi - lo) // batch_size) + 1
    grid = range_starts(df.sparkSession, kind, lo, batch_size, n_ranges).withColumn("n", F.lit(0).cast("bigint"))
    counts = tagged.select(BATCH_KEY, F.lit(1).cast("bigint").alias("n"))
    return counts.unionByName(grid).groupBy(BATCH_KEY).agg(F.sum("n").alias("n_rows"))


def range_starts(spark: SparkSession, kind: T.DataType, lo: Any, batch_size: int, n_ranges: int) -> DataFrame:
    """``(batch_key)``, the first key of each of so many ranges from ``lo`` on."""
    step = F.col("id") if not isinstance(kind, T.DecimalType) else F.col("id").cast("decimal(38,0)")
    start = F.lit(lo).cast(kind) + step * F.lit(float(batch_size) if isinstance(lo, float) else batch_size)
    return spark.range(n_ranges).select(start.cast(kind).alias(BATCH_KEY))


def batch_rows_bound(df: DataFrame, pk: str, batch_size: int, enough: int, *, lo: Any | None = None) -> int:
    """An upper bound on the rows of one key range.

    Ranges are counted many at a time first: if even those hold at most ``enough`` rows,
    as with unique keys they do, that bounds each range at the cost of few groups.
    Otherwise the ranges are counted one by one.
    """
    together = max(1, enough // (2 * batch_size))
    for size in dict.fromkeys((batch_size * together, batch_size)):
        wide = with_pk_batches(df, pk, size, lo=lo)
        bound = wide.groupBy(BATCH_KEY).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if bound <= enough:
            break
    return bound


def read_batch(df: DataFrame, pk: str, start: Any, batch_size: int) -> DataFrame:
    """The rows of one range.  The comparison is on the stored column, so it reaches the scan."""
    return df.where((column_named(pk) >= F.lit(start)) & (column_named(pk) < F.lit(start + batch_size)))
