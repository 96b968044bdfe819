"""Where a row's sort key falls among sorted split points."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablemill.functions.values import column_named


def sort_key(names: Sequence[str]) -> Column:
    """One comparable value for several columns, ascending with NULLs last."""
    parts = []
    for number, name in enumerate(names):
        parts.append(column_named(name).isNull().alias(f"missing_{number}"))
        parts.append(column_named(name).alias(f"value_{number}"))
    return F.struct(*parts)


def point_text(value: Column, kind: T.DataType) -> Column:
    """A split point as text that :func:`point_array` turns back into the same value."""
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, T.TimestampType):
        # seconds rather than local time, which is ambiguous where clocks are set back
        return value.cast("decimal(20,6)").cast("string")
    return value.cast("string")


def point_array(texts: Sequence[str | None], kind: T.DataType) -> Column:
    """Split points of one column as a constant array."""
    array = F.from_json(F.lit(json.dumps(list(texts))), "array<string>")
    if isinstance(kind, (T.BinaryType, T.StringType)):
        return array
    if isinstance(kind, T.TimestampType):
        array = array.cast("array<decimal(20,6)>")
    return array.cast(T.ArrayType(kind))


def with_number_range(df: DataFrame, name: str, texts: Sequence[str | None], into: str) -> DataFrame:
    """Add the range of a numeric key.

    Compared as doubles: keys beyond 2**53 may share one, but a larger key never gets an
    earlier range.  Keys that are NaN or NULL make the last range.
    """
    points = {float(text) for text in texts if text is not None}
    inner = sorted(point for point in points if math.isfinite(point))
    if not inner:
        return df.withColumn(into, F.lit(0))
    ranges = Bucketizer(
        splits=[-math.inf, *inner, math.inf], inputCol="_as_double", outputCol="_bucket", handleInvalid="keep"
    )
    bucketed = ranges.transform(df.withColumn("_as_double", column_named(name).cast("double")))
    last = len(inner) + 1
    return bucketed.withColumn(into, F.coalesce(F.col("_bucket").cast("int"), F.lit(last))).drop("_as_double", "_bucket")


def searched_range(points: Sequence[Column], n_points: int, names: Sequence[str], kinds: Sequence[T.DataType]) -> Column:
    """How many split points, one array per key column, are at or below the row's key.

    By halving, so a row costs log2(n_points) comparisons.
    """
    keys = [
        F.hex(column_named(name)) if isinstance(kind, T.BinaryType) else column_named(name)
        for name, kind in zip(names, kinds)
    ]
    columns = list(zip(points, keys))

    def plain(at: Column) -> Column:
        """For keys without NULL.  A NULL point, or a place past the end, is not below."""
        (array, key), *rest = reversed(columns)
        found = F.get(array, at) <= key
        for array, key in rest:
            found = (F.get(array, at) < key) | ((F.get(array, at) == key) & found)
        return found

    def null_safe(at: Column) -> Column:
        found = F.lit(True)
        for array, key in reversed(columns):
            point = F.get(array, at)
            below = F.coalesce(point < key, key.isNull() & point.isNotNull())
            found = below | (point.eqNullSafe(key) & found)
        return (at < n_points) & found

    steps = F.array(*[F.lit(1 << power) for power in reversed(range(n_points.bit_length()))])

    def search(not_above: object) -> Column:
        return F.aggregate(
            steps, F.lit(0), lambda found, step: F.when(not_above(found + step - 1), found + step).otherwise(found)
        )

    complete = F.lit(True)
    for key in keys:
        complete &= key.isNotNull()
    return F.when(complete, search(plain)).otherwise(search(null_safe))
