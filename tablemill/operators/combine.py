"""Bring batches together and give frames a declared schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablemill.functions.values import column_named


def fan_in(frames: DataFrame | Sequence[DataFrame], *, drop: Sequence[str] = (), spark: SparkSession | None = None,
           schema: T.StructType | None = None) -> DataFrame:
    """Concatenate frames; columns go by name and absent ones become NULL.

    A single tagged frame is already together, so only the tag columns in ``drop`` go.
    For an empty list give ``spark`` and the ``schema`` of the empty result.
    """
    if isinstance(frames, DataFrame):
        frames = [frames]
    if not frames:
        if spark is None or schema is None:
            raise ValueError("an empty fan-in needs spark and schema")
        return spark.createDataFrame([], schema)
    together = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
    return together.drop(*drop)


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Columns in the order and types of ``schema``, matched by name.

    Absent nullable columns become NULL, further columns go, and a type that cannot hold
    the values fails instead of changing them.
    """
    return df.to(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other; key columns come from ``left``."""
    renamed = right.select(*[
        column_named(name).alias(f"_right_{keys.index(name)}") if name in keys else column_named(name)
        for name in right.columns
    ])
    match = reduce(
        lambda a, b: a & b,
        [column_named(name).eqNullSafe(F.col(f"_right_{number}")) for number, name in enumerate(keys)],
    )
    joined = left.join(renamed, match, how)
    return joined.drop(*[f"_right_{number}" for number in range(len(keys))])
