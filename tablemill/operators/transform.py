"""SQL over named frames, and the identity step."""

from __future__ import annotations

import threading
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame

# Temp view names are shared by a session, so only one call at a time may bind them.
_binding = threading.RLock()


def sql_transform(
    query: str,
    input_df: DataFrame | None = None,
    *,
    args: Mapping[str, Any] | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """Run a SELECT in which ``input_df`` and the other given names stand for frames.

    The plan is resolved before the names are released again, so the result stays valid
    and a view of the user's with the same name comes back unharmed.
    """
    named = dict(frames)
    if input_df is not None:
        named["input_df"] = input_df
    if not named:
        raise ValueError("give at least one frame")
    spark = next(iter(named.values())).sparkSession
    hidden: dict[str, DataFrame] = {}
    bound: list[str] = []
    with _binding:
        try:
            for name, frame in named.items():
                if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary:
                    hidden[name] = spark.table(name)
                frame.createOrReplaceTempView(name)
                bound.append(name)
            return spark.sql(query, args=dict(args or {}))
        finally:
            for name in bound:
                if name in hidden:
                    hidden[name].createOrReplaceTempView(name)
                else:
                    spark.catalog.dropTempView(name)


def passthrough(df: DataFrame) -> DataFrame:
    """The input as it is."""
    return df
