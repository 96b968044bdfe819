"""Batches by row *position*: runs of equally many rows in key order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablemill.functions.values import column_named
from tablemill.operators.numbering import ROWS_PER_TASK, Ranges, columns, cut_into_ranges, names, number_rows
from tablemill.operators.skew import look_up
from tablemill.operators.staging import store


def _cut(
    df: DataFrame, pk: str, batch_size: int, within: list[str], number: str, key: str, rows_per_task: int,
    tie_break: str | Sequence[str] | None,
) -> DataFrame:
    if not batch_size or batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    if not pk:
        raise ValueError("pk is needed to order the rows")
    size = int(batch_size)
    if not within and size <= rows_per_task:
        ranges = cut_into_ranges(df, [pk], [], tie_break=tie_break, rows_per_task=rows_per_task)
        if ranges is not None:
            return _first_keys_by_range(ranges, pk, size, number, key).select(*columns([*df.columns, number, key]))
    placed = number_rows(df, pk, within, into="_position", rows_per_task=rows_per_task, tie_break=tie_break)
    run = placed.withColumn(number, _run_number(size))
    group = [*within, number]
    if size <= rows_per_task:
        first = F.min(column_named(pk)).over(Window.partitionBy(*columns(group)))
        return run.drop("_position").withColumn(key, first)
    # Runs too long for one task: number once, then look up the first row of each run.
    stored = df.sparkSession.table(store(run, "runs"))
    firsts = stored.where(_begins(size)).select(*columns(group), column_named(pk).alias(key))
    return look_up(stored.drop("_position"), firsts, group, rows_per_task=rows_per_task)


def _run_number(size: int) -> Column:
    return F.expr(f"(_position - 1) div {size}")


def _begins(size: int) -> Column:
    return (F.col("_position") - 1) % size == 0


def _first_keys_by_range(ranges: Ranges, pk: str, size: int, number: str, key: str) -> DataFrame:
    """Runs and their first keys without shuffling or sorting the rows a second time.

    Most runs lie within one range of the numbering, where the first key is carried forward
    in the order of the rows.  A run that goes on in a later range is the last to begin in
    its own; the last beginnings of all ranges, one small row each, come from numbering
    the keys alone.
    """
    beginnings = ranges.keys_only([pk]).place("_position", {}).where(_begins(size))
    last = beginnings.groupBy("_range").agg(F.max(F.struct("_position", column_named(pk).alias("key"))).alias("last"))
    carried = last.select(
        F.expr(f"(last._position - 1) div {size}").alias("_carried"), F.col("last.key").alias("_carried_key")
    )
    so_far = ranges.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.last(F.when(_begins(size), F.struct(column_named(pk).alias("key"))), ignorenulls=True).over(so_far)
    run = ranges.place("_position", {}).select("*", begun.alias("_begun"), _run_number(size).alias(number))
    joined = run.join(F.broadcast(carried), F.col(number) == F.col("_carried"), "left")
    return joined.withColumn(key, F.when(F.col("_begun").isNotNull(), F.col("_begun.key")).otherwise(F.col("_carried_key")))


def split_by_position(
    df: DataFrame,
    pk: str,
    batch_size: int,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    tie_break: str | Sequence[str] | None = None,
) -> DataFrame:
    """Sort by ``pk`` (NULLs last) and cut into runs of ``batch_size`` rows.

    Adds ``batch_no`` (0, 1, ...) and ``batch_key``, the first key of the run.
    """
    return _cut(df, pk, batch_size, [], "batch_no", "batch_key", rows_per_task, tie_break)


def split_within(
    df: DataFrame,
    pk: str,
    batch_size: int,
    within: str | Sequence[str] = "batch_key",
    *,
    rows_per_task: int = ROWS_PER_TASK,
    tie_break: str | Sequence[str] | None = None,
) -> DataFrame:
    """Cut every existing batch again into runs; adds ``sub_no`` and ``sub_key``."""
    return _cut(df, pk, batch_size, names(within), "sub_no", "sub_key", rows_per_task, tie_break)
