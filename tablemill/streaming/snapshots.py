"""Bring a downstream table up to date with an upstream that may have been changed or replaced.

New files alone (:mod:`tablemill.streaming.refresh`) tell nothing about rows that went or changed.  Here the state of
the upstream at the last refresh is kept as keys and hashes of rows, and its difference from the present
state is what the downstream gets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablemill.functions.values import column_named
from tablemill.operators.combine import join_on
from tablemill.operators.rewrite import merge_rows, when_matched_delete, when_matched_update, when_not_matched_insert
from tablemill.operators.staging import store
from tablemill.operators.tables import load_table
from tablemill.operators.transform import sql_transform

CHANGE = "_change"
INSERTED, CHANGED, DELETED = "insert", "update", "delete"
ROW_HASH = "_row_hash"


def row_hash(df: DataFrame) -> Column:
    """256 bits of all columns by name, so that their order does not count; NULL differs from every value."""
    return F.sha2(F.to_json(F.struct(*map(column_named, sorted(df.columns))), {"ignoreNullFields": "false"}), 256)


def fingerprint(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of a frame and the hash of each row."""
    return df.select(*map(column_named, keys), row_hash(df).alias(ROW_HASH))


def snapshot_changes(current: DataFrame, before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``current`` that are new or changed since ``before``, and the keys of those that went.

    ``before`` is a :func:`fingerprint`.  ``_change`` is insert, update or delete; rows that went are NULL outside
    their key.  Keys are unique and not NULL.  There is one full outer join by key.
    """
    keys = list(keys)
    now = current.withColumn(ROW_HASH, row_hash(current))
    was = before.select(*[column_named(name).alias(f"_was_{n}") for n, name in enumerate(keys)], F.col(ROW_HASH).alias("_hash_before"))
    same_key = [column_named(name) == F.col(f"_was_{n}") for n, name in enumerate(keys)]
    met = now.join(was, same_key, "full_outer")
    change = (
        F.when(F.col("_hash_before").isNull(), INSERTED)
        .when(F.col(ROW_HASH).isNull(), DELETED)
        .when(F.col(ROW_HASH) != F.col("_hash_before"), CHANGED)
    )
    shown = [
        F.coalesce(column_named(name), F.col(f"_was_{keys.index(name)}")).alias(name) if name in keys else column_named(name)
        for name in current.columns
    ]
    return met.select(*shown, change.alias(CHANGE)).where(F.col(CHANGE).isNotNull())


def refresh_from_snapshot(
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    *,
    sql: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    state: str | None = None,
) -> dict[str, int]:
    """Make ``target`` follow ``source``, whatever happened to it, and say how many rows were inserted, changed, deleted.

    ``sql`` (a SELECT over ``input_df``) or ``transform`` works row by row and keeps the key columns; it gets the
    inserted and changed rows alone.  A row that it drops is deleted downstream.  The target is
    made if missing; rows in it whose keys the source never had stay.  ``state`` is the table of the last
    fingerprint, ``<target>_state`` unless given.

    The difference is staged, merged into the target, and only then becomes the state: a refresh that fails in between
    finds the same difference again, and merging it once more changes nothing.  NULL or repeated keys are an error.
    """
    if sql and transform:
        raise ValueError("give sql or transform, not both")
    spark, keys, state = source.sparkSession, list(keys), state or f"{target}_state"
    present = spark.table(store(source, "present"))
    _check_keys(present, keys)
    marks = fingerprint(present, keys)
    before = spark.table(state) if spark.catalog.tableExists(state) else marks.limit(0)
    changes = spark.table(store(snapshot_changes(present, before, keys), "changes"))
    counts = {row[CHANGE]: row["count"] for row in changes.groupBy(CHANGE).count().collect()}
    if counts or not spark.catalog.tableExists(target):
        _apply(spark, changes, target, keys, sql, transform)
    load_table(marks, state, recreate=True)
    return {name: counts.get(name, 0) for name in (INSERTED, CHANGED, DELETED)}


def _check_keys(rows: DataFrame, keys: list[str]) -> None:
    found = rows.groupBy(*map(column_named, keys)).agg(F.count(F.lit(1)).alias("_n"))
    missing = " OR ".join(f"`{name.replace('`', '``')}` IS NULL" for name in keys)
    bad = found.where(f"_n > 1 OR {missing}").limit(1).collect()
    if bad:
        raise ValueError(f"keys must be unique and not NULL, unlike {bad[0].asDict()}")


def _apply(
    spark: SparkSession, changes: DataFrame, target: str, keys: list[str], sql: str | None, transform: Callable | None
) -> None:
    new = changes.where(F.col(CHANGE) != DELETED).drop(CHANGE)
    shaped = sql_transform(sql, new) if sql else transform(new) if transform else new
    shaped = spark.table(store(shaped, "shaped"))
    if not spark.catalog.tableExists(target):
        load_table(shaped, target)
        return
    # what went, and what the transform dropped, has a key alone
    gone = join_on(changes.select(*map(column_named, keys)), shaped.select(*map(column_named, keys)), keys, "left_anti")
    source = shaped.withColumn(CHANGE, F.lit(CHANGED)).unionByName(gone.withColumn(CHANGE, F.lit(DELETED)), allowMissingColumns=True)
    values = {name: F.col("source").getField(name) for name in shaped.columns}
    merge_rows(target, source, keys, [
        when_matched_delete(F.col(f"source.{CHANGE}") == DELETED),
        when_matched_update(values),
        when_not_matched_insert(values, F.col(f"source.{CHANGE}") != DELETED),
    ])
