"""Work that sees one batch at a time, on a frame tagged with batch keys.

Row-by-row SQL needs none of this: run it over the whole tagged frame.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tablemill.functions.ranges import point_array, point_text
from tablemill.functions.values import column_named
from tablemill.operators.combine import fan_in, join_on
from tablemill.operators.numbering import ROWS_PER_TASK, columns, group_sizes, names
from tablemill.operators.skew import BROADCAST_BYTES, frequent_keys, row_bytes
from tablemill.operators.staging import store
from tablemill.operators.tables import TABLE_FORMAT
from tablemill.operators.transform import sql_transform
from tablemill.sources.keyranges import BATCH_KEY, pk_bounds, range_starts, read_batch, with_pk_batches

log = logging.getLogger(__name__)


def batch_totals(
    df: DataFrame,
    within: str | Sequence[str],
    totals: dict[str, Column],
    *,
    largest: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add to each row aggregates of its batch: plain aggregate functions, ``{"n": F.count("*")}``.

    If the aggregates of all batches are known to be small they are broadcast, and no row
    is shuffled.  Otherwise batches that fit a task share a window, and the aggregates of
    larger batches, which cannot be many, are broadcast to their rows.  ``largest`` is an
    upper bound the caller knows; then the batches are not counted.
    """
    within = names(within)

    def over_window(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*columns(within))
        return rows.select("*", *[value.over(window).alias(name) for name, value in totals.items()])

    if largest is not None and largest <= rows_per_task:
        return over_window(df)
    combined = df.groupBy(*columns(within)).agg(*[value.alias(name) for name, value in totals.items()])
    sizes = group_sizes(df, within)
    bytes_each = row_bytes(combined, within, sizes)
    if bytes_each is not None and sizes.groups * bytes_each <= BROADCAST_BYTES:
        return join_on(df, F.broadcast(combined), within, "left")
    if sizes.largest <= rows_per_task:
        return over_window(df)
    if bytes_each is None:
        # nested results, such as collected lists: nothing bounds a broadcast
        return join_on(df, combined, within, "left")
    frequent = F.broadcast(frequent_keys(df, within, sizes, bytes_each, rows_per_task))
    large = join_on(df, frequent, within, "left_semi")
    of_large = join_on(combined, frequent, within, "left_semi")
    small = join_on(df, frequent, within, "left_anti")
    return join_on(large, F.broadcast(of_large), within, "left").unionByName(over_window(small))


def top_per_batch(
    df: DataFrame, within: str | Sequence[str], order: Sequence[Column], n: int, *, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The first ``n`` rows of each batch: ``ORDER BY ... LIMIT n`` once per batch.

    Spark keeps only n rows per batch and task before the shuffle (group limit), so a
    large batch does not gather in one place.  It does so up to a limit of n.  Beyond it
    each batch is cut into parts by where its rows are read, and the first n of each part
    compete, as many as fit a task; which part a row is in does not change the outcome.
    """
    within = names(within)
    place = F.row_number()
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        parts = max(2, rows_per_task // n)
        window = Window.partitionBy(*columns(within), "_part").orderBy(*order)
        df = (
            df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(parts)))
            .withColumn("_place", place.over(window))
            .where(F.col("_place") <= n)
            .drop("_part", "_place")
        )
    window = Window.partitionBy(*columns(within)).orderBy(*order)
    return df.withColumn("_place", place.over(window)).where(F.col("_place") <= n).drop("_place")


# Plans in one query; more batches take several queries, each appended to the same table.
PLANS_AT_ONCE = 100


def _one_plan_each(parts: Iterable[tuple[Column, DataFrame]], df: DataFrame, kind: T.DataType, query: str,
                   batch_key: str) -> DataFrame:
    """The results of all parts, each with its key: one query while few, else stored group by group."""
    parts, table = iter(parts), None
    while group := list(islice(parts, PLANS_AT_ONCE)):
        results = fan_in([sql_transform(query, rows).withColumn(batch_key, key) for key, rows in group])
        following = next(parts, None)
        if table is None and following is None:
            return results
        if table is None:
            table = store(results, "batch_results")
        else:
            results.write.format(TABLE_FORMAT).mode("append").saveAsTable(table)
        if following is not None:
            parts = chain([following], parts)
    if table is None:
        return sql_transform(query, df).withColumn(batch_key, F.lit(None).cast(kind)).where(F.lit(False))
    return df.sparkSession.table(table)


# How plans show a subquery within an expression.
SUBQUERY = re.compile(r"\b(scalar-subquery|lateral-subquery|exists|list)#")


def _in_one_plan(keys: DataFrame, rows: DataFrame, query: str, batch_key: str, inside: Sequence[str]) -> DataFrame | None:
    """``query`` over the rows of each key as one plan, None if Spark cannot plan it that way.

    The query becomes a LATERAL subquery in which ``input_df`` is the rows of the key at hand.  Spark turns it into joins,
    groups and windows by key.  That fails for subqueries in expressions of the query (IN, EXISTS, scalar ones), which
    are told by its analysed plan, and for what Spark refuses or leaves with a reference to the key from outside.
    """
    shown, label = ", ".join(map(_named, inside)), _named(batch_key)
    alone = sql_transform(query, rows.select(*columns(inside)))
    names_out = alone.columns
    if SUBQUERY.search(alone._jdf.queryExecution().analyzed().toString()):
        return None
    results = [name for name in names_out if name.lower() != batch_key.lower()]
    if len({name.lower() for name in names_out}) < len(names_out):
        return None
    text = (
        f"SELECT {', '.join([*(f'_of_batch.{_named(name)}' for name in results), f'_batches.{label}'])} FROM _batches, LATERAL ("
        f"WITH input_df AS (SELECT {shown} FROM _batch_rows WHERE _batch_rows.{label} <=> _batches.{label}) "
        f"SELECT * FROM (\n{query}\n)) AS _of_batch"
    )
    try:
        found = sql_transform(text, _batches=keys, _batch_rows=rows)
        if "outer(" in found._jdf.queryExecution().executedPlan().toString():
            return None
    except Exception as problem:  # noqa: BLE001 - what cannot be planned goes the other way, where true errors come up again
        log.info("one plan per batch for %s: %s", query, problem)
        return None
    order = [name if name.lower() != batch_key.lower() else batch_key for name in names_out]
    return found.select(*columns(order if batch_key in order else [*order, batch_key]))


def _named(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_per_range(df: DataFrame, query: str, pk: str, batch_size: int) -> DataFrame:
    """Any SELECT over ``input_df``, run once per key range, also for ranges without rows.

    The results carry ``batch_key``.  All ranges are one plan, which reads the frame once, however many there are.

    SQL that Spark cannot plan so (:func:`_in_one_plan`: subqueries over ``input_df`` within the query, columns of
    equal names) takes one plan per range.  Each reads its range by a comparison that reaches the scan, which
    skips the rest where the data is laid out by key; of many ranges the plans run in groups, and the
    results are stored until :func:`tablemill.operators.staging.drop_scratch`.
    """
    if not batch_size or batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    bounds = pk_bounds(df, pk)
    lo, hi = bounds.first()
    n_ranges = 0 if lo is None else int((hi - lo) // batch_size) + 1
    kind = bounds.schema["lo"].dataType
    if n_ranges and BATCH_KEY not in df.columns:
        grid = range_starts(df.sparkSession, kind, lo, batch_size, n_ranges)
        found = _in_one_plan(grid, with_pk_batches(df, pk, batch_size, lo=lo), query, BATCH_KEY, df.columns)
        if found is not None:
            return found
    starts = (lo + number * batch_size for number in range(n_ranges))
    parts = ((F.lit(start).cast(kind), read_batch(df, pk, start, batch_size)) for start in starts)
    return _one_plan_each(parts, df, kind, query, BATCH_KEY)


def sql_per_batch(df: DataFrame, query: str, batch_key: str = BATCH_KEY) -> DataFrame:
    """Like :func:`sql_per_range`, for a frame that is already tagged with batch keys; NULL is a key as well.

    The frame is stored once, so that keys and rows are those of one evaluation.  SQL that Spark cannot plan for all
    keys at once takes one plan per key: distinct keys are numbered, the two zeros as one and all NaN as
    one, the frame is stored partitioned by number, and each run reads its partition.  The stored table lasts
    until :func:`tablemill.operators.staging.drop_scratch`.
    """
    spark, kind = df.sparkSession, df.schema[batch_key].dataType
    snapshot = spark.table(store(df, "batches"))
    # grouping makes -0.0 and 0.0 one key, and so does the join
    distinct = snapshot.groupBy(column_named(batch_key)).agg(F.count(F.lit(1)).alias("_rows")).drop("_rows")
    found = _in_one_plan(distinct, snapshot, query, batch_key, df.columns)
    if found is not None:
        return found
    keys = distinct.select(column_named(batch_key).alias("_of"), F.monotonically_increasing_id().alias("_number"))
    numbered = spark.table(store(keys, "batch_keys"))
    tagged = snapshot.join(numbered, column_named(batch_key).eqNullSafe(F.col("_of"))).drop("_of")
    stored = spark.table(store(tagged, "batches", partition_by="_number"))
    known = numbered.select("_number", point_text(F.col("_of"), kind).alias("_text")).orderBy("_number").toLocalIterator()

    def parts() -> Iterator[tuple[Column, DataFrame]]:
        for row in known:
            key = point_array([row["_text"]], kind)[0]
            if isinstance(kind, T.BinaryType):
                key = F.unhex(key)
            yield key, stored.where(F.col("_number") == row["_number"]).select(*columns(df.columns))

    return _one_plan_each(parts(), df, kind, query, batch_key)
