"""Running totals per key over files that arrive, of which each batch counts once however often it runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablemill.functions.values import column_named
from tablemill.operators.staging import drop_tables, store
from tablemill.operators.tables import quoted
from tablemill.operators.transform import sql_transform
from tablemill.streaming.refresh import REFRESH_BATCH, REFRESH_STREAM, overwrite_batch, run_to_end


@dataclass(frozen=True)
class Running:
    """An aggregate whose states can be merged.

    ``states`` has for each part of the state an aggregate over rows, and the aggregate that merges such states;
    ``result`` makes the value of the merged parts, in their order.
    """

    states: tuple[tuple[Column, Callable[[Column], Column]], ...]
    result: Callable[..., Column] = lambda state: state


def count_of(value: Column | None = None) -> Running:
    """Rows, or values that are not NULL."""
    return Running(((F.count(F.lit(1) if value is None else value), F.sum),))


def total_of(value: Column) -> Running:
    """A sum; decimals and whole numbers do not depend on the order of batches, floating ones do in their last digits."""
    return Running(((F.sum(value), F.sum),))


def smallest_of(value: Column) -> Running:
    return Running(((F.min(value), F.min),))


def largest_of(value: Column) -> Running:
    return Running(((F.max(value), F.max),))


def average_of(value: Column) -> Running:
    """The mean of values that are not NULL; NULL without any."""
    return Running(((F.sum(value), F.sum), (F.count(value), F.sum)), lambda total, n: F.try_divide(total, n))


def latest_of(value: Column, at: Column) -> Running:
    """The value at the latest moment that is not NULL; of several at that moment the largest."""
    last = F.when(at.isNotNull(), F.struct(at.alias("at"), value.alias("value")))
    return Running(((F.max(last), F.max),), lambda state: state["value"])


def distinct_about(value: Column) -> Running:
    """About how many different values there are, by mergeable sketches of bounded size (HyperLogLog)."""
    return Running(((F.hll_sketch_agg(value), F.hll_union_agg),), F.hll_sketch_estimate)


def _covers(number: int) -> int:
    """A folded partition has a number below 0, which tells the last batch in it."""
    return -number - 1


@dataclass(frozen=True)
class RunningTotals:
    """Aggregates per key of everything that has arrived, in the table ``target``.

    The table holds states: per stream and batch one row for each key of the batch.  A batch that runs again after a
    failure overwrites its own partition, so it is not added twice.  ``totals`` merges the states; ``fold``
    keeps their number small.  Rows with a NULL in a key are a group as in GROUP BY.
    """

    target: str
    keys: Sequence[str]
    values: Mapping[str, Running]

    def _state_names(self, name: str) -> list[str]:
        return [f"{name}__{part}" for part in range(len(self.values[name].states))]

    def _key_columns(self) -> list[Column]:
        return [column_named(key) for key in self.keys]

    def states_of(self, rows: DataFrame) -> DataFrame:
        """A batch as one row of states per key."""
        found = [
            state.alias(label)
            for name, running in self.values.items()
            for label, (state, _) in zip(self._state_names(name), running.states)
        ]
        return rows.groupBy(*self._key_columns()).agg(*found)

    def _merged(self, states: DataFrame) -> DataFrame:
        merged = [
            merge(column_named(label)).alias(label)
            for name, running in self.values.items()
            for label, (_, merge) in zip(self._state_names(name), running.states)
        ]
        return states.groupBy(*self._key_columns()).agg(*merged)

    def refresh(
        self,
        spark: SparkSession,
        source: str,
        schema: T.StructType,
        checkpoint: str,
        *,
        sql: str | None = None,
        source_format: str = "parquet",
        files_per_batch: int | None = None,
        **options: str,
    ) -> str:
        """Add the files of ``source`` not seen before and end; ``sql`` (a SELECT over ``input_df``) shapes rows first.

        Checkpoints and several sources work as in :func:`tablemill.streaming.refresh.refresh`.
        """
        def one_batch(rows: DataFrame, stream: str, number: int) -> None:
            overwrite_batch(self.states_of(sql_transform(sql, rows) if sql else rows), self.target, stream, number)

        return run_to_end(spark, source, schema, self.target, checkpoint, one_batch, source_format, files_per_batch, options)

    def _partitions(self, spark: SparkSession) -> dict[str, list[int]]:
        """The partitions of each stream, from the catalog; folding bounds their number."""
        found: dict[str, list[int]] = {}
        for row in spark.sql(f"SHOW PARTITIONS {self.target}").collect():
            stream, number = (part.split("=", 1)[1] for part in row["partition"].split("/"))
            found.setdefault(stream, []).append(int(number))
        return found

    def _counting(self, spark: SparkSession) -> DataFrame:
        """The states that count: of each stream its furthest folded partition and the batches after it.

        A fold that was ended between its write and its clean-up leaves batches that are also in a folded partition; these do
        not count.
        """
        rows, chosen = spark.table(self.target), []
        for stream, numbers in self._partitions(spark).items():
            folded = min(numbers)
            own = F.col(REFRESH_STREAM) == stream
            if folded < 0:
                own &= (F.col(REFRESH_BATCH) == folded) | (F.col(REFRESH_BATCH) > _covers(folded))
            chosen.append(own)
        return rows.where(reduce(Column.__or__, chosen)) if chosen else rows.limit(0)

    def totals(self, spark: SparkSession) -> DataFrame:
        """The keys and the value of each aggregate over all that has arrived."""
        results = [
            running.result(*map(column_named, self._state_names(name))).alias(name) for name, running in self.values.items()
        ]
        return self._merged(self._counting(spark)).select(*self._key_columns(), *results)

    def fold(self, spark: SparkSession) -> None:
        """Merge the states of each stream's finished batches into one partition and drop those it replaces.

        The latest batch stays by itself, since only that one can run again.  The new partition's number says which
        batches are in it, so whoever reads between the write and the drop counts each batch once.  Only the folded
        states are written, not the table.  No stream may run meanwhile.
        """
        for stream, numbers in self._partitions(spark).items():
            until = max(numbers) - 1
            number = -until - 1
            if until >= 0 and number not in numbers:
                counting = self._counting(spark).where((F.col(REFRESH_STREAM) == stream) & (F.col(REFRESH_BATCH) <= until))
                types = {field.name: field.dataType for field in counting.schema.fields}
                merged = self._merged(counting)
                kept = merged.select(*[column_named(name).cast(types[name]).alias(name) for name in merged.columns])
                # a table cannot be read and overwritten at once
                staged = store(kept, "folded")
                overwrite_batch(spark.table(staged), self.target, stream, number)
                drop_tables(spark, [staged])
            if until >= 0:
                gone = [old for old in numbers if old != number and old <= until]
                parts = ", ".join(f"PARTITION ({REFRESH_STREAM} = {quoted(stream)}, {REFRESH_BATCH} = {old})" for old in gone)
                if parts:
                    spark.sql(f"ALTER TABLE {self.target} DROP IF EXISTS {parts}")
