"""Row numbers and running sums, over a whole table or within groups.

A window over one large group, or over none, is one task.  Here such a group is cut into
ranges of the sort key, and each range is its own window group.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tablemill.functions.ranges import point_array, point_text, searched_range, sort_key, with_number_range
from tablemill.functions.values import column_named
from tablemill.operators.staging import store

# Rows one task sorts with ease.
ROWS_PER_TASK = 1_000_000
# Split points are literals of the plan and ride along with every task, so their number and
# size are bounded; a larger table, or one with very long keys, gets larger ranges, whose
# sorts spill.
MAX_RANGES = 10_000
POINT_BYTES = 4 * 1024 * 1024
SAMPLES_PER_RANGE = 50
SHORT_BYTES = 16


def names(given: str | Sequence[str]) -> list[str]:
    return [given] if isinstance(given, str) else list(given)


def columns(given: Sequence[str]) -> list[Column]:
    return [column_named(name) for name in given]


@dataclass(frozen=True)
class GroupSizes:
    largest: int
    total: int
    groups: int
    key_bytes: int


def group_sizes(df: DataFrame, within: str | Sequence[str] = ()) -> GroupSizes:
    """Rows of the largest group, rows in all, number of groups, bytes of the longest key.

    Reads only the grouping columns and combines counts before the shuffle.
    """
    within = names(within)
    counts = df.groupBy(*columns(within)).agg(F.count(F.lit(1)).alias("n"))
    widths = [F.coalesce(F.max(_width(counts.schema[name].dataType, column_named(name))), F.lit(0)) for name in within]
    row = counts.agg(F.max("n"), F.sum("n"), F.count(F.lit(1)), *widths).first()
    return GroupSizes(row[0] or 0, row[1] or 0, row[2], sum(row[3:]))


def _width(kind: T.DataType, value: Column) -> Column:
    if is_short(kind):
        return F.lit(SHORT_BYTES)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(value)
    return F.octet_length(value.cast("string"))


def is_short(kind: T.DataType) -> bool:
    """Whether values take a fixed few bytes, so that a number of rows bounds their size."""
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _ascending(given: Sequence[str]) -> list[Column]:
    return [column_named(name).asc_nulls_last() for name in given]


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_comparable(field.dataType) for field in kind.fields)
    return not isinstance(kind, T.MapType) and kind.typeName() != "variant"


def number_rows(
    df: DataFrame,
    order_by: str | Sequence[str],
    within: str | Sequence[str] = (),
    *,
    into: str = "row_no",
    running: Mapping[str, Column] | None = None,
    tie_break: str | Sequence[str] | None = None,
    largest: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``row_number()`` by ``order_by`` ascending, NULLs last, within groups if given.

    ``running`` adds sums over the rows up to the current one, ``{"so_far": F.col("x")}``.

    Equal keys are told apart by ``tie_break``, by default by all other columns, so that a
    recomputed partition numbers its rows the same way again.

    While no group exceeds ``rows_per_task`` this is a plain window; ``largest`` is an upper
    bound the caller knows, else the groups are counted first.  Otherwise the rows are cut
    at sampled split points into ranges of about that size, numbered range by range, and
    shifted by what precedes their range.  One huge group, or one huge key, thus spreads
    over many tasks.  Full rows are shuffled once either way.  Arrays and structs as keys
    always take the plain window.
    """
    order_by, within, running = names(order_by), names(within), dict(running or {})
    ranges = None
    if largest is None or largest > rows_per_task:
        ranges = cut_into_ranges(df, order_by, within, tie_break=tie_break, rows_per_task=rows_per_task)
    if ranges is None:
        order = _ascending([*order_by, *_ties(df, order_by, within, tie_break)])
        window = Window.partitionBy(*columns(within)).orderBy(*order)
        return df.select("*", *_running(window, into, running))
    return ranges.place(into, running).select(*columns([*df.columns, into, *running]))


def _ties(df: DataFrame, order_by: list[str], within: list[str], tie_break: str | Sequence[str] | None) -> list[str]:
    if tie_break is not None:
        return names(tie_break)
    return [f.name for f in df.schema.fields if f.name not in {*order_by, *within} and _comparable(f.dataType)]


@dataclass(frozen=True)
class Ranges:
    """Rows with the number of their range in ``_range``, in the order that ranges follow."""

    rows: DataFrame
    within: list[str]
    order: list[str]
    arrays: list[Column]
    count: int

    def window(self) -> Window:
        return Window.partitionBy("_range", *columns(self.within)).orderBy(*_ascending(self.order))

    def keys_only(self, order_by: list[str]) -> Ranges:
        """The same with no more than the key columns: equal keys then have no order."""
        narrow = self.rows.select("_range", *columns([*self.within, *order_by]))
        return replace(self, rows=narrow, order=order_by)

    def place(self, into: str, running: Mapping[str, Column]) -> DataFrame:
        """Number each range by itself and add what precedes it; sorted and partitioned by range."""
        # as many partitions as ranges, whatever the session's default
        spread = self.rows.repartition(self.count, "_range", *columns(self.within))
        local = spread.select("*", *_running(self.window(), "_local", {f"_local_{n}": c for n, c in running.items()}))
        match = F.col("_range") == F.col("_offset_range")
        for number, name in enumerate(self.within):
            match &= column_named(name).eqNullSafe(F.col(f"_group_{number}"))
        # at most two rows per range, so bounded as the split points are
        offsets = F.broadcast(_offsets(self.rows, self.within, running, self.arrays))
        kinds = {f.name: f.dataType for f in local.schema.fields}
        sums = [
            # NULL until the first value, as a running sum is
            F.coalesce(
                column_named(f"_local_{name}") + column_named(f"_before_{name}"),
                column_named(f"_local_{name}"),
                column_named(f"_before_{name}"),
            ).cast(kinds[f"_local_{name}"]).alias(name)
            for name in running
        ]
        row_no = F.col("_local") + F.coalesce(F.col("_before"), F.lit(0))
        return local.join(offsets, match, "left").select(*columns(self.rows.columns), row_no.alias(into), *sums)


def cut_into_ranges(
    df: DataFrame,
    order_by: list[str],
    within: list[str],
    *,
    tie_break: str | Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> Ranges | None:
    """Ranges of about ``rows_per_task`` rows by group and key; None if no group is larger."""
    sizes = group_sizes(df, within)
    if sizes.largest > rows_per_task and not _reads_files_alone(df):
        # counts, split points, offsets and places come from several evaluations, which must agree
        df = df.sparkSession.table(store(df, "settled"))
        sizes = group_sizes(df, within)
    keyed, keys = df, [*within, *order_by]
    if sizes.largest <= rows_per_task or not all(_splittable(kind) for kind in _kinds(df, keys)):
        return None
    ties = _ties(df, order_by, within, tie_break)
    by = [*order_by, *([] if tie_break is None else ties)]
    n_ranges = min(math.ceil(sizes.total / rows_per_task), _most_ranges(df, by, sizes.key_bytes))
    points, repeated = _sampled_points(keyed, keys, n_ranges, sizes.total)
    if repeated and ties:
        # One key fills whole ranges, so the tie-break joins the split points.  Any order among
        # equal keys will do by default: there a hash stands in for columns of any width.
        if tie_break is None:
            keyed, keys = df.withColumn("_tie", F.xxhash64(*columns(ties))), [*keys, "_tie"]
        else:
            keys = [*keys, *ties]
        points, repeated = _sampled_points(keyed, keys, n_ranges, sizes.total)
    if repeated and tie_break is None:
        # Whole ranges of rows that are equal in every column: give each stored row a number
        # of its own to sort by.  It is read back from storage, hence stable on recomputing.
        copies = df.sparkSession.table(store(df.withColumn("_copy", F.monotonically_increasing_id()), "copies"))
        return cut_into_ranges(copies, order_by, within, tie_break="_copy", rows_per_task=rows_per_task)

    kinds = _kinds(keyed, keys)
    arrays = [point_array([point[at] for point in points], kind) for at, kind in enumerate(kinds)]
    if not points:
        ranged = keyed.withColumn("_range", F.lit(0))
    elif len(keys) == 1 and isinstance(kinds[0], T.NumericType):
        ranged = with_number_range(keyed, keys[0], [point[0] for point in points], "_range")
    else:
        ranged = keyed.withColumn("_range", searched_range(arrays, len(points), keys, kinds))
    order = list(dict.fromkeys([*keys[len(within):], *ties]))
    return Ranges(ranged, within, order, arrays, len(points) + 1)


def _reads_files_alone(df: DataFrame) -> bool:
    """Whether the frame is files with columns and rows chosen from them, the same at each evaluation."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        if not plan.deterministic():
            return False
        steps = [line.lstrip(" +-:").split(" ")[0] for line in plan.treeString().splitlines()]
    except AttributeError:
        return False
    return {step.split("[")[0] for step in steps if step} <= {"Project", "Filter", "Relation"}


def _running(window: Window, into: str, running: Mapping[str, Column]) -> list[Column]:
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row_no = F.row_number().over(window).cast("bigint").alias(into)
    return [row_no, *[F.sum(value).over(so_far).alias(name) for name, value in running.items()]]


def _kinds(df: DataFrame, keys: list[str]) -> list[T.DataType]:
    return [df.select(column_named(name)).schema[0].dataType for name in keys]


def _splittable(kind: T.DataType) -> bool:
    return is_short(kind) or isinstance(kind, (T.StringType, T.BinaryType))


def _most_ranges(df: DataFrame, order_by: list[str], group_bytes: int) -> int:
    """As many ranges as keep the split points, of the longest key, within bounds."""
    long = [_width(kind, column_named(name)) for name, kind in zip(order_by, _kinds(df, order_by)) if not is_short(kind)]
    longest = df.agg(*[F.max(width) for width in long]).first() if long else ()
    bytes_each = group_bytes + SHORT_BYTES * (len(order_by) - len(long) + 1) + sum(width or 0 for width in longest)
    return max(2, min(MAX_RANGES, POINT_BYTES // bytes_each))


def _sampled_points(
    keyed: DataFrame, keys: list[str], n_ranges: int, total: int
) -> tuple[list[tuple[str | None, ...]], bool]:
    """Up to ``n_ranges - 1`` split points in ascending order, as text, and whether one occurs twice.

    The sample only steers where ranges begin; every row is numbered whatever it holds.
    Its size follows from the number of ranges, not from the table.
    """
    fraction = min(1.0, n_ranges * SAMPLES_PER_RANGE / total)
    sample = keyed.select(sort_key(keys).alias("key")).sample(fraction, seed=11)
    tiles = sample.select("key", F.ntile(n_ranges).over(Window.orderBy("key")).alias("tile"))
    starts = tiles.groupBy("tile").agg(F.min("key").alias("key")).where("tile > 1")
    again = F.col("key").eqNullSafe(F.lag("key").over(Window.orderBy("tile")))
    texts = [point_text(F.col(f"key.value_{at}"), kind).alias(f"_{at}") for at, kind in enumerate(_kinds(keyed, keys))]
    rows = starts.select("tile", again.alias("again"), *texts).orderBy("tile").collect()
    return [tuple(row[2:]) for row in rows], any(row["again"] for row in rows)


def _offsets(
    ranged: DataFrame, within: list[str], running: Mapping[str, Column], arrays: list[Column]
) -> DataFrame:
    """Rows and sums that precede each range, within the group that runs across its start.

    Only a group holding a split point can span ranges, so with groups just those few
    are counted.
    """
    labels = [f"_group_{number}" for number in range(len(within))]
    groups = [column_named(name).alias(label) for name, label in zip(within, labels)]
    values = [value.alias(f"_before_{name}") for name, value in running.items()]
    rows = ranged.select(F.col("_range").alias("_offset_range"), *groups, *values)
    if within:
        crossings = [f"_crossing_{number}" for number in range(len(within))]
        crossing = (
            ranged.sparkSession.range(1)
            .select(*[array.alias(name) for array, name in zip(arrays, crossings)])
            .select(F.explode(F.arrays_zip(*crossings)).alias("point"))
            .select("point.*")
            .distinct()
        )
        match = F.lit(True)
        for name, label, crossed in zip(within, labels, crossings):
            value = F.hex(label) if isinstance(ranged.schema[name].dataType, T.BinaryType) else F.col(label)
            match &= value.eqNullSafe(F.col(crossed))
        # crossing has at most one row per split point
        rows = rows.join(F.broadcast(crossing), match, "left_semi")
    sums = [F.sum(column_named(f"_before_{name}")).alias(f"_before_{name}") for name in running]
    counts = rows.groupBy("_offset_range", *labels).agg(F.count(F.lit(1)).alias("_before"), *sums)
    earlier = Window.partitionBy(*labels).orderBy("_offset_range").rowsBetween(Window.unboundedPreceding, -1)
    summed = [F.sum(column_named(name)).over(earlier).alias(name) for name in counts.columns if name.startswith("_before")]
    return counts.select("_offset_range", *labels, *summed)
