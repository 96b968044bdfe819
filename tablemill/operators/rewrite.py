"""Change rows of a table by writing it anew: UPDATE, DELETE and MERGE on plain tables.

The table keeps its format, comments and properties.  A plain table changes over in one statement.  Of a partitioned
table only the partitions that hold changed rows are written; the change is noted on the table before the first
partition changes, and the next change or :func:`finish_change` completes one that a lost driver left half done.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablemill.functions.values import column_named, for_loading, loading_columns, stored_value
from tablemill.operators.combine import conform, join_on
from tablemill.operators.staging import drop_tables, store
from tablemill.operators.tables import properties, quoted, replace_content, set_properties, unset_properties

PENDING = "tablemill.pending"
# Partitions that one statement drops.
DROPPED_AT_ONCE = 1000
ACTION = "_action"
UPDATED, DELETED, INSERTED, KEPT = "update", "delete", "insert", "keep"


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def _as_stored(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Empty text as a partition value is stored as NULL."""
    return df.withColumns({
        f.name: F.when(column_named(f.name) != "", column_named(f.name)) for f in df.schema.fields
        if f.name in parts and isinstance(f.dataType, T.StringType)
    })


def _write(after: DataFrame, table: str, touched: DataFrame | None) -> str:
    """Write the rows ``after`` a change: all, or those of the partitions in ``touched``.

    The rows of these partitions are staged first, since they are read from the files that they replace.
    """
    spark = after.sparkSession
    if touched is None:
        return replace_content(after, table)
    parts = touched.columns
    places = store(_as_stored(touched, parts).distinct(), "touched")
    try:
        rows = store(join_on(_as_stored(after, parts), spark.table(places), parts, "left_semi"), "rewritten")
    except Exception:
        drop_tables(spark, [places])
        raise
    set_properties(spark, table, {PENDING: json.dumps([places, rows])})
    finish_change(spark, table)
    return table


def finish_change(spark: SparkSession, table: str) -> str:
    """Complete a change of a partitioned table that is noted on it; doing so again changes nothing."""
    noted = properties(spark, table).get(PENDING)
    if noted is None:
        return table
    places, rows = json.loads(noted)
    if not spark.catalog.tableExists(places) or not spark.catalog.tableExists(rows):
        raise RuntimeError(f"{table} awaits a change whose rows in {rows} are gone; remove its property {PENDING} to give it up")
    parts, written = spark.table(places).columns, spark.table(rows)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        written.select(*map(column_named, spark.table(table).columns)).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    _drop_emptied(spark, table, join_on(spark.table(places), written.select(*map(column_named, parts)).distinct(), parts, "left_anti"))
    unset_properties(spark, table, [PENDING])
    drop_tables(spark, [places, rows])
    return table


def _drop_emptied(spark: SparkSession, table: str, places: DataFrame) -> None:
    """Drop partitions, many in a statement; the catalog's names of them are their values as text."""
    names = places.columns
    texts = places.select(*[column_named(name).cast("string").alias(f"_{n}") for n, name in enumerate(names)])
    label = ["`" + name.replace("`", "``") + "`" for name in names]
    for group in batched(texts.toLocalIterator(), DROPPED_AT_ONCE):
        specs = [
            "PARTITION (" + ", ".join(f"{key} = {'NULL' if value is None else quoted(value)}" for key, value in zip(label, row)) + ")"
            for row in group
        ]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")


def _touched(rows: DataFrame, parts: Sequence[str], moves: bool = False) -> DataFrame | None:
    return rows.select(*map(column_named, parts)) if parts and not moves else None


def update_rows(spark: SparkSession, table: str, condition: Column, changes: Mapping[str, Column]) -> str:
    """Set columns where the condition is true; all changes see the old values.

    New values are cleaned up as on loading, then cast to the column's type.
    """
    finish_change(spark, table)
    before, parts = spark.table(table), _partitions(spark, table)
    unknown = set(changes) - set(before.columns)
    if unknown:
        raise ValueError(f"no such columns in {table}: {sorted(unknown)}")
    labels = {name: f"_new_{number}" for number, name in enumerate(changes)}
    hit = F.coalesce(condition, F.lit(False))
    marked = before.select("*", hit.alias("_hit"), *[changes[name].alias(label) for name, label in labels.items()])
    loaded = marked.select(*map(column_named, [*before.columns, "_hit"]), *loading_columns(marked, list(labels.values())))
    after = loaded.select(*[
        F.when(F.col("_hit"), F.col(labels[field.name]).cast(field.dataType)).otherwise(column_named(field.name)).alias(field.name)
        if field.name in changes
        else column_named(field.name)
        for field in before.schema.fields
    ])
    return _write(after, table, _touched(before.where(hit), parts, moves=bool(set(parts) & set(changes))))


def delete_rows(spark: SparkSession, table: str, condition: Column) -> str:
    """Remove the rows where the condition is true; a NULL condition keeps the row."""
    finish_change(spark, table)
    before, hit = spark.table(table), F.coalesce(condition, F.lit(False))
    return _write(before.where(~hit), table, _touched(before.where(hit), _partitions(spark, table)))


def upsert(table: str, source: DataFrame, keys: Sequence[str], *, update: Sequence[str] | None = None) -> str:
    """Replace the rows of a table that share a key with the source, and add the others.

    With ``update`` matched rows change in those columns alone.  Otherwise the source's row takes the
    old one's place, and columns that the source lacks become NULL.  Values are cleaned up as on loading.
    A key that occurs twice in the source is an error, and so is a column that the table lacks.  NULL
    keys match nothing, so such source rows are added.
    """
    spark = source.sparkSession
    finish_change(spark, table)
    target, parts = spark.table(table), _partitions(spark, table)
    unknown = sorted(set(source.columns) - set(target.columns) | set(update or ()) - set(source.columns))
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    loaded = for_loading(source)
    columns = [column_named(name) for name in keys]
    present = loaded.dropna(subset=[f"`{name}`" if "." in name else name for name in keys])
    twice = present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"source has several rows for key {twice[0].asDict()}")
    matched = present.select(*columns)
    kept = target.join(matched, list(keys), "left_anti").select(*map(column_named, target.columns))
    if update is None:
        after = kept.unionByName(conform(loaded, target.schema))
    else:
        new = present.select(*columns, *[column_named(name).alias(f"_new_{i}") for i, name in enumerate(update)])
        changed = target.join(new, list(keys)).select(*[
            column_named(f.name) if f.name not in update else F.col(f"_new_{list(update).index(f.name)}").cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ])
        old = target.select(*columns).dropna().distinct()
        added = join_on(loaded, old, list(keys), "left_anti")
        after = kept.unionByName(changed).unionByName(conform(added, target.schema))
    if not parts or not set(parts) <= set(source.columns) or set(parts) & set(update or ()):
        return _write(after, table, None)
    hit = target.join(matched, list(keys), "left_semi")
    places = _touched(hit, parts).unionByName(conform(loaded, target.schema).select(*map(column_named, parts)))
    return _write(after, table, places)


@dataclass(frozen=True)
class Clause:
    """One WHEN of a merge: which rows it is for, what it does, on which condition and to which values."""

    rows: str
    action: str
    condition: Column | None = None
    values: Mapping[str, Column] | None = None


MATCHED, SOURCE_ONLY, TARGET_ONLY = "matched", "source", "target"


def when_matched_update(values: Mapping[str, Column] | None = None, condition: Column | None = None) -> Clause:
    """Set columns of matched rows; without values, all that the source has."""
    return Clause(MATCHED, UPDATED, condition, values)


def when_matched_delete(condition: Column | None = None) -> Clause:
    return Clause(MATCHED, DELETED, condition)


def when_not_matched_insert(values: Mapping[str, Column] | None = None, condition: Column | None = None) -> Clause:
    """Add source rows that match nothing; without values, with all that the source has, and NULL elsewhere."""
    return Clause(SOURCE_ONLY, INSERTED, condition, values)


def when_not_matched_by_source_update(values: Mapping[str, Column], condition: Column | None = None) -> Clause:
    return Clause(TARGET_ONLY, UPDATED, condition, values)


def when_not_matched_by_source_delete(condition: Column | None = None) -> Clause:
    return Clause(TARGET_ONLY, DELETED, condition)


def _joined(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides in full as structs ``target`` and ``source``; NULL keys match nothing.

    Rows without a whole key are spread over all tasks instead of meeting in the one for NULL.
    """
    def side(df: DataFrame, label: str, number: int) -> DataFrame:
        whole = reduce(lambda a, b: a & b, [column_named(name).isNotNull() for name in keys])
        spread = F.when(whole, F.lit(0)).otherwise(F.monotonically_increasing_id() * 2 + number + 1)
        return df.select(
            F.struct(*map(column_named, df.columns)).alias(label), spread.alias(f"_spread_{label}"),
            *[column_named(name).alias(f"_{label}_{n}") for n, name in enumerate(keys)],
        )

    pairs = [F.col(f"_target_{n}") == F.col(f"_source_{n}") for n in range(len(keys))]
    met = reduce(lambda a, b: a & b, pairs, F.col("_spread_target") == F.col("_spread_source"))
    return side(target, "target", 0).join(side(source, "source", 1), met, "full_outer").select("target", "source")


def merge_rows(table: str, source: DataFrame, keys: Sequence[str], clauses: Sequence[Clause]) -> str:
    """MERGE: update, delete and insert by what a join with the source finds, each on its conditions.

    Of the clauses for a row the first whose condition is true acts; a row without one stays as it is, and a source
    row without one is left out.  Conditions and values speak of ``target.<column>`` and ``source.<column>``,
    with the values from before the merge.  Values are cleaned up as on loading and cast to the column's type.

    NULL keys match nothing.  Target rows with equal keys all change; a key that several source rows have is an
    error if a target row has it.  Columns that the table lacks are an error where a clause takes
    all that the source has.  Names are case-sensitive.  There is one join, and what it finds is written
    once: a plain table whole, of a partitioned table the partitions that lose, change or get rows.
    """
    spark = source.sparkSession
    finish_change(spark, table)
    target, parts, keys = spark.table(table), _partitions(spark, table), list(keys)
    fields = {field.name: field for field in target.schema.fields}
    for clause in clauses:
        given = source.columns if clause.values is None and clause.action in (UPDATED, INSERTED) else list(clause.values or ())
        unknown = sorted(set(given) - set(fields))
        if unknown:
            raise ValueError(f"no such columns in {table}: {unknown}")
    columns = [column_named(name) for name in keys]
    several = source.dropna(subset=[f"`{name}`" for name in keys]).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    hit = target.join(several, keys, "left_semi").select(*columns).limit(1).collect() if several.limit(1).collect() else []
    if hit:
        raise ValueError(f"source has several rows for key {hit[0].asDict()}")

    both = _joined(target, source, keys)
    side = F.when(F.col("target").isNull(), SOURCE_ONLY).when(F.col("source").isNull(), TARGET_ONLY).otherwise(MATCHED)
    number = F.lit(None).cast("int")
    for at, clause in reversed(list(enumerate(clauses))):
        holds = (side == clause.rows) & F.coalesce(F.lit(True) if clause.condition is None else clause.condition, F.lit(False))
        number = F.when(holds, at).otherwise(number)
    decided = both.withColumn("_clause", number).where(F.col("target").isNotNull() | F.col("_clause").isNotNull())

    def value(field: T.StructField) -> Column:
        found = F.col("target").getField(field.name)
        for at, clause in enumerate(clauses):
            given = clause.values
            if given is None and clause.action in (UPDATED, INSERTED):
                given = {name: F.col("source").getField(name) for name in source.columns}
            if given and field.name in given:
                new = stored_value(given[field.name].cast(field.dataType), field.dataType).cast(field.dataType)
            elif clause.action == INSERTED:
                new = F.lit(None).cast(field.dataType)
            else:
                continue
            found = F.when(F.col("_clause") == at, new).otherwise(found)
        return found.alias(field.name)

    actions = F.lit(KEPT)
    for at, clause in enumerate(clauses):
        actions = F.when(F.col("_clause") == at, clause.action).otherwise(actions)
    changed = decided.select(
        *[value(field) for field in target.schema.fields], actions.alias(ACTION),
        *[F.col("target").getField(name).alias(f"_before_{n}") for n, name in enumerate(parts)],
    )
    rows = changed.where(F.col(ACTION) != DELETED).select(*map(column_named, fields))
    if not parts:
        return _write(rows, table, None)
    acted = changed.where(F.col(ACTION) != KEPT)
    left = acted.where(F.col(ACTION) != INSERTED).select(*[F.col(f"_before_{n}").alias(name) for n, name in enumerate(parts)])
    places = left.unionByName(acted.where(F.col(ACTION) != DELETED).select(*map(column_named, parts)))
    return _write(rows, table, places)

