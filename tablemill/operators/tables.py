"""Load frames and query results into catalog tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tablemill.functions.values import column_named, for_loading
from tablemill.operators.staging import drop_tables, store
from tablemill.session import drop_path

TABLE_FORMAT = "parquet"
# Properties that this module keeps on tables of its own making.
FORMER = "tablemill.former"
ASIDE_OF = "tablemill.aside_of"
PARTITION_BY = "tablemill.partition_by"


def quoted(text: str) -> str:
    """Text as a literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_properties(spark: SparkSession, table: str, values: Mapping[str, str]) -> None:
    listed = ", ".join(f"{quoted(key)} = {quoted(value)}" for key, value in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def unset_properties(spark: SparkSession, table: str, names: Sequence[str]) -> None:
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({', '.join(map(quoted, names))})")


def described(spark: SparkSession, table: str) -> dict[str, str]:
    """Location, provider, type and so on, by the names that DESCRIBE gives them."""
    return {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _aside(spark: SparkSession, table: str) -> str | None:
    """The table that holds the content of ``table`` while a replacement is under way, by its property alone."""
    database, _, name = table.rpartition(".")
    place = f" IN {database}" if database else ""
    for row in spark.sql(f"SHOW TABLES{place} LIKE '{name.lower()}_aside_*'").collect():
        found = f"{database}.{row['tableName']}" if database else row["tableName"]
        if not row["isTemporary"] and properties(spark, found).get(ASIDE_OF) == table.lower():
            return found
    return None


def finish_replacement(spark: SparkSession, table: str) -> None:
    """Bring a table back whose replacement a lost driver left half done.

    Only a table that a replacement put aside for this very name is touched, which its property tells.
    """
    if spark.catalog.tableExists(table):
        return
    aside = _aside(spark, table)
    if aside is None:
        return
    partition_by = properties(spark, aside).get(PARTITION_BY)
    if partition_by is None:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
        unset_properties(spark, table, [ASIDE_OF])
    else:
        _write_table(spark.table(aside), table, json.loads(partition_by))
        drop_tables(spark, [aside])


def _write_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    df.write.format(TABLE_FORMAT).partitionBy(*partition_by).saveAsTable(table)


def _aside_name(table: str) -> str:
    return f"{table}_aside_{uuid.uuid4().hex}"


def is_partitioned(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and any(column.isPartition for column in spark.catalog.listColumns(table))


def _switch(spark: SparkSession, table: str, folder: str) -> None:
    """Make a folder the content of a table, in one statement of the catalog.

    The folder that was its content until now stays for readers that have begun, and goes with the next switch.
    """
    known, location = properties(spark, table), described(spark, table)["Location"]
    spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(folder)}")
    set_properties(spark, table, {FORMER: location})
    if known.get(FORMER):
        drop_path(spark, known[FORMER])


def drop_former(spark: SparkSession, table: str) -> None:
    """Remove the former content of a table that readers may still use."""
    former = properties(spark, table).get(FORMER)
    if former:
        unset_properties(spark, table, [FORMER])
        drop_path(spark, former)


def _beside(spark: SparkSession, table: str) -> str:
    """An unused folder beside the place that the catalog gives a table of this name."""
    database, _, name = table.rpartition(".")
    root = spark.sql(f"DESCRIBE DATABASE {database or spark.catalog.currentDatabase()}").where("info_name = 'Location'").first()[1]
    return f"{root.rstrip('/')}/{name.strip('`').lower()}_content_{uuid.uuid4().hex}"


def _same_columns(df: DataFrame, spark: SparkSession, table: str) -> bool:
    shape = lambda frame: [(f.name.lower(), f.dataType.simpleString()) for f in frame.schema.fields]
    return shape(df) == shape(spark.table(table))


def replace_table(
    df: DataFrame, table: str, *, partition_by: Sequence[str] = (), check: Callable[[], None] | None = None
) -> str:
    """Make the frame the whole table, which the frame itself may read.

    The rows are written first, so a failed job leaves the old content in place.  A table that keeps its
    columns then takes the new folder in one statement: readers find either content and never none.

    Where columns change, names do: the old table is put aside under another name and the new one takes its
    place, so for a moment it is missing.  Partitioned tables are not renamed, since catalogs may
    leave their partitions at the old place; their rows are written to a table aside, and the table is made anew
    from it.  A driver lost meanwhile is made good by the next load (:func:`finish_replacement`).

    ``check`` is called when the rows are written and before they become the table; where it raises, they go
    and the table stays as it was.
    """
    spark = df.sparkSession
    finish_replacement(spark, table)
    exists = spark.catalog.tableExists(table)
    if partition_by or is_partitioned(spark, table):
        aside = _aside_name(table)
        _write_table(df, aside)
        _checked(check, lambda: drop_tables(spark, [aside]))
        set_properties(spark, aside, {ASIDE_OF: table.lower(), PARTITION_BY: json.dumps(list(partition_by))})
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        _write_table(spark.table(aside), table, partition_by)
        drop_tables(spark, [aside])
    elif exists and described(spark, table).get("Provider") == TABLE_FORMAT and _same_columns(df, spark, table):
        folder = _beside(spark, table)
        df.write.format(TABLE_FORMAT).save(folder)
        _checked(check, lambda: drop_path(spark, folder))
        _switch(spark, table, folder)
    elif exists:
        fresh, aside = f"{table}_new_{uuid.uuid4().hex}", _aside_name(table)
        _write_table(df, fresh)
        _checked(check, lambda: drop_tables(spark, [fresh]))
        drop_former(spark, table)
        set_properties(spark, table, {ASIDE_OF: table.lower()})
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        try:
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        except Exception:
            finish_replacement(spark, table)
            raise
        drop_tables(spark, [aside])
    else:
        create_table(df, table)
        _checked(check, lambda: drop_tables(spark, [table]))
    return table


def _checked(check: Callable[[], None] | None, undo: Callable[[], object]) -> None:
    if check is None:
        return
    try:
        check()
    except Exception:
        undo()
        raise


def create_table(df: DataFrame, table: str, *, partition_by: Sequence[str] = ()) -> str:
    """Make a table that does not exist from a frame."""
    _write_table(df, table, partition_by)
    return table


def replace_content(df: DataFrame, table: str) -> str:
    """Like :func:`replace_table`, for rows of the table's own columns: partitions, format, comments and
    properties stay as they are.  A partitioned table is overwritten from a stage."""
    spark = df.sparkSession
    columns = [column_named(name) for name in spark.table(table).columns]
    if is_partitioned(spark, table):
        staged = store(df, "replacement")
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        try:
            spark.table(staged).select(*columns).write.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        drop_tables(spark, [staged])
        return table
    # a table over a folder of its own has the format and options of this one, and leaves its files when dropped
    fresh, folder = f"{table}_new_{uuid.uuid4().hex}", _beside(spark, table)
    spark.sql(f"CREATE TABLE {fresh} LIKE {table} LOCATION {quoted(folder)}")
    try:
        df.select(*columns).write.insertInto(fresh)
    except Exception:
        drop_path(spark, folder)
        raise
    finally:
        drop_tables(spark, [fresh])
    _switch(spark, table, folder)
    return table


def load_table(df: DataFrame, table: str, *, recreate: bool = False, partition_by: Sequence[str] = ()) -> str:
    """Append a frame to a table, creating the table from the frame's schema if missing.

    Columns match by name; table columns the frame lacks are filled with NULL, and frame
    columns the table lacks are an error.  ``recreate`` replaces table and content.  A table that
    is made here is partitioned by ``partition_by``.
    Values are stored as :func:`tablemill.functions.values.for_loading` describes.
    """
    spark = df.sparkSession
    rows = for_loading(df)
    if recreate:
        return replace_table(rows, table, partition_by=partition_by)
    finish_replacement(spark, table)
    if spark.catalog.tableExists(table):
        spark.sql("INSERT INTO IDENTIFIER(:target) BY NAME SELECT * FROM {rows}", args={"target": table}, rows=rows)
    else:
        create_table(rows, table, partition_by=partition_by)
    return table


class ShortLoad(ValueError):
    """A load wrote fewer rows than it should."""


def load_at_least(
    df: DataFrame, table: str, at_least: int, *, recreate: bool = False, partition_by: Sequence[str] = ()
) -> int:
    """:func:`load_table` that fails if fewer rows than ``at_least`` are written, and returns how many were.

    Rows are counted while they are written, by an observation, so nothing is read twice.  With ``recreate``, and for a table
    that is missing, a short load leaves the catalog as it was.  An append is told after the fact: its rows stay.
    """
    spark, seen = df.sparkSession, Observation(f"written_{uuid.uuid4().hex}")
    rows = for_loading(df).observe(seen, F.count(F.lit(1)).alias("n_rows"))

    def written() -> int:
        return seen.get.get("n_rows", 0)

    def check() -> None:
        if written() < at_least:
            raise ShortLoad(f"{table} got {written()} rows, needs {at_least}")

    finish_replacement(spark, table)
    if recreate or not spark.catalog.tableExists(table):
        replace_table(rows, table, partition_by=partition_by, check=check)
    else:
        spark.sql("INSERT INTO IDENTIFIER(:target) BY NAME SELECT * FROM {rows}", args={"target": table}, rows=rows)
        check()
    return written()


def insert_select(spark: SparkSession, query: str, target: str, args: Mapping[str, Any] | None = None) -> str:
    """``INSERT INTO target <query>`` by column position, or create the target from the query."""
    if spark.catalog.tableExists(target):
        statement = f"INSERT INTO {target} {query}"
    else:
        statement = f"CREATE TABLE {target} USING {TABLE_FORMAT} AS {query}"
    spark.sql(statement, args=dict(args or {}))
    return target


def run_statement(spark: SparkSession, statement: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run any statement as it is; commands run at once, a query's rows come when asked for."""
    return spark.sql(statement, args=dict(args or {}))
