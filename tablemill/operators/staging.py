"""Tables that live for a few steps, and their clean-up."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tablemill.functions.values import column_named
from tablemill.operators.transform import sql_transform
from tablemill.session import application_dir, drop_application_dir

log = logging.getLogger(__name__)


def temp_name(label: str) -> str:
    """A table name that is not taken."""
    return f"{label}_{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession) -> str:
    """A database of this application whose tables lie in its folder."""
    label = "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId.lower())
    name = f"tablemill_{label}"
    if not spark.catalog.databaseExists(name):
        location = f"{application_dir(spark)}/tables".replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def drop_scratch(spark: SparkSession) -> None:
    """Drop everything this application staged: the scratch database, and the folder with files and streaming state."""
    spark.sql(f"DROP DATABASE IF EXISTS {scratch_database(spark)} CASCADE")
    drop_application_dir(spark)


def store(df: DataFrame, label: str, partition_by: str | None = None) -> str:
    """Write a frame once to a new scratch table and return the table's name.

    With ``partition_by`` the rows are brought together by that column first, in files of
    even size: rebalancing merges small partitions and splits a value that fills several.
    """
    table = f"{scratch_database(df.sparkSession)}.{temp_name(label)}"
    if partition_by is None:
        df.write.format("parquet").saveAsTable(table)
    else:
        even = df.hint("rebalance", column_named(partition_by))
        even.write.format("parquet").partitionBy(partition_by).saveAsTable(table)
    return table


def drop_tables(spark: SparkSession, tables: Iterable[str]) -> dict[str, str]:
    """Drop each table if it exists; a failure is logged, returned, and stops no other."""
    failed = {}
    for table in tables:
        try:
            spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:dropped)", args={"dropped": table})
        except Exception as problem:  # noqa: BLE001 - the remaining tables still have to go
            log.error("could not drop %s: %s", table, problem)
            failed[table] = str(problem)
    return failed


class Stages:
    """Named intermediates, dropped when the block ends.

    ``put`` materialises a frame once: later steps see that snapshot, do not recompute it,
    and read it again from storage if executors are lost.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: dict[str, str] = {}
        self._written: list[str] = []

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_: object) -> None:
        drop_tables(self.spark, self._written)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        table = store(df, name)
        self._written.append(table)
        self.tables[name] = table
        return self.spark.table(table)

    def sql(self, query: str, args: Mapping[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
        """SQL that refers to staged frames by the names they were put under."""
        staged = {name: self.spark.table(table) for name, table in self.tables.items()}
        return sql_transform(query, args=args, **{**staged, **frames})
