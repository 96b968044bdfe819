"""Extract the result of a query, whole or tagged with key-range batches."""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tablemill.sources.keyranges import with_pk_batches

_namespace_lock = threading.RLock()


def query_text(spark: SparkSession, query: str | Sequence[str] | None = None, sql_file: str | None = None) -> str:
    """SQL given as text, as a list of lines, or as a file on any file system Spark reads."""
    if bool(query) == bool(sql_file):
        raise ValueError("give exactly one of query and sql_file")
    if sql_file:
        return spark.read.text(sql_file, wholetext=True).first()[0].strip()
    return query if isinstance(query, str) else "\n".join(query)


def extract_sql(
    spark: SparkSession,
    query: str | Sequence[str] | None = None,
    *,
    sql_file: str | None = None,
    args: Mapping[str, Any] | None = None,
    namespace: str | None = None,
    batch_size: int | None = None,
    pk: str | None = None,
) -> DataFrame:
    """Run a SELECT over catalog tables and views.

    ``args`` fills typed parameters (``:name``, ``IDENTIFIER(:name)``).  ``namespace`` is
    the database unqualified names resolve in.  With ``batch_size`` and ``pk`` the
    result carries a ``batch_key`` column, see :func:`with_pk_batches`.
    """
    if (batch_size is None) != (pk is None):
        raise ValueError("batch_size and pk go together")
    text = query_text(spark, query, sql_file)
    if namespace is None:
        result = spark.sql(text, args=dict(args or {}))
    else:
        # spark.sql resolves names at once, so the current database can be put back
        with _namespace_lock:
            before = spark.catalog.currentDatabase()
            spark.catalog.setCurrentDatabase(namespace)
            try:
                result = spark.sql(text, args=dict(args or {}))
            finally:
                spark.catalog.setCurrentDatabase(before)
    return result if pk is None else with_pk_batches(result, pk, batch_size)


def jdbc_options(
    url: str,
    query: str,
    *,
    pk: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options for reading a remote query over JDBC.

    With ``pk`` and its bounds, tasks read disjoint key ranges in parallel.  Spark puts
    NULL keys in the first range and leaves the outer ranges open, so no row is lost.
    """
    options = {"url": url, "fetchsize": str(fetch_size), **properties}
    split = (pk, lower, upper, partitions)
    if all(part is None for part in split):
        return {**options, "query": query}
    if any(part is None for part in split):
        raise ValueError("pk, lower, upper and partitions go together")
    return {
        **options,
        # Spark takes partitioned reads from dbtable, not from query
        "dbtable": f"({query}) AS base",
        "partitionColumn": pk,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def extract_jdbc(spark: SparkSession, url: str, query: str, **options: Any) -> DataFrame:
    """Run a SELECT at a remote database; options as in :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load()
