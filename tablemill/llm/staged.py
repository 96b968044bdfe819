"""Intermediate tables of the operators, as Parquet in the folder that driver and executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame

from tablemill.session import drop_path, fresh_path

# Spark then drops the shuffle files of a query that has ended, instead of at some collection of garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Rows that go to Python at once; texts may be long.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_passing: ContextVar[list | None] = ContextVar("passing", default=None)


@contextmanager
def passing() -> Iterator[None]:
    """Tables staged inside are dropped at the end, but for those staged as ``lasting``."""
    tables: list = []
    token = _passing.set(tables)
    try:
        yield
    finally:
        _passing.reset(token)
        for spark, path in tables:
            drop_path(spark, path)


def stage(df: DataFrame, label: str, lasting: bool = False) -> DataFrame:
    """Write a frame once and read it back: what follows neither recomputes it nor loses it with an executor."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if _passing.get() is not None and not lasting:
        _passing.get().append((spark, path))
    settings = {CLEAN_UP: "true", ARROW_ROWS: "1000"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)
