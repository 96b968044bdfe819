"""The usual chains of steps, from source to target.

Each returns the name or path of what it wrote.  A chain is an ordinary function over
DataFrames: lineage orders the steps, and Spark plans them together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablemill.operators.batches import batch_totals
from tablemill.operators.combine import fan_in
from tablemill.operators.csv_export import export_csv
from tablemill.operators.numbering import ROWS_PER_TASK, number_rows
from tablemill.operators.staging import Stages
from tablemill.operators.tables import insert_select, load_table
from tablemill.operators.targets import write_targets
from tablemill.operators.transform import sql_transform
from tablemill.sources.files import extract_csv
from tablemill.sources.keyranges import BATCH_KEY, batch_rows_bound, pk_bounds, with_pk_batches


def table_to_table(df: DataFrame, target: str, sql: str | None = None) -> str:
    """Extract, transform if asked to, and append to a table."""
    return load_table(df if sql is None else sql_transform(sql, df), target)


def batches_to_table(df: DataFrame, pk: str, batch_size: int, target: str) -> str:
    """Load key-range batches into one table: one job over the tagged frame, not one per batch."""
    return load_table(fan_in(with_pk_batches(df, pk, batch_size), drop=[BATCH_KEY]), target)


def batch_sql_to_table(
    df: DataFrame, pk: str, batch_size: int, sql: str, total_of: str, target: str
) -> str:
    """Tag key ranges, run row-by-row SQL, number and total the rows of each batch, fan in, load.

    ``sql`` keeps ``pk``, ``batch_key`` and ``total_of``.  Numbering and total share the one
    shuffle on the batch key.
    """
    lo = pk_bounds(df, pk).first()["lo"]
    shaped = sql_transform(sql, with_pk_batches(df, pk, batch_size, lo=lo))
    largest = batch_rows_bound(df, pk, batch_size, ROWS_PER_TASK, lo=lo)
    numbered = number_rows(shaped, pk, BATCH_KEY, into="row_in_batch", largest=largest)
    # exact decimals, so that the total does not depend on the order of addition
    total = F.sum(F.col(total_of).cast("decimal(18,2)"))
    totalled = batch_totals(numbered, BATCH_KEY, {"batch_total": total}, largest=largest)
    return load_table(fan_in(totalled), target)


def staged_to_table(spark: SparkSession, df: DataFrame, name: str, sql: str, target: str) -> str:
    """Stage an intermediate under a name, build the target from it, drop the stage."""
    with Stages(spark) as stages:
        stages.put(df, name)
        return load_table(stages.sql(sql), target)


def query_to_table(spark: SparkSession, sql: str, target: str) -> str:
    """Create the target from a query, or insert the query's rows into it."""
    return insert_select(spark, sql, target)


def table_and_csv(df: DataFrame, target: str, path: str) -> dict[str, str]:
    """One result to a table and to CSV."""
    return write_targets(df, {"table": lambda rows: load_table(rows, target), "csv": lambda rows: export_csv(rows, path)})


def csv_to_table(spark: SparkSession, path: str, schema: T.StructType, target: str, multiline: bool | None = None) -> str:
    """Read CSV and replace a table with it."""
    return load_table(extract_csv(spark, path, schema, multiline=multiline), target, recreate=True)


def union_to_table(frames: Sequence[DataFrame], target: str) -> str:
    """Bring several results together and load them."""
    return load_table(fan_in(frames), target)
