"""Bring a downstream table up to date with files that arrived upstream."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablemill.functions.values import column_named, for_loading
from tablemill.operators.tables import TABLE_FORMAT, replace_content
from tablemill.operators.transform import sql_transform
from tablemill.session import is_folder, path_exists, read_note, write_note

REFRESH_STREAM = "refresh_stream"
REFRESH_BATCH = "refresh_batch"
REFRESH_COLUMNS = [REFRESH_STREAM, REFRESH_BATCH]
# The number of the partition that compaction folds a stream's finished batches into.
FOLDED = -1


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's own id, made once and kept in its checkpoint folder; no job is run for it."""
    path = f"{checkpoint.rstrip('/')}/refresh_stream"
    if not path_exists(spark, path):
        write_note(spark, path, uuid.uuid4().hex)
    elif is_folder(spark, path):
        # checkpoints of earlier versions
        return spark.read.text(path).first()[0]
    return read_note(spark, path)


def _check_target(spark: SparkSession, target: str) -> None:
    if not spark.catalog.tableExists(target):
        return
    parts = [column.name for column in spark.catalog.listColumns(target) if column.isPartition]
    if parts != REFRESH_COLUMNS:
        raise ValueError(
            f"{target} is not a refresh target: it would have to be partitioned by {REFRESH_COLUMNS}, which refresh "
            "does when it creates a table; load into another table or refresh into a new one"
        )


def _write_batch(rows: DataFrame, target: str, stream: str, number: int) -> None:
    """Write micro-batch ``number`` of a stream as its own partition of the target.

    A batch that runs again after a failure overwrites that partition, so no row is
    doubled or lost, and no other stream has it.
    """
    overwrite_batch(for_loading(rows), target, stream, number)


def overwrite_batch(rows: DataFrame, target: str, stream: str, number: int) -> None:
    """Make rows the partition of a stream and batch number, in a target that is created if missing."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(target):
        schema = T.StructType([
            *rows.schema.fields, T.StructField(REFRESH_STREAM, T.StringType()), T.StructField(REFRESH_BATCH, T.LongType())
        ])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {target} ({schema.toDDL()}) USING {TABLE_FORMAT} PARTITIONED BY ({', '.join(REFRESH_COLUMNS)})")
    columns = ", ".join("`" + name.replace("`", "``") + "`" for name in rows.columns)
    spark.sql(
        f"INSERT OVERWRITE TABLE {target} PARTITION ({REFRESH_STREAM} = '{stream}', {REFRESH_BATCH} = {int(number)}) BY NAME "
        f"SELECT {columns} FROM {{rows}}",
        rows=rows,
    )


def compact(spark: SparkSession, target: str) -> str:
    """Fold the finished batches of each stream into one partition, for fewer files and partitions.

    The latest batch of a stream stays by itself, since only that one can run again.  The rows are
    staged and the table is overwritten from the stage; no stream may run meanwhile.
    """
    rows = spark.table(target)
    latest = rows.groupBy(REFRESH_STREAM).agg(F.max(REFRESH_BATCH).alias("_latest"))
    folded = rows.join(F.broadcast(latest), REFRESH_STREAM).withColumn(
        REFRESH_BATCH, F.when(F.col(REFRESH_BATCH) == F.col("_latest"), F.col(REFRESH_BATCH)).otherwise(F.lit(FOLDED).cast("bigint"))
    )
    return replace_content(folded.select(*map(column_named, rows.columns)), target)


def refresh(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    *,
    sql: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    source_format: str = "parquet",
    files_per_batch: int | None = None,
    **options: str,
) -> str:
    """Process the files of ``source`` not seen before and end; run it again for later ones.

    Each micro-batch goes through ``sql`` (a SELECT over ``input_df``) or ``transform`` and is
    appended to ``target``, which has two extra partition columns, ``refresh_stream`` and
    ``refresh_batch``.  What was processed is kept in ``checkpoint``, a folder that all executors
    share, and so is the stream's id: several sources, each with its own checkpoint, may feed one target,
    and a new checkpoint appends everything again.  A target with other partitions is refused.
    """
    if sql and transform:
        raise ValueError("give sql or transform, not both")

    def one_batch(rows: DataFrame, stream: str, number: int) -> None:
        if sql:
            rows = sql_transform(sql, rows)
        elif transform:
            rows = transform(rows)
        _write_batch(rows, target, stream, number)

    return run_to_end(spark, source, schema, target, checkpoint, one_batch, source_format, files_per_batch, options)


def run_to_end(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    one_batch: Callable[[DataFrame, str, int], None],
    source_format: str,
    files_per_batch: int | None,
    options: Mapping[str, str],
) -> str:
    """Give the new files of ``source`` to ``one_batch``, batch by batch, with the stream's id and the batch's number."""
    _check_target(spark, target)
    stream = _stream_id(spark, checkpoint)
    reader = spark.readStream.format(source_format).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    running = (
        reader.load(source)
        .writeStream.foreachBatch(lambda rows, number: one_batch(rows, stream, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return target
