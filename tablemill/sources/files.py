"""Tables kept as files: CSV with a header, and Parquet."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablemill.functions.values import column_named, missing_to_null
from tablemill.sources.csv_records import csv_with_breaks

# The spellings that make a CSV column boolean.
TRUTH_WORDS = ("True", "TRUE", "true", "False", "FALSE", "false")


def _inferred(text: DataFrame) -> T.StructType:
    """Column types from the values themselves, in one pass with one result row.

    Whole numbers become BIGINT, other numbers DOUBLE, truth words BOOLEAN; anything
    else, dates and timestamps too, stays text.
    """
    def fits(name: str, test: Column, label: str) -> Column:
        return F.bool_and(F.when(column_named(name).isNotNull(), F.coalesce(test, F.lit(False)))).alias(label)

    tests = []
    for number, name in enumerate(text.columns):
        value = F.trim(column_named(name))
        tests += [
            fits(name, value.rlike(r"^[+-]?\d+$") & value.try_cast("bigint").isNotNull(), f"whole_{number}"),
            fits(name, value.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$"), f"real_{number}"),
            fits(name, value.isin(*TRUTH_WORDS), f"truth_{number}"),
            fits(name, value.rlike(r"^[+-]?\d+$"), f"digits_{number}"),
        ]
    found = text.agg(*tests).first() if tests else ()
    kinds = T.StructType()
    for number, name in enumerate(text.columns):
        whole, real, truth, digits = found[4 * number:4 * number + 4]
        if whole:
            kind = T.LongType()
        elif truth:
            kind = T.BooleanType()
        elif real and not digits:
            kind = T.DoubleType()
        else:
            # a column of whole numbers too long for BIGINT stays text, which keeps every digit
            kind = T.StringType()
        kinds.add(name, kind)
    return kinds


def extract_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    multiline: bool | None = None,
) -> DataFrame:
    """Read CSV with a header line in UTF-8.

    Missing-value words (:data:`tablemill.functions.values.MISSING_WORDS`) read as NULL in
    every column.  Columns are matched to ``schema`` by header name.  In ANSI mode, Spark's
    default, a value that does not parse as its declared type fails the query rather than
    turning into NULL.  Without a schema the types are inferred from all values.

    By default the files are looked through first, line by line in parallel: a line break inside quotes leaves a
    line with an odd number of quotes.  Files without one are split among tasks as lines, others as records
    (:func:`tablemill.sources.csv_records.csv_with_breaks`).  Only files with quotes in the middle of a field are
    read one per task, as all are with ``multiline``; False says that no field holds a line break.
    """
    text = None
    if multiline is None:
        quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
        multiline = not spark.read.text(path).where(quotes % 2 == 1).isEmpty()
        text = csv_with_breaks(spark, path) if multiline else None
    if text is None:
        # enforceSchema off: files whose headers differ are refused instead of read by position
        text = spark.read.options(
            header=True, quote='"', escape='"', multiLine=multiline, encoding="UTF-8", enforceSchema=False
        ).csv(path)
    text = text.select(*[missing_to_null(column_named(name)).alias(name) for name in text.columns])
    if schema is None:
        kinds = _inferred(text)
    elif isinstance(schema, str):
        kinds = T.StructType.fromDDL(schema)
    else:
        kinds = schema

    def typed(field: T.StructField) -> Column:
        value = column_named(field.name)
        if isinstance(field.dataType, T.StringType):
            return value
        if isinstance(field.dataType, T.BinaryType):
            return F.unbase64(value).alias(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.from_json(value, field.dataType).alias(field.name)
        return F.trim(value).cast(field.dataType).alias(field.name)

    return text.select(*[typed(field) for field in kinds.fields])


def extract_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet files."""
    return spark.read.parquet(path)


def table_views(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Make ``folder/<name>.parquet`` readable from SQL as ``<name>``."""
    for name in names:
        extract_parquet(spark, str(PurePosixPath(folder) / f"{name}.parquet") if "://" not in folder
                        else f"{folder.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)
