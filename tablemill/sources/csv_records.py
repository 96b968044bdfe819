"""Records of CSV files that hold line breaks inside quotes, read by many tasks.

Spark reads such files one per task, since a line says nothing about whether it begins a record.  The number of
quotes before it does: lines with an odd number of quotes take turns in opening and closing a field.  So each piece of a
file counts its odd lines, sums over the pieces before give where each piece stands, and within a piece a
running count tells for each line which record it is part of.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tablemill.operators.combine import join_on

# A record whose quotes all stand around whole fields or are doubled inside them.
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
WELL_FORMED = rf"(?s)\A{_FIELD}(?:,{_FIELD})*+\z"
PIECE = ["file", "block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the piece of a file they were read from, and their order in it."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value", (quotes % 2 == 1).alias("odd"),
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, place, record, first)`` of all records; ``first`` marks the one a file begins with.

    A piece is what one task reads of a file, and no more comes together in one; lines of a record
    that spans several meet by the record's number in the file.  Line breaks inside quotes stay as they are.
    """
    lines = _lines(spark, path)
    counted = lines.groupBy(*PIECE).agg(F.sum(F.col("odd").cast("long")).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    pieces = counted.select(*PIECE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("odd_before"))
    inside = Window.partitionBy(*PIECE).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = join_on(lines, pieces, PIECE, "inner").withColumns({
        "odd_before": F.col("odd_before") + F.coalesce(F.sum(F.col("odd").cast("long")).over(inside), F.lit(0)),
        "first": (F.col("block") == 0) & (F.row_number().over(Window.partitionBy(*PIECE).orderBy("place")) == 1),
    })
    alone = (F.col("odd_before") % 2 == 0) & ~F.col("odd")
    single = placed.where(alone).select(*PIECE, "place", F.col("value").alias("record"), "first")
    line = F.struct("block", "place", "value")
    several = placed.where(~alone).groupBy("file", F.floor(F.col("odd_before") / 2).alias("number")).agg(
        F.array_sort(F.collect_list(line)).alias("lines"), F.max("first").alias("first")
    )
    text = F.array_join(F.transform("lines", lambda one: one["value"]), "\n")
    joined = several.select("file", F.col("lines")[0]["block"].alias("block"), F.col("lines")[0]["place"].alias("place"), text.alias("record"), "first")
    whole = single.unionByName(joined).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return whole.where((F.col("record") != "") | F.col("first"))


def csv_with_breaks(spark: SparkSession, path: str) -> DataFrame | None:
    """All columns as text, named by the header, which all files share; None if that is not how the files are made.

    Not so made are files without lines, with differing headers, or with quotes in the middle of a field.
    """
    records = csv_records(spark, path)
    headers = records.where("first").select("record").distinct().limit(2).collect()
    if len(headers) != 1 or not records.where(~F.col("record").rlike(WELL_FORMED)).isEmpty():
        return None
    names = next(csv.reader(io.StringIO(headers[0]["record"].lstrip("﻿"))), [])
    if not names or len({name.lower() for name in names}) < len(names) or not all(names):
        return None
    schema = ", ".join(f"_{n} STRING" for n in range(len(names)))
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    fields = records.where(~F.col("first")).select(F.from_csv("record", schema, options).alias("_of"))
    return fields.select(*[_text(F.col("_of").getField(f"_{n}")).alias(name) for n, name in enumerate(names)])


def _text(value: Column) -> Column:
    return value.cast(T.StringType())
