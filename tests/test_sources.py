import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tablemill.sources.keyranges import batch_grid, batch_rows_bound, pk_bounds, read_batch, with_pk_batches
from tablemill.sources.query import extract_jdbc, extract_sql, jdbc_options, query_text

LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def keys(spark, values, kind="bigint"):
    return spark.createDataFrame([(value,) for value in values], f"id {kind}")


def tags(df, size):
    return {row["id"]: row["batch_key"] for row in with_pk_batches(df, "id", size).collect()}


def test_query_text_from_lines_file_and_neither(spark, tmp_path):
    file = tmp_path / "q.sql"
    file.write_text("\nSELECT 1 AS one\n\n", encoding="utf-8")
    assert query_text(spark, ["SELECT 1", "AS one"]) == "SELECT 1\nAS one"
    assert query_text(spark, sql_file=str(file)) == "SELECT 1 AS one"
    for wrong in ({}, {"query": "SELECT 1", "sql_file": str(file)}):
        with pytest.raises(ValueError):
            query_text(spark, **wrong)


def test_extract_with_parameters_and_namespace(spark, target):
    database, name = target.split(".")
    spark.range(5).write.saveAsTable(target)
    found = extract_sql(spark, "SELECT id FROM IDENTIFIER(:t) WHERE id < :k", args={"t": name, "k": 2}, namespace=database)
    assert [row.id for row in found.orderBy("id").collect()] == [0, 1]
    assert spark.catalog.currentDatabase() == "default"
    with pytest.raises(Exception):
        extract_sql(spark, "SELECT * FROM no_such_table", namespace=database)
    assert spark.catalog.currentDatabase() == "default"


def test_extract_in_batches_needs_both_settings(spark):
    for wrong in ({"pk": "id"}, {"batch_size": 5}):
        with pytest.raises(ValueError):
            extract_sql(spark, "SELECT id FROM range(3)", **wrong)
    batched = extract_sql(spark, "SELECT id FROM range(12)", pk="id", batch_size=5)
    assert [tuple(r) for r in batched.groupBy("batch_key").count().orderBy("batch_key").collect()] == [(0, 5), (5, 5), (10, 2)]


def test_bounds_of_nothing(spark):
    assert tuple(pk_bounds(keys(spark, []), "id").first()) == (None, None)
    assert tuple(pk_bounds(keys(spark, [None, None]), "id").first()) == (None, None)


def test_batches_start_at_the_smallest_key_and_drop_null_keys(spark):
    df = keys(spark, [None, -7, -3, 0, 3, 4, 100])
    assert tags(df, 5) == {-7: -7, -3: -7, 0: -2, 3: 3, 4: 3, 100: 98}


def test_batches_of_duplicates_and_one_row(spark):
    df = keys(spark, [4, 4, 4, 9])
    assert with_pk_batches(df, "id", 10).groupBy("batch_key").count().collect()[0]["count"] == 4
    assert tags(keys(spark, [42]), 7) == {42: 42}


def test_batch_size_beyond_the_span(spark):
    assert set(tags(keys(spark, [1, 2, 3]), 10**12).values()) == {1}


def test_empty_input_keeps_its_columns(spark):
    empty = with_pk_batches(keys(spark, [None]), "id", 5)
    assert empty.columns == ["id", "batch_key"] and empty.count() == 0
    assert batch_grid(keys(spark, []), "id", 5).count() == 0


def test_keys_from_one_end_of_bigint_to_the_other(spark):
    size = 2**62
    got = tags(keys(spark, [LONG_MIN, LONG_MIN + size, -1, 0, LONG_MAX]), size)
    assert got == {value: LONG_MIN + (value - LONG_MIN) // size * size for value in got}


def test_small_integer_keys_do_not_overflow(spark):
    assert tags(keys(spark, [-128, 0, 127], "tinyint"), 200) == {-128: -128, 0: -128, 127: 72}


def test_decimal_and_double_keys(spark):
    exact = keys(spark, [decimal.Decimal("0.50"), decimal.Decimal("5.49"), decimal.Decimal("5.50")], "decimal(9,2)")
    assert [float(v) for v in tags(exact, 5).values()] == [0.5, 0.5, 5.5]
    assert sorted(tags(keys(spark, [0.5, 5.25, 5.5, float("nan")], "double"), 5).items()) == [(0.5, 0.5), (5.25, 0.5), (5.5, 5.5)]
    assert batch_grid(exact, "id", 2).count() == 3


def test_keys_must_be_numeric(spark):
    for kind, value in (("string", "a"), ("date", dt.date(2026, 1, 1))):
        with pytest.raises(ValueError):
            with_pk_batches(keys(spark, [value], kind), "id", 5)
    with pytest.raises(ValueError):
        with_pk_batches(keys(spark, [1]), "id", 0)


def test_grid_lists_empty_ranges(spark):
    grid = batch_grid(keys(spark, [0, 1, 22, None]), "id", 5)
    assert [tuple(r) for r in grid.orderBy("batch_key").collect()] == [(0, 2), (5, 0), (10, 0), (15, 0), (20, 1)]


def test_batches_partition_the_rows(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id") % 997 - 300).alias("id"))
    lo, hi = pk_bounds(df, "id").first()
    read = sum(read_batch(df, "id", start, 37).count() for start in range(lo, hi + 1, 37))
    assert read == with_pk_batches(df, "id", 37).count() == 1000
    assert batch_grid(df, "id", 37).agg(F.sum("n_rows")).first()[0] == 1000


def test_one_batch_is_a_pushed_down_range(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = read_batch(stored, "id", 100, 50)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,100)" in plan and "LessThan(id,150)" in plan


def test_bound_on_batch_rows(spark):
    unique = spark.range(10_000).toDF("id")
    assert batch_rows_bound(unique, "id", 10, 1_000) == 500
    hot = unique.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"))
    assert batch_rows_bound(hot, "id", 10, 1_000) > 3_000
    assert batch_rows_bound(keys(spark, []), "id", 10, 1_000) == 0


def test_jdbc_options(spark):
    whole = jdbc_options("jdbc:x", "SELECT 1", user="u")
    assert whole["query"] == "SELECT 1" and whole["user"] == "u" and "dbtable" not in whole
    split = jdbc_options("jdbc:x", "SELECT 1", pk="id", lower=0, upper=9, partitions=4)
    assert split["dbtable"] == "(SELECT 1) AS base" and split["partitionColumn"] == "id" and "query" not in split
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "SELECT 1", pk="id")
    with pytest.raises(Exception, match="(?i)driver"):
        extract_jdbc(spark, "jdbc:nothing://host", "SELECT 1")
