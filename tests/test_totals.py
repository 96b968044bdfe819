import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablemill.operators.staging import store
from tablemill.operators.tables import ShortLoad, load_at_least, load_table
from tablemill.session import drop_path, read_note, write_note
from tablemill.streaming import refresh as streams
from tablemill.streaming.refresh import overwrite_batch
from tablemill.streaming.totals import (
    RunningTotals,
    average_of,
    count_of,
    distinct_about,
    largest_of,
    latest_of,
    smallest_of,
    total_of,
)

SCHEMA = "k string, v long, at timestamp"
T = [dt.datetime(2026, 1, day) for day in range(1, 10)]


def running(target):
    v, at = F.col("v"), F.col("at")
    return RunningTotals(target, ["k"], {
        "n": count_of(), "n_v": count_of(v), "total": total_of(v), "low": smallest_of(v), "high": largest_of(v),
        "mean": average_of(v), "last": latest_of(v, at), "kinds": distinct_about(v),
    })


def arrive(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def found(spark, totals):
    return {r.k: tuple(r)[1:] for r in totals.totals(spark).collect()}


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


FIRST = [("a", 1, T[0]), ("a", None, T[5]), (None, 7, T[1]), ("b", 2, None)]
SECOND = [("a", 4, T[2]), ("a", 4, T[5]), (None, 9, T[0]), ("c", None, None)]
BOTH = {
    "a": (4, 3, 9, 1, 4, 3.0, 4, 2), None: (2, 2, 16, 7, 9, 8.0, 7, 2), "b": (1, 1, 2, 2, 2, 2.0, None, 1),
    "c": (1, 0, None, None, None, None, None, 0),
}


def test_totals_over_batches(spark, target, tmp_path):
    totals, path, progress = running(target), str(tmp_path / "in"), str(tmp_path / "progress")
    arrive(spark, path, FIRST)
    totals.refresh(spark, path, schema(spark), progress)
    arrive(spark, path, SECOND)
    totals.refresh(spark, path, schema(spark), progress)
    assert found(spark, totals) == BOTH


def test_batch_that_runs_again_counts_once(spark, target, tmp_path):
    totals, path, progress = running(target), str(tmp_path / "in"), str(tmp_path / "progress")
    for rows in (FIRST, SECOND):
        arrive(spark, path, rows)
        totals.refresh(spark, path, schema(spark), progress)
    drop_path(spark, f"{progress}/commits/1")
    totals.refresh(spark, path, schema(spark), progress)
    assert found(spark, totals) == BOTH


def test_fold_keeps_the_totals_and_the_latest_batch(spark, target, tmp_path):
    totals, path, progress = running(target), str(tmp_path / "in"), str(tmp_path / "progress")
    for rows in (FIRST, SECOND, [("a", 100, T[8])], [("d", 5, T[0])]):
        arrive(spark, path, rows)
        totals.refresh(spark, path, schema(spark), progress)
    before = found(spark, totals)
    totals.fold(spark)
    assert list(totals._partitions(spark).values()) == [[-3, 3]]
    assert found(spark, totals) == before
    totals.fold(spark)
    assert found(spark, totals) == before
    arrive(spark, path, [("d", 6, T[1])])
    totals.refresh(spark, path, schema(spark), progress)
    totals.fold(spark)
    assert list(totals._partitions(spark).values()) == [[-4, 4]]
    assert found(spark, totals)["d"][:3] == (2, 2, 11) and found(spark, totals)["a"] == before["a"]


def test_fold_that_was_cut_off_counts_nothing_twice(spark, target, tmp_path):
    totals, path, progress = running(target), str(tmp_path / "in"), str(tmp_path / "progress")
    for rows in (FIRST, SECOND, []):
        arrive(spark, path, rows or [("z", 1, T[0])])
        totals.refresh(spark, path, schema(spark), progress)
    before, (stream, _) = found(spark, totals), next(iter(totals._partitions(spark).items()))
    merged = totals._merged(totals._counting(spark).where("refresh_batch <= 1"))
    types = {f.name: f.dataType for f in spark.table(target).schema.fields}
    staged = store(merged.select(*[F.col(c).cast(types[c]).alias(c) for c in merged.columns]), "folded")
    overwrite_batch(spark.table(staged), target, stream, -2)
    assert sorted(totals._partitions(spark)[stream]) == [-2, 0, 1, 2]
    assert found(spark, totals) == before
    totals.fold(spark)
    assert sorted(totals._partitions(spark)[stream]) == [-2, 2]
    assert found(spark, totals) == before


def test_two_sources_decimals_and_sql(spark, target, tmp_path):
    totals = RunningTotals(target, ["k"], {"total": total_of(F.col("v").cast("decimal(10,2)"))})
    for name, rows in (("one", FIRST), ("two", SECOND)):
        arrive(spark, str(tmp_path / name), rows)
        totals.refresh(spark, str(tmp_path / name), schema(spark), str(tmp_path / f"p-{name}"), sql="SELECT * FROM input_df WHERE k <> 'c'")
    assert found(spark, totals) == {"a": (Decimal("9.00"),), "b": (Decimal("2.00"),)}


def test_nothing_has_arrived(spark, target, tmp_path):
    totals, path = running(target), str(tmp_path / "in")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    totals.refresh(spark, path, schema(spark), str(tmp_path / "progress"))
    assert found(spark, totals) == {} if spark.catalog.tableExists(target) else True


def test_stream_id_without_jobs(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("stream-id", "")
    first = streams._stream_id(spark, str(tmp_path / "progress"))
    assert streams._stream_id(spark, str(tmp_path / "progress")) == first and len(first) == 32
    assert tracker.getJobIdsForGroup("stream-id") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_stream_id_of_an_earlier_version(spark, tmp_path):
    spark.createDataFrame([("abc",)], "value string").coalesce(1).write.text(str(tmp_path / "progress" / "refresh_stream"))
    assert streams._stream_id(spark, str(tmp_path / "progress")) == "abc"


def test_note_is_written_once(spark, tmp_path):
    path = str(tmp_path / "note")
    write_note(spark, path, "one")
    write_note(spark, path, "two")
    assert read_note(spark, path) == "one"


def test_load_at_least(spark, target, rows):
    df = spark.range(10)
    assert load_at_least(df, target, 10) == 10
    assert load_at_least(df, target, 10) == 10
    assert spark.table(target).count() == 20
    assert load_at_least(df, target, 1, recreate=True) == 10


@pytest.mark.parametrize("new", ["range(3)", "range(0)", "VALUES ('x')"])
@pytest.mark.parametrize("partition_by", [[], ["id"]])
def test_short_load_leaves_the_catalog_as_it_was(spark, target, new, partition_by):
    df = spark.sql(f"SELECT * FROM {new}").toDF("id")
    with pytest.raises(ShortLoad, match="needs 5"):
        load_at_least(df, target, 5, partition_by=partition_by)
    assert not spark.catalog.tableExists(target)
    load_table(spark.range(10).selectExpr("id", "id AS v"), target)
    with pytest.raises(ShortLoad):
        load_at_least(df, target, 5, recreate=True, partition_by=partition_by)
    assert spark.table(target).count() == 10
    name = target.split(".")[1]
    left = [t.tableName for t in spark.sql(f"SHOW TABLES IN {target.split('.')[0]} LIKE '{name}*'").collect()]
    assert left == [name]


def test_count_comes_from_the_write(spark, target):
    spark.sparkContext.setJobGroup("checked-load", "")
    load_at_least(spark.range(0, 1000, 1, 4), target, 10)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("checked-load")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
