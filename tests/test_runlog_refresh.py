import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablemill.operators import runlog
from tablemill.operators.runlog import (
    classify_runs,
    latest_per_table,
    min_rows_check,
    newer_than,
    require_min_rows,
    retry_plan,
    stale_tables,
)
from tablemill.operators.tables import load_table
from tablemill.streaming.refresh import REFRESH_BATCH, REFRESH_COLUMNS, _write_batch, compact, refresh

DAY = [dt.datetime(2026, 1, day) for day in range(1, 10)]


def classes(spark, events):
    df = spark.createDataFrame(events, "run_id long, seq long, message string")
    return {r.run_id: r.failure_class for r in classify_runs(df).collect()}


def test_first_telling_event_decides(spark):
    assert classes(spark, [
        (1, 2, "Pod was DELETED"), (1, 5, "Out of Memory"), (1, 1, "started"),
        (2, 3, "evicted: out of memory"), (2, 9, "preempted"),
        (3, 1, "step failed"), (3, 2, None),
        (4, 8, "node failure"), (4, 7, "Cannot allocate memory"),
    ]) == {1: "pod_deleted", 2: "oom", 3: "other", 4: "oom"}


def test_every_text_is_known(spark):
    events = [(i, 1, f"xx {text.title()} yy") for i, text in enumerate(runlog.MEMORY_TEXTS + runlog.POD_TEXTS)]
    assert list(dict(sorted(classes(spark, events).items())).values()) == ["oom"] * 5 + ["pod_deleted"] * 5


def test_classes_come_from_hash_aggregates(spark):
    df = spark.createDataFrame([(1, 1, "x")], "run_id long, seq long, message string")
    plan = classify_runs(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_retry_plan_defaults(spark):
    df = spark.createDataFrame([(1, "oom", 0), (2, "other", 2), (3, "oom", 3), (4, "pod_deleted", 1)], "run_id int, failure_class string, attempt int")
    found = {r.run_id: (r.retry, r.next_attempt, r.delay_seconds, r.memory_factor) for r in retry_plan(df).collect()}
    assert found == {1: (True, 1, 60.0, 2.0), 2: (True, 3, 240.0, 1.0), 3: (False, None, None, None), 4: (True, 2, 120.0, 1.0)}


def test_retry_plan_settings(spark):
    df = spark.createDataFrame([("oom", 0), ("oom", 9)], "failure_class string, attempt int")
    found = retry_plan(df, max_attempts=20, base_delay="1m", factor=3, max_delay="1h", scale_memory=False)
    assert sorted((r.attempt, r.delay_seconds, r.memory_factor) for r in found.collect()) == [(0, 60.0, 1.0), (9, 3600.0, 1.0)]


def events(spark):
    return spark.createDataFrame(
        [("a", DAY[1], 1, "ok"), ("a", DAY[3], 2, "ok"), ("a", DAY[8], 3, "failed"), ("b", DAY[2], 4, "ok"),
         ("c", DAY[5], 5, "ok"), ("b", DAY[2], 6, "ok")],
        "table_name string, ts timestamp_ntz, run_id long, status string",
    )


def test_latest_and_newer(spark, rows):
    latest = latest_per_table(events(spark), "ok")
    assert rows(latest) == [("a", DAY[3], 2), ("b", DAY[2], 6), ("c", DAY[5], 5)]
    assert [r.table_name for r in newer_than(latest, F.lit("2026-01-05").cast("timestamp_ntz")).collect()] == ["c"]
    assert latest_per_table(events(spark)).where("table_name = 'a'").first().run_id == 3


def test_stale_tables(spark):
    latest = latest_per_table(events(spark), "ok")
    edges = spark.createDataFrame(
        # b older than a and c; c newer than all; new never built; d never built, its upstream neither; a has no upstream
        [("b", ["a", "c"]), ("c", ["a", "b"]), ("new", ["a"]), ("d", ["nowhere"]), ("a", [])],
        "table_name string, depends_on array<string>",
    )
    assert sorted(r.table_name for r in stale_tables(edges, latest).collect()) == ["b", "d", "new"]
    one = edges.select("table_name", F.explode("depends_on").alias("depends_on"))
    assert sorted(r.table_name for r in stale_tables(one, latest).collect()) == ["b", "d", "new"]


def test_min_rows(spark, rows):
    datasets = {"few": spark.range(1), "enough": spark.range(2), "none": spark.range(0)}
    assert rows(min_rows_check(datasets, 2)) == [("enough", 2, True), ("few", 1, False), ("none", 0, False)]
    require_min_rows({"enough": spark.range(2)}, 2)
    with pytest.raises(ValueError, match="few has 1 rows"):
        require_min_rows(datasets, 2)


def test_refresh_takes_new_files_only(spark, target, tmp_path):
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    for start in (0, 100):
        spark.range(start, start + 100).write.mode("append").parquet(source)
        refresh(spark, source, spark.range(1).schema, target, progress, sql="SELECT id, id * 2 AS twice FROM input_df WHERE id % 2 = 0")
        assert spark.table(target).count() == (start + 100) // 2
    refresh(spark, source, spark.range(1).schema, target, progress, sql="SELECT id, id * 2 AS twice FROM input_df")
    found = spark.table(target)
    assert found.count() == 100 and found.where("twice <> id * 2").count() == 0
    assert found.select(REFRESH_BATCH).distinct().count() == 2


def test_sql_sees_one_micro_batch(spark, target, tmp_path):
    source = str(tmp_path / "in")
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).coalesce(1).write.mode("append").parquet(source)
    refresh(
        spark, source, spark.range(1).schema, target, str(tmp_path / "progress"), files_per_batch=1,
        transform=lambda df: df.agg(F.count("*").alias("n")),
    )
    assert [r.n for r in spark.table(target).collect()] == [10, 10, 10]


def test_a_batch_that_runs_again_doubles_nothing(spark, target):
    for number in (0, 1, 1, 0):
        _write_batch(spark.range(number * 10, number * 10 + 10), target, "s", number)
    assert sorted(r.id for r in spark.table(target).collect()) == list(range(20))


def test_refresh_settings(spark, target, tmp_path):
    with pytest.raises(ValueError):
        refresh(spark, str(tmp_path), spark.range(1).schema, target, str(tmp_path), sql="SELECT 1", transform=lambda df: df)


def test_table_to_csv_to_table_by_refresh(spark, target, tmp_path):
    """Downstream follows upstream: a table, its CSV export, and a table fed from the CSV."""
    from tablemill.operators.csv_export import export_csv

    first = load_table(spark.range(2).selectExpr("id + 1 AS id", "timestamp_ntz'2026-01-01' AS ts"), target)
    folder = export_csv(spark.table(first), str(tmp_path / "csv"))
    refresh(
        spark, folder, spark.table(first).schema, f"{target}_down", str(tmp_path / "progress"),
        source_format="csv", header="true",
    )
    require_min_rows({"csv-fed": spark.table(f"{target}_down")}, 2)
    assert spark.table(f"{target}_down").drop(*REFRESH_COLUMNS).exceptAll(spark.table(first)).count() == 0


def test_streams_do_not_overwrite_each_other(spark, target, tmp_path):
    schema = spark.range(1).schema
    for name, start in (("a", 0), ("b", 100)):
        spark.range(start, start + 10).write.parquet(str(tmp_path / name))
        refresh(spark, str(tmp_path / name), schema, target, str(tmp_path / f"progress-{name}"))
    assert spark.table(target).count() == 20
    # new progress on an old target appends
    refresh(spark, str(tmp_path / "a"), schema, target, str(tmp_path / "progress-c"))
    assert spark.table(target).count() == 30
    spark.range(200, 210).write.mode("append").parquet(str(tmp_path / "a"))
    refresh(spark, str(tmp_path / "a"), schema, target, str(tmp_path / "progress-a"))
    before = sorted(r.id for r in spark.table(target).collect())
    compact(spark, target)
    assert sorted(r.id for r in spark.table(target).collect()) == before and len(before) == 40
    spark.range(300, 310).write.mode("append").parquet(str(tmp_path / "a"))
    refresh(spark, str(tmp_path / "a"), schema, target, str(tmp_path / "progress-a"))
    assert spark.table(target).count() == 50
    compact(spark, target)
    assert spark.table(target).count() == 50


def test_refresh_refuses_other_tables(spark, target, tmp_path):
    load_table(spark.range(3), target)
    spark.range(3).write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="not a refresh target"):
        refresh(spark, str(tmp_path / "in"), spark.range(1).schema, target, str(tmp_path / "progress"))


def test_a_missing_attempt_is_the_first(spark):
    found = retry_plan(spark.createDataFrame([("r", "oom", None)], "run_id string, failure_class string, attempt int")).first()
    assert (found.retry, found.next_attempt, found.delay_seconds) == (True, 1, 60.0)
