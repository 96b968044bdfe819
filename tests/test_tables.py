import datetime as dt
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablemill.operators.csv_export import export_csv
from tablemill.operators.rewrite import delete_rows, update_rows, upsert
from tablemill.operators.staging import Stages, drop_tables, scratch_database, store, temp_name
from tablemill.operators.tables import insert_select, load_table, replace_table, run_statement
from tablemill.operators.targets import write_targets
from tablemill.plans.flows import csv_to_table, table_and_csv
from tablemill.sources.files import extract_csv


def fixture(spark):
    """The hundred-row table the sample flows move: id 1..100, ts a second apart."""
    return spark.range(1, 101).selectExpr("id", "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts")


def table_names(spark):
    return {item.name for item in spark.catalog.listTables(scratch_database(spark))}


def test_create_then_append(spark, target):
    assert load_table(fixture(spark), target) == target
    assert [f.dataType.simpleString() for f in spark.table(target).schema] == ["bigint", "timestamp_ntz"]
    load_table(fixture(spark), target)
    assert Counter(r.id for r in spark.table(target).collect()) == {i: 2 for i in range(1, 101)}
    assert spark.table(target).agg(F.max("ts")).first()[0] == dt.datetime(2026, 1, 1, 0, 1, 40)


def test_columns_match_by_name(spark, target, rows):
    load_table(spark.createDataFrame([(1, "a", 0.5)], "id int, name string, x float"), target)
    load_table(spark.createDataFrame([("b", 2)], "name string, id int"), target)
    assert rows(spark.table(target)) == [(1, "a", 0.5), (2, "b", None)]
    with pytest.raises(Exception):
        load_table(spark.createDataFrame([(3, 1)], "id int, other int"), target)
    assert spark.table(target).count() == 2


def test_recreate_changes_the_schema(spark, target):
    load_table(spark.range(5), target)
    load_table(spark.createDataFrame([("x",)], "name string"), target, recreate=True)
    assert spark.table(target).collect()[0].asDict() == {"name": "x"}


def test_recreate_of_a_missing_table(spark, target):
    load_table(spark.range(5), target, recreate=True)
    assert spark.table(target).count() == 5


def test_a_failed_recreate_leaves_the_table(spark, target):
    load_table(spark.range(5), target)
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("id"))
    with pytest.raises(Exception, match="broken"):
        load_table(bad, target, recreate=True)
    assert spark.table(target).count() == 5


def test_replace_leaves_no_other_tables(spark, target):
    load_table(spark.range(5), target)
    before = table_names(spark)
    replace_table(spark.table(target).union(spark.table(target)), target)
    assert spark.table(target).count() == 10 and table_names(spark) == before


def test_failed_change_of_names_is_undone(spark, target, monkeypatch):
    load_table(spark.range(5), target)
    real = type(spark).sql

    def broken(self, text, *args, **kwargs):
        if "_new_" in text and "RENAME" in text:
            raise RuntimeError("no rename")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", broken)
    with pytest.raises(RuntimeError):
        replace_table(spark.range(2).withColumnRenamed("id", "n"), target)
    assert spark.table(target).count() == 5 and spark.table(target).columns == ["id"]


def test_appending_a_table_to_itself(spark, target):
    load_table(spark.range(5), target)
    load_table(spark.table(target), target)
    assert spark.table(target).count() == 10


def test_empty_frame_creates_the_table(spark, target):
    load_table(spark.range(0), target)
    assert spark.catalog.tableExists(target) and spark.table(target).count() == 0


def test_insert_select_goes_by_position(spark, target, rows):
    insert_select(spark, "SELECT 1 AS a, 2 AS b", target)
    insert_select(spark, "SELECT 3 AS b, :n AS a", target, {"n": 4})
    insert_select(spark, "WITH c AS (SELECT 5 AS x, 6 AS y) SELECT * FROM c", target)
    assert rows(spark.table(target)) == [(1, 2), (3, 4), (5, 6)]


def test_statements_without_target(spark, target):
    assert run_statement(spark, "SELECT :n AS n", {"n": 7}).first().n == 7
    run_statement(spark, f"CREATE TABLE {target} (n INT) USING parquet")
    for asked in (f"DESCRIBE TABLE {target}", f"SHOW TABLES IN {scratch_database(spark)}", "EXPLAIN SELECT 1", "SHOW DATABASES"):
        assert run_statement(spark, asked).count() > 0
    run_statement(spark, f"DROP TABLE {target}")
    assert not spark.catalog.tableExists(target)


def test_temp_names(spark):
    assert temp_name("t") != temp_name("t") and temp_name("t").startswith("t_")


def test_rewrites_keep_the_layout(spark, target):
    spark.sql(f"""CREATE TABLE {target} (id BIGINT COMMENT 'the key', v DOUBLE, at TIMESTAMP_NTZ, d STRING) USING parquet
        PARTITIONED BY (d) COMMENT 'about it' TBLPROPERTIES ('mine' = 'yes')""")
    spark.sql(f"INSERT INTO {target} VALUES (1, 1, NULL, 'a'), (2, 2, NULL, 'b'), (3, 3, NULL, NULL), (4, 4, NULL, 'c')")
    untouched = {f for f in spark.table(target).where("d = 'a'").inputFiles()}
    update_rows(spark, target, F.col("id") >= 2, {"v": F.lit(float("nan")), "at": F.expr("timestamp_ntz'2026-01-01 00:00:00.123456'")})
    delete_rows(spark, target, F.col("d").isNull() | (F.col("d") == "c"))
    assert {f for f in spark.table(target).where("d = 'a'").inputFiles()} == untouched
    upsert(target, spark.createDataFrame([(1, 9.0, "a"), (7, 7.0, "z")], "id long, v double, d string"), ["id"])
    assert sorted((r.id, r.v, str(r["at"]), r.d) for r in spark.table(target).collect()) == [
        (1, 9.0, "None", "a"), (2, None, "2026-01-01 00:00:00.123000", "b"), (7, 7.0, "None", "z")]
    # a change that moves rows to another partition writes the whole table
    update_rows(spark, target, F.col("id") == 2, {"d": F.lit("a")})
    assert sorted((r.id, r.d) for r in spark.table(target).collect()) == [(1, "a"), (2, "a"), (7, "z")]
    about = {r["col_name"]: (r["data_type"], r["comment"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()}
    assert about["id"][1] == "the key" and about["Comment"][0] == "about it" and "# Partition Information" in about
    assert spark.sql(f"SHOW TBLPROPERTIES {target} ('mine')").first()["value"] == "yes"


def test_upsert_of_chosen_columns(spark, target):
    load_table(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, name string, v double"), target)
    source = spark.createDataFrame([(2, 9.0), (3, float("nan")), (None, 4.0)], "id long, v double")
    upsert(target, source, ["id"], update=["v"])
    assert sorted(map(tuple, spark.table(target).collect()), key=str) == [(1, "a", 1.0), (2, "b", 9.0), (3, None, None), (None, None, 4.0)]
    with pytest.raises(ValueError, match="no such columns"):
        upsert(target, source.withColumn("other", F.lit(1)), ["id"])


def test_a_lost_name_is_found_again(spark, target):
    load_table(spark.range(3), target)
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('tablemill.aside_of' = '{target}')")
    spark.sql(f"ALTER TABLE {target} RENAME TO {target}_aside_0123")
    load_table(spark.range(2), target)
    assert spark.table(target).count() == 5 and not spark.catalog.tableExists(f"{target}_aside_0123")


def test_foreign_tables_are_never_touched(spark, target):
    """Names alone say nothing: neither a backup of the user's nor another table's content put aside is taken."""
    for name, of in ((f"{target}_old_backup", None), (f"{target}_aside_mine", None), (f"{target}_aside_x", f"{target}_aside")):
        load_table(spark.range(3), name)
        if of:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('tablemill.aside_of' = '{of}')")
    before = table_names(spark)
    load_table(spark.range(1), target)
    load_table(spark.range(1), target, recreate=True)
    load_table(spark.createDataFrame([("x",)], "s string"), target, recreate=True)
    assert spark.table(target).count() == 1 and table_names(spark) - before == {target.split(".")[1]}
    assert all(spark.table(f"{target}_{end}").count() == 3 for end in ("old_backup", "aside_mine", "aside_x"))


def test_readers_never_miss_a_table_that_is_replaced(spark, target):
    import threading

    load_table(spark.range(1000), target)
    seen, problems, done = Counter(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen[spark.table(target).agg(F.count("id"), F.max("id")).first()[0]] += 1
            except Exception as problem:  # noqa: BLE001 - counted
                problems.append(problem)

    reader = threading.Thread(target=read)
    reader.start()
    for count in (2000, 3000, 4000):
        load_table(spark.range(count), target, recreate=True)
        update_rows(spark, target, F.col("id") < 10, {"id": F.col("id") + 0})
        delete_rows(spark, target, F.col("id") >= count - 500)
    done.set()
    reader.join()
    assert not problems and set(seen) <= {1000, 2000, 1500, 3000, 2500, 4000, 3500} and spark.table(target).count() == 3500


def test_former_content_goes_with_the_next_replacement(spark, target):
    from tablemill.operators.tables import described, drop_former

    places = []
    for count in range(1, 5):
        load_table(spark.range(count), target, recreate=True)
        places.append(Path(described(spark, target)["Location"].removeprefix("file:")))
    assert [any(place.glob("part-*")) if place.exists() else False for place in places] == [False, False, True, True]
    drop_former(spark, target)
    assert not places[2].exists() and spark.table(target).count() == 4
    spark.sql(f"DROP TABLE {target}")
    assert not places[3].exists()
    load_table(spark.range(7), target)
    assert spark.table(target).count() == 7


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_a_lost_driver_leaves_a_replacement_that_is_finished(spark, target, monkeypatch, partition_by):
    from tablemill.operators import tables

    rows = spark.range(6).selectExpr("id", "id % 2 AS p")
    load_table(rows, target, partition_by=partition_by)

    def lost(*_, **__):
        raise KeyboardInterrupt

    real = tables._write_table
    written = []

    def once(df, table, by=()):
        if table == target:
            lost()
        written.append(table)
        return real(df, table, by)

    monkeypatch.setattr(tables, "_write_table", once)
    if not partition_by:
        sql = type(spark).sql
        monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: lost() if "_new_" in text and "RENAME" in text else sql(self, text, *a, **k))
    with pytest.raises(KeyboardInterrupt):
        load_table(rows.selectExpr("id * 2 AS twice", "p"), target, recreate=True, partition_by=partition_by)
    monkeypatch.undo()
    assert not spark.catalog.tableExists(target)
    load_table(spark.range(0).selectExpr("id AS p"), target)
    # a plain table comes back as it was, a partitioned one with the rows that were on their way
    assert spark.table(target).columns == (["twice", "p"] if partition_by else ["id", "p"]) and spark.table(target).count() == 6


def test_stages_are_snapshots_and_go(spark, target):
    load_table(spark.range(5), target)
    with Stages(spark) as stages:
        staged = stages.put(spark.table(target), "temp_test")
        load_table(spark.range(3), target)
        assert staged.count() == 5
        assert stages.sql("SELECT count(*) AS n FROM temp_test").first().n == 5
        assert stages.sql("SELECT a.id FROM temp_test a JOIN other o ON a.id = o.id", other=spark.range(2)).count() == 2
        names = set(stages.tables.values())
        assert all(spark.catalog.tableExists(name) for name in names)
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_stages_go_after_an_error(spark):
    before = table_names(spark)
    with pytest.raises(RuntimeError):
        with Stages(spark) as stages:
            stages.put(spark.range(2), "a")
            stages.put(spark.range(2), "a")
            raise RuntimeError
    assert table_names(spark) == before


def test_one_failed_drop_stops_no_other(spark):
    kept = store(spark.range(1), "x")
    spark.range(1).createOrReplaceTempView("plain_view")
    failed = drop_tables(spark, ["not a name", kept, f"{scratch_database(spark)}.never_there"])
    assert list(failed) == ["not a name"] and not spark.catalog.tableExists(kept)
    assert drop_tables(spark, []) == {}
    spark.catalog.dropTempView("plain_view")


def test_stages_lie_in_the_shared_folder(spark):
    from tablemill.session import shared_dir

    table = store(spark.range(1), "where")
    files = spark.table(table).inputFiles()
    assert files and all(shared_dir(spark).rstrip("/").removeprefix("file:") in file for file in files)
    drop_tables(spark, [table])


def test_all_targets_get_the_same_rows(spark, target, tmp_path):
    random = spark.range(1000).select("id", F.rand().alias("x"))
    written = table_and_csv(random, target, str(tmp_path / "csv"))
    assert written == {"table": target, "csv": str(tmp_path / "csv")}
    from_csv = extract_csv(spark, written["csv"], random.schema)
    assert spark.table(target).exceptAll(from_csv).count() == 0 and from_csv.count() == 1000


def test_a_failing_target_stops_no_other_and_leaves_no_stage(spark, target):
    before = table_names(spark)

    def broken(_):
        raise RuntimeError("sink down")

    with pytest.raises(RuntimeError, match="sink down"):
        write_targets(spark.range(9), {"bad": broken, "good": lambda df: load_table(df, target)})
    assert spark.table(target).count() == 9
    assert table_names(spark) - before == {target.split(".")[1]}


def test_table_to_csv_to_table(spark, target, tmp_path):
    source = fixture(spark)
    path = export_csv(source, str(tmp_path / "csv"))
    header = sorted(Path(path).glob("part-*"))[0].read_text().splitlines()
    assert header[0] == "id,ts" and "2026-01-01 00:" in header[1]
    for _ in range(2):
        csv_to_table(spark, path, source.schema, target)
    assert spark.table(target).exceptAll(source).count() == 0 and spark.table(target).count() == 100


def test_update(spark, target, rows):
    load_table(spark.createDataFrame([(1, 10, "a"), (2, 20, None), (None, 30, "c")], "id int, x int, s string"), target)
    # both changes see the old x; a NULL condition changes nothing
    update_rows(spark, target, F.col("id") > 1, {"x": F.col("x") + 1, "s": F.col("x").cast("string")})
    assert rows(spark.table(target)) == [(None, 30, "c"), (1, 10, "a"), (2, 21, "20")]
    with pytest.raises(ValueError):
        update_rows(spark, target, F.lit(True), {"nope": F.lit(1)})


def test_delete_keeps_rows_with_a_null_condition(spark, target, rows):
    load_table(spark.createDataFrame([(1,), (2,), (None,)], "id int"), target)
    delete_rows(spark, target, F.col("id") > 1)
    assert rows(spark.table(target)) == [(None,), (1,)]


def test_upsert(spark, target, rows):
    load_table(spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (None, "n")], "id int, s string"), target)
    upsert(target, spark.createDataFrame([("B", 2), ("c", 3), ("N", None), ("NN", None)], "s string, id int"), ["id"])
    assert rows(spark.table(target)) == [(None, "N"), (None, "NN"), (None, "n"), (1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError, match="several rows"):
        upsert(target, spark.createDataFrame([("x", 9), ("y", 9)], "s string, id int"), ["id"])
    assert spark.table(target).count() == 6


def test_upsert_by_two_keys_fills_missing_columns(spark, target, rows):
    load_table(spark.createDataFrame([(1, 1, "a", 5), (1, 2, "b", 6)], "i int, j int, s string, x int"), target)
    upsert(target, spark.createDataFrame([(1, 2, "B"), (2, 2, "new")], "i int, j int, s string"), ["i", "j"])
    assert rows(spark.table(target)) == [(1, 1, "a", 5), (1, 2, "B", None), (2, 2, "new", None)]


def test_nothing_is_left_behind(spark):
    from tablemill import session
    from tablemill.operators.staging import drop_scratch
    from tablemill.plans.registry import QUERIES

    for name in ("csv_round_trip", "incremental_refresh", "batch_any_sql_by_tag"):
        QUERIES[name](spark, "/root/testdata/sf0.001").count()
    folder = session.application_dir(spark)
    assert Path(folder.removeprefix("file://").removeprefix("file:")).exists()
    drop_scratch(spark)
    assert not Path(folder.removeprefix("file://").removeprefix("file:")).exists()
    assert not spark.catalog.databaseExists(f"tablemill_{spark.sparkContext.applicationId.replace('-', '_')}")
    # and what comes later starts afresh
    assert spark.table(store(spark.range(3), "later")).count() == 3
