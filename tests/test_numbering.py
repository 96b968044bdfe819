import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tablemill.operators import numbering
from tablemill.operators.numbering import group_sizes, number_rows
from tablemill.operators.splitting import split_by_position, split_within


def numbered(df, *args, **kwargs):
    return number_rows(df, *args, **kwargs).collect()


def check_whole(found, order, n):
    assert sorted(row["row_no"] for row in found) == list(range(1, n + 1))
    by_place = sorted(found, key=lambda row: row["row_no"])
    keys = [tuple((row[name] is None, row[name] or 0) for name in order) for row in by_place]
    assert keys == sorted(keys)


def test_group_sizes(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "g int")
    sizes = group_sizes(df, "g")
    assert (sizes.largest, sizes.total, sizes.groups, sizes.key_bytes) == (2, 3, 2, 16)
    words = spark.createDataFrame([("a", "x"), ("über", None)], "g string, h string")
    assert group_sizes(words, ["g", "h"]).key_bytes == 6
    assert group_sizes(df).largest == 3
    assert group_sizes(df.where("false"), "g").largest == 0


@pytest.mark.parametrize("rows_per_task", [10**6, 300, 7])
def test_nulls_last_and_negative_keys(spark, rows_per_task):
    df = spark.range(1000).select(F.when(F.col("id") % 10 > 0, 300 - F.col("id") * 7 % 991).alias("k"), "id")
    check_whole(numbered(df, "k", rows_per_task=rows_per_task), ["k"], 1000)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz", "decimal(20,3)", "double", "binary", "float"])
def test_ranges_over_other_key_types(spark, kind):
    value = {
        "string": "format_string('k%05d', id * 7919 % 2000)",
        "date": "date_add(date'2020-01-01', cast(id * 7919 % 2000 as int))",
        "timestamp": "timestamp'2020-01-01' + make_dt_interval(0, 0, 0, id * 7919 % 2000 * 0.000001)",
        "timestamp_ntz": "timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, 0, id * 7919 % 2000 * 0.000001)",
        "decimal(20,3)": "cast(id * 7919 % 2000 as decimal(20,3)) / 8",
        "double": "cast(id * 7919 % 2000 as double) / 8",
        "float": "cast(id * 7919 % 2000 as float) / 8",
        "binary": "cast(format_string('k%05d', id * 7919 % 2000) as binary)",
    }[kind]
    df = spark.range(2000).selectExpr(f"cast({value} as {kind}) as k")
    by_range = number_rows(df, "k", rows_per_task=150)
    plain = df.withColumn("row_no", F.row_number().over(Window.orderBy("k")).cast("bigint"))
    assert by_range.exceptAll(plain).count() == 0 and by_range.count() == 2000


def test_not_a_number_sorts_last(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, float("nan")).otherwise(F.col("id")).alias("k"), "id")
    found = numbered(df, "k", rows_per_task=50)
    assert sorted(row["row_no"] for row in found) == list(range(1, 901))
    assert all((row["row_no"] > 600) == (row["k"] != row["k"]) for row in found)


def test_one_key_holds_a_third(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id")).alias("k"), "id")
    by_range = number_rows(df, "k", rows_per_task=200)
    check_whole(by_range.collect(), ["k"], 6000)
    again = number_rows(df.repartition(5), "k", rows_per_task=200)
    assert {(r.id, r.row_no) for r in by_range.collect()} == {(r.id, r.row_no) for r in again.collect()}


def test_copies_equal_in_every_column(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 < 2, 77).otherwise(F.col("id")).alias("k"))
    check_whole(numbered(df, "k", rows_per_task=200), ["k"], 6000)
    check_whole(numbered(df.select(F.lit(1).alias("k")), "k", rows_per_task=500), ["k"], 6000)


def test_ranges_stay_small_whatever_the_skew(spark):
    """No task numbers more than a few times ``rows_per_task`` rows."""
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), "id")
    from tablemill.functions.ranges import point_array, searched_range
    from tablemill.operators.numbering import _kinds, _sampled_points

    keyed = df.withColumn("_tie", F.xxhash64("id"))
    keys = ["k", "_tie"]
    points, repeated = _sampled_points(keyed, keys, 40, 20_000)
    assert not repeated and len(points) == 39
    kinds = _kinds(keyed, keys)
    arrays = [point_array([point[at] for point in points], kind) for at, kind in enumerate(kinds)]
    ranged = keyed.groupBy(searched_range(arrays, 39, keys, kinds).alias("r")).count()
    assert ranged.count() == 40 and ranged.agg(F.max("count")).first()[0] < 1500


def test_nested_keys_take_the_plain_window(spark):
    df = spark.range(100).select(F.struct((F.col("id") % 7).alias("a"), "id").alias("k"))
    found = number_rows(df, "k", rows_per_task=10)
    assert [r.row_no for r in found.orderBy("k").collect()] == list(range(1, 101))


@pytest.mark.parametrize("kind", ["binary", "timestamp", "boolean"])
def test_groups_of_other_types(spark, kind):
    group = {
        "binary": "unhex(format_string('FF%02X', id % 3))",
        "timestamp": "timestamp_seconds(1793511000 + id % 3 * 1800)",
        "boolean": "id % 3 = 0",
    }[kind]
    df = spark.range(900).selectExpr(f"if(id % 50 = 0, null, {group}) AS g", "id * 7 % 900 AS k")
    by_range = number_rows(df, "k", "g", rows_per_task=40)
    plain = df.withColumn("row_no", F.row_number().over(Window.partitionBy("g").orderBy("k")).cast("bigint"))
    assert by_range.exceptAll(plain).count() == 0 and by_range.count() == 900


def test_keys_that_differ_beyond_double_precision(spark):
    df = spark.range(2000).selectExpr("9007199254740992 + id * 7919 % 2000 AS k")
    found = number_rows(df, "k", rows_per_task=100)
    assert found.where("row_no <> k - 9007199254740992 + 1").count() == 0 and found.count() == 2000


def test_groups_large_small_and_null(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        (F.col("id") * 7919 % 5000).alias("k"),
    )
    by_range = number_rows(df, "k", "g", rows_per_task=100)
    plain = df.withColumn("row_no", F.row_number().over(Window.partitionBy("g").orderBy("k")).cast("bigint"))
    assert by_range.exceptAll(plain).count() == 0 and by_range.count() == 5000


@pytest.mark.parametrize("rows_per_task", [10**6, 100])
def test_running_sums(spark, rows_per_task):
    df = spark.range(3000).selectExpr(
        "id % 2 as g", "id * 7919 % 3000 as k", "if(id % 5 = 0, null, cast(id as decimal(9,0))) as x"
    )
    found = number_rows(df, "k", "g", running={"so_far": F.col("x")}, rows_per_task=rows_per_task)
    window = Window.partitionBy("g").orderBy("k")
    plain = df.select("*", F.row_number().over(window).cast("bigint").alias("row_no"), F.sum("x").over(window).alias("so_far"))
    assert found.schema == plain.schema
    assert found.exceptAll(plain).count() == 0 and found.count() == 3000


def test_long_keys_make_fewer_ranges(spark, monkeypatch):
    monkeypatch.setattr(numbering, "POINT_BYTES", 20_000)
    df = spark.range(1000).select(F.concat(F.repeat(F.lit("k"), 4000), F.format_string("%04d", F.col("id"))).alias("k"))
    assert numbering._most_ranges(df, ["k"], 0) == 4
    found = number_rows(df, "k", rows_per_task=10)
    assert found.where("row_no <> cast(right(k, 4) as int) + 1").count() == 0 and found.count() == 1000


def test_odd_column_names_and_map_columns(spark):
    df = spark.range(500).select((F.col("id") % 9).alias("a.b"), F.create_map(F.lit("k"), F.col("id")).alias("m"), "id")
    found = numbered(df, "a.b", rows_per_task=40)
    assert sorted(row["row_no"] for row in found) == list(range(1, 501))


def test_one_shuffle_of_full_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10_000).selectExpr("id", "id * 2 as wide").write.parquet(path)
    stored = spark.read.parquet(path)
    plan = number_rows(stored, "id", rows_per_task=1000)._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(_range" in line for line in plan.splitlines()) == 1
    # counting rows before each range reads the key only
    assert "ReadSchema: struct<id:bigint>" in plan


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-20, 20)), max_size=60), st.integers(1, 15), st.integers(1, 20))
def test_split_cuts_equal_runs_in_key_order(spark, values, size, rows_per_task):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k int, id int")
    found = split_by_position(df, "k", size, rows_per_task=rows_per_task).collect()
    ordered = sorted(values, key=lambda v: (v is None, v or 0))
    runs = [ordered[i:i + size] for i in range(0, len(ordered), size)]
    assert sorted((r["batch_no"], r["batch_key"] is None, r["batch_key"] or 0) for r in found) == sorted(
        (number, run[0] is None, run[0] or 0) for number, run in enumerate(runs) for _ in run
    )
    assert sorted(r["id"] for r in found) == list(range(len(values)))


def test_split_settings_are_required(spark):
    df = spark.range(3)
    for wrong in ({"batch_size": 0, "pk": "id"}, {"batch_size": None, "pk": "id"}, {"batch_size": 5, "pk": None}):
        with pytest.raises(ValueError):
            split_by_position(df, **wrong)


def test_runs_longer_than_a_task(spark):
    df = spark.range(1000)
    found = split_by_position(df, "id", 400, rows_per_task=100).groupBy("batch_no", "batch_key").count()
    assert sorted(tuple(r) for r in found.collect()) == [(0, 0, 400), (1, 400, 400), (2, 800, 200)]


@pytest.mark.parametrize("key", ["id", "format_string('%05d', id)"])
def test_long_runs_within_groups(spark, key):
    df = spark.range(3000).selectExpr(f"{key} AS k", "if(id < 2500, null, id % 100) AS g")
    found = split_within(df, "k", 400, "g", rows_per_task=150)
    counts = found.groupBy("g", "sub_no", "sub_key").count().collect()
    assert sorted(r["count"] for r in counts if r.g is None) == [100] + [400] * 6
    assert sorted(int(r.sub_key) for r in counts if r.g is None) == list(range(0, 2500, 400))
    assert sum(r["count"] for r in counts) == 3000 and all(r["count"] == 5 for r in counts if r.g is not None)


def test_a_split_shuffles_full_rows_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).selectExpr("id", "cast(id as string) AS wide").write.parquet(path)
    runs = split_by_position(spark.read.parquet(path), "id", 300, rows_per_task=400)
    assert runs.groupBy("batch_no", "batch_key").count().where("batch_key <> batch_no * 300").count() == 0
    assert runs.count() == 5000
    runs.collect()
    plan = runs._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    lines = final.splitlines()
    assert sum("Exchange hashpartitioning(_range" in line for line in lines) == 2
    # one of the two carries keys only, and full rows are sorted once
    assert sum("FileScan" in line and "wide" in line for line in lines) == 1
    assert sum("Sort [" in line and "wide" in line for line in lines) == 1


def test_runs_over_many_ranges(spark):
    df = spark.range(2000).selectExpr("id * 3 AS k", "id")
    found = split_by_position(df, "k", 90, rows_per_task=100, tie_break=[])
    assert found.where("batch_no <> id div 90 OR batch_key <> batch_no * 270").count() == 0 and found.count() == 2000


def test_nested_split(spark):
    df = spark.range(100).selectExpr("id", "id div 40 * 40 as batch_key")
    found = split_within(df, "id", 15).groupBy("batch_key", "sub_no", "sub_key").count().collect()
    assert sorted(tuple(r) for r in found) == [
        (0, 0, 0, 15), (0, 1, 15, 15), (0, 2, 30, 10), (40, 0, 40, 15), (40, 1, 55, 15), (40, 2, 70, 10),
        (80, 0, 80, 15), (80, 1, 95, 5),
    ]


def test_unstable_input_is_numbered_once(spark):
    df = spark.range(20_000).select((F.rand() * 1000).cast("int").alias("k"))
    found = number_rows(df, "k", rows_per_task=1000)
    assert sorted(r.row_no for r in found.select("row_no").collect()) == list(range(1, 20_001))


def test_files_need_no_copy(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    files = spark.read.parquet(str(tmp_path / "t"))
    assert numbering._reads_files_alone(files.where("id > 3").select((F.col("id") * 2).alias("k")))
    assert not numbering._reads_files_alone(files.withColumn("r", F.rand()))
    assert not numbering._reads_files_alone(files.groupBy("id").count())
