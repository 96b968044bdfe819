import threading

import pytest
from pyspark.sql import Window, functions as F, types as T

from tablemill.operators import batches, skew
from tablemill.operators.batches import batch_totals, sql_per_batch, sql_per_range, top_per_batch
from tablemill.operators.combine import conform, fan_in, join_on
from tablemill.operators.numbering import group_sizes
from tablemill.operators.skew import frequent_keys, look_up
from tablemill.operators.transform import passthrough, sql_transform


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_input_df_and_parameters(spark):
    found = sql_transform("SELECT id + :k AS n FROM input_df WHERE id > 1", spark.range(4), args={"k": 10})
    assert sorted(r.n for r in found.collect()) == [12, 13]
    assert not spark.catalog.tableExists("input_df")


def test_a_view_of_the_user_survives(spark):
    spark.range(7).createOrReplaceTempView("input_df")
    try:
        assert sql_transform("SELECT count(*) AS n FROM input_df", spark.range(3)).first().n == 3
        with pytest.raises(Exception):
            sql_transform("SELECT nope FROM input_df", spark.range(3))
        assert spark.table("input_df").count() == 7
    finally:
        spark.catalog.dropTempView("input_df")


def test_several_inputs_and_none(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b")], "uid long, name string")
    orders = spark.createDataFrame([(1, 10), (1, 20)], "uid long, amount long")
    found = sql_transform(
        "SELECT name, sum(amount) AS total FROM users_df LEFT JOIN orders_df USING (uid) GROUP BY name",
        users_df=users, orders_df=orders,
    )
    assert {r.name: r.total for r in found.collect()} == {"a": 30, "b": None}
    with pytest.raises(ValueError):
        sql_transform("SELECT 1")


def test_parallel_calls_do_not_mix(spark):
    wrong = []

    def call(n):
        for _ in range(5):
            if sql_transform("SELECT count(*) AS n FROM input_df", spark.range(n)).first().n != n:
                wrong.append(n)

    threads = [threading.Thread(target=call, args=(n,)) for n in range(1, 7)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not wrong


def test_filters_reach_the_scan_through_sql(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id * 2 AS other", "id * 3 AS third").write.parquet(path)
    plan = plan_of(sql_transform("SELECT id FROM input_df WHERE other > 10", spark.read.parquet(path)))
    assert "GreaterThan(other,10)" in plan and "third" not in plan.split("ReadSchema")[1]


def test_passthrough(spark):
    df = spark.range(3)
    assert passthrough(df) is df


def tagged(spark, n=1000):
    return spark.range(n).selectExpr("if(id % 3 = 0, 0, id % 50) AS batch_key", "id", "cast(id AS decimal(9,0)) AS x")


@pytest.mark.parametrize("way", ["broadcast", "window", "split"])
def test_batch_totals(spark, monkeypatch, way):
    df = tagged(spark).withColumn("batch_key", F.when(F.col("batch_key") != 7, F.col("batch_key")))
    if way != "broadcast":
        monkeypatch.setattr(batches, "BROADCAST_BYTES", 0)
    totals = {"n": F.count(F.lit(1)), "sum_x": F.sum("x")}
    found = batch_totals(df, "batch_key", totals, rows_per_task=100 if way == "split" else 10**6)
    window = Window.partitionBy("batch_key")
    plain = df.select("*", F.count(F.lit(1)).over(window).alias("n"), F.sum("x").over(window).alias("sum_x"))
    assert found.columns == plain.columns
    assert found.exceptAll(plain).count() == 0 and found.count() == 1000
    plan = plan_of(found)
    assert ("Window" in plan) == (way != "broadcast")
    assert ("BroadcastHashJoin" in plan) == (way != "window")
    assert "SortMergeJoin" not in plan


def test_totals_of_any_length(spark):
    found = batch_totals(tagged(spark), "batch_key", {"ids": F.collect_list("id")}, rows_per_task=10)
    assert {len(r.ids) for r in found.where("batch_key = 0").collect()} == {found.where("batch_key = 0").count()}


@pytest.mark.parametrize("rows_per_task", [10, 10**6])
def test_look_up(spark, rows_per_task):
    df = tagged(spark).withColumn("batch_key", F.when(F.col("batch_key") != 7, F.col("batch_key")))
    lookup = df.groupBy("batch_key").agg(F.max("id").alias("top")).where("batch_key IS NULL OR batch_key < 40")
    found = look_up(df, lookup, ["batch_key"], rows_per_task=rows_per_task)
    plain = df.join(lookup.withColumnRenamed("batch_key", "k"), F.col("k").eqNullSafe(F.col("batch_key")), "left").drop("k")
    assert found.columns == plain.columns and found.exceptAll(plain).count() == 0 and found.count() == 1000
    assert ("Union" in plan_of(found)) == (rows_per_task == 10)


def test_frequent_keys_are_bounded_by_size(spark, monkeypatch):
    df = spark.range(10_000).selectExpr("if(id % 2 = 0, 0, id % 1000) AS k")
    sizes = group_sizes(df, "k")
    assert frequent_keys(df, ["k"], sizes, 32, rows_per_task=5).count() == 500 + 1
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 32 * 100)
    # more than 100 rows each: fewer than 100 keys, whatever the data
    assert frequent_keys(df, ["k"], sizes, 32, rows_per_task=5).count() == 1


def test_long_keys_count_towards_the_broadcast_size(spark, monkeypatch):
    df = spark.range(100).select(F.concat(F.repeat(F.lit("k"), 1000), (F.col("id") % 4).cast("string")).alias("g"), "id")
    monkeypatch.setattr(batches, "BROADCAST_BYTES", 4 * (1001 + 16))
    assert "BroadcastHashJoin" in plan_of(batch_totals(df, "g", {"n": F.count("*")}))
    monkeypatch.setattr(batches, "BROADCAST_BYTES", 4 * (1001 + 16) - 1)
    assert "Window" in plan_of(batch_totals(df, "g", {"n": F.count("*")}))


def test_wide_totals_are_not_broadcast_by_hint(spark):
    df = tagged(spark)
    found = batch_totals(df, "batch_key", {"ids": F.collect_list("id")}, rows_per_task=10**6)
    assert "Window" in plan_of(found)


@pytest.mark.parametrize("n", [3, 1500])
def test_top_per_batch(spark, n):
    df = spark.range(6000).selectExpr("if(id % 3 = 0, 0, 1) AS batch_key", "id * 7919 % 6000 AS v", "id")
    found = top_per_batch(df, "batch_key", [F.desc("v"), F.asc("id")], n)
    window = Window.partitionBy("batch_key").orderBy(F.desc("v"), F.asc("id"))
    plain = df.withColumn("p", F.row_number().over(window)).where(f"p <= {n}").drop("p")
    assert found.exceptAll(plain).count() == 0 and found.count() == plain.count()
    assert ("WindowGroupLimit" in plan_of(found)) == (n == 3)


def test_sql_per_range_runs_on_empty_ranges_too(spark):
    df = spark.createDataFrame([(0,), (1,), (12,), (None,)], "id long")
    found = sql_per_range(df, "SELECT count(*) AS n, max(id) AS top FROM input_df", "id", 5)
    assert sorted(tuple(r) for r in found.collect() if r.n) == [(1, 12, 10), (2, 1, 0)]
    assert found.count() == 3 and found.columns == ["n", "top", "batch_key"]


def test_sql_per_batch(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (None, 7)], "batch_key long, v long")
    found = sql_per_batch(df, "SELECT row_number() OVER (ORDER BY v) AS rn, v FROM input_df")
    assert sorted((r.rn, r.v, r.batch_key or 0) for r in found.collect()) == [(1, 5, 1), (1, 7, 0), (2, 6, 1)]
    # what cannot be planned for all batches at once reads one partition per batch
    found = sql_per_batch(df, "SELECT v FROM input_df WHERE v = (SELECT max(v) FROM input_df)")
    assert sorted((r.v, r.batch_key or 0) for r in found.collect()) == [(6, 1), (7, 0)]
    assert "PartitionFilters: [isnotnull(_number" in plan_of(found)
    empty = sql_per_batch(df.where("false"), "SELECT v FROM input_df")
    assert empty.columns == ["v", "batch_key"] and empty.count() == 0


LATERAL = [
    "SELECT count(*) AS n, sum(v) AS s FROM input_df",
    "SELECT count(*) AS n, max(id) AS m FROM input_df WHERE v > 100",
    "SELECT id, v FROM input_df ORDER BY v DESC, id LIMIT 2",
    "SELECT id, row_number() OVER (ORDER BY v, id) AS r, sum(v) OVER (PARTITION BY id % 2) AS s FROM input_df",
    "SELECT v, count(*) AS n FROM input_df GROUP BY v HAVING count(*) > 1",
    "SELECT a.id, b.id AS other FROM input_df a JOIN input_df b ON a.id = b.id + 1",
    "SELECT a.id, b.id AS other FROM input_df a LEFT JOIN input_df b ON a.id = b.id + 3",
    "WITH x AS (SELECT max(v) AS m FROM input_df) SELECT i.id FROM input_df i JOIN x ON i.v = x.m",
    "SELECT id FROM input_df WHERE v = 1 UNION ALL SELECT id + 1000 FROM input_df WHERE v = 2",
    "SELECT id FROM input_df EXCEPT SELECT id FROM input_df WHERE v < 3",
    "SELECT DISTINCT v FROM input_df",
    "SELECT count(DISTINCT v) AS n, batch_key FROM input_df GROUP BY batch_key",
    "SELECT id FROM input_df WHERE v = (SELECT max(v) FROM input_df)",
    "SELECT id FROM input_df WHERE EXISTS (SELECT 1 FROM input_df o WHERE o.v = input_df.v + 1)",
    "SELECT 1 AS one, `a.b` FROM input_df -- a comment at the end",
]


@pytest.mark.parametrize("query", LATERAL)
def test_all_batches_in_one_plan_give_what_each_alone_gives(spark, query, monkeypatch):
    df = spark.range(60).selectExpr("id", "id * 7 % 5 AS v", "id AS `a.b`", "if(id < 12, null, id div 9) AS batch_key")
    together = sql_per_batch(df, query)
    got = sorted(map(str, together.collect()))
    monkeypatch.setattr(batches, "_in_one_plan", lambda *_: None)
    alone = sql_per_batch(df, query)
    assert got == sorted(map(str, alone.collect())) and together.columns == alone.columns
    ranged = df.where("id < 20 OR id > 40").drop("batch_key")
    if "batch_key" not in query:
        want = sorted(map(str, sql_per_range(ranged, query, "id", 7).collect()))
        monkeypatch.undo()
        assert sorted(map(str, sql_per_range(ranged, query, "id", 7).collect())) == want


def test_ten_thousand_batches_are_one_plan(spark, monkeypatch):
    monkeypatch.setattr(batches, "_one_plan_each", lambda *_: pytest.fail("a plan per batch"))
    df = spark.range(50_000).selectExpr("id", "id % 7 AS v", "id div 5 AS batch_key")
    for query in ("SELECT count(*) AS n, sum(v) AS s FROM input_df", "SELECT id FROM input_df ORDER BY v DESC, id LIMIT 1"):
        found = sql_per_batch(df, query)
        assert found.count() == 10_000 and found.select("batch_key").distinct().count() == 10_000
        assert "NestedLoop" not in plan_of(found) and "CartesianProduct" not in plan_of(found)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_batch_keys_of_other_types(spark, kind):
    days = {"timestamp": "timestamp_seconds(id % 3 * 5000)", "timestamp_ntz": "timestamp_ntz'2026-03-08 02:30:00.000001' + make_dt_interval(id % 3)",
            "date": "date_add(date'2026-01-01', cast(id % 3 as int))", "string": "concat('k ', id % 3, '/=')"}
    df = spark.range(90).selectExpr(f"{days[kind]} AS batch_key", "id")
    found = sql_per_batch(df, "SELECT count(*) AS n FROM input_df")
    plain = df.groupBy("batch_key").agg(F.count("*").alias("n")).select("n", "batch_key")
    assert found.dtypes[1][1] == kind and found.exceptAll(plain).count() == 0 and found.count() == 3


def test_any_number_of_batches(spark, monkeypatch):
    monkeypatch.setattr(batches, "PLANS_AT_ONCE", 3)
    monkeypatch.setattr(batches, "_in_one_plan", lambda *_: None)
    for n in (3, 4, 7):
        df = spark.range(n * 5).selectExpr("id div 5 AS batch_key", "id")
        found = sql_per_batch(df, "SELECT count(*) AS n FROM input_df")
        assert sorted(map(tuple, found.collect())) == [(5, key) for key in range(n)]
        found = sql_per_range(df.select("id"), "SELECT count(*) AS n FROM input_df", "id", 5)
        assert sorted(map(tuple, found.collect())) == [(5, key * 5) for key in range(n)]


def test_batch_keys_that_are_easily_confused(spark):
    df = spark.createDataFrame([("", 1), (None, 2), ("", 3), ("null", 4)], "batch_key string, v long")
    found = sql_per_batch(df, "SELECT sum(v) AS s FROM input_df")
    assert sorted(map(tuple, found.collect()), key=str) == [(2, None), (4, ""), (4, "null")]
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 3), (float("nan"), 4), (None, 5)], "batch_key double, v long")
    found = sql_per_batch(df, "SELECT sum(v) AS s FROM input_df")
    assert sorted((r.s, str(r.batch_key)) for r in found.collect()) == [(3, "0.0"), (5, "None"), (7, "nan")]
    df = spark.createDataFrame([(bytearray(b"a"), 1), (bytearray(b""), 2)], "batch_key binary, v long")
    assert sorted((r.s, bytes(r.batch_key)) for r in sql_per_batch(df, "SELECT sum(v) AS s FROM input_df").collect()) == [(1, b"a"), (2, b"")]


def test_fan_in(spark):
    a = spark.createDataFrame([(1, "x")], "id long, name string")
    b = spark.createDataFrame([(2.5, 2)], "amount double, id long")
    assert sorted((r.id, r.name, r.amount) for r in fan_in([a, b]).collect()) == [(1, "x", None), (2, None, 2.5)]
    assert fan_in(a.withColumn("batch_key", F.lit(1)), drop=["batch_key"]).columns == ["id", "name"]
    assert fan_in([], spark=spark, schema=a.schema).columns == ["id", "name"]
    with pytest.raises(ValueError):
        fan_in([])


def test_conform(spark):
    df = spark.createDataFrame([(1, "x", True)], "n int, s string, gone boolean")
    found = conform(df, "s string, extra double, n bigint")
    assert found.dtypes == [("s", "string"), ("extra", "double"), ("n", "bigint")] and tuple(found.first()) == ("x", None, 1)
    too_big = spark.createDataFrame([(2**40,)], "n long")
    with pytest.raises(Exception):
        conform(too_big, T.StructType([T.StructField("n", T.IntegerType())])).collect()


def test_join_on_matches_null_keys(spark):
    left = spark.createDataFrame([(1, None), (None, "b")], "k long, `x.y` string")
    right = spark.createDataFrame([(None, 5), (2, 6)], "k long, v long")
    assert sorted((r["k"] or 0, r["x.y"] or "", r["v"] or 0) for r in join_on(left, right, ["k"], "left").collect()) == [
        (0, "b", 5), (1, "", 0)
    ]
