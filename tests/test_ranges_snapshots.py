"""Range joins, refresh by differences of snapshots, and staleness over several steps."""

import random

import pytest
from pyspark.sql import functions as F

from tablemill.operators.ranges import range_join
from tablemill.operators.runlog import stale_downstream, stale_tables
from tablemill.operators.tables import load_table
from tablemill.streaming import snapshots
from tablemill.streaming.snapshots import refresh_from_snapshot


@pytest.mark.parametrize("width", [0.7, 3.0, 1000.0])
def test_range_join(spark, width):
    draw = random.Random(3)
    odd = [None, float("nan"), float("inf"), -0.0, 5.0]
    points = [(n, draw.choice(odd) if n % 9 == 0 else round(draw.uniform(-20, 20), 1)) for n in range(200)]
    spans = [(n, low, low + draw.choice([0.0, 0.5, 4.0, -1.0])) for n, low in enumerate(round(draw.uniform(-20, 20), 1) for _ in range(80))]
    spans += [(100, None, 1.0), (101, 0.0, float("nan")), (102, 5.0, 5.0)]
    left, right = spark.createDataFrame(points, "i long, v double"), spark.createDataFrame(spans, "j long, low double, high double")
    left = left.withColumn("_bin0", F.lit(1))
    found = range_join(left, right, F.col("v"), F.col("low"), F.col("high"), width)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString() and found.columns == ["i", "v", "_bin0", "j", "low", "high"]
    usable = lambda *xs: all(x is not None and x == x and abs(x) < 1e300 for x in xs)
    want = sorted((i, j) for i, v in points for j, low, high in spans if usable(v, low, high) and low <= v <= high)
    assert sorted((row.i, row.j) for row in found.collect()) == want
    with pytest.raises(ValueError):
        range_join(left, right, F.col("v"), F.col("low"), F.col("high"), 0)


def upstream(spark, rows):
    return spark.createDataFrame(rows, "k long, s string, x double, gone array<int>")


def test_downstream_follows_any_change(spark, target):
    draw, state = random.Random(7), {}
    shaped = lambda rows: sorted((k, ("-" if s is None else s).upper(), x) for k, s, x, _ in rows if k % 4)
    for round_ in range(4):
        for k in draw.sample(range(40), 15):
            if k in state and draw.random() < 0.4:
                del state[k]
            else:
                state[k] = (k, draw.choice(["a", "", None, "it's"]), draw.choice([None, 0.5, 1.0]), draw.choice([None, [], [1, None]]))
        frame = upstream(spark, list(state.values())).select(*(["x", "gone", "s", "k"] if round_ % 2 else ["k", "s", "x", "gone"]))
        refresh_from_snapshot(frame, target, ["k"], sql="SELECT k, upper(nvl(s, '-')) AS s, x FROM input_df WHERE k % 4 <> 0")
        assert sorted(map(tuple, spark.table(target).collect()), key=str) == sorted(shaped(state.values()), key=str)
        # the order of columns is no change
        assert refresh_from_snapshot(upstream(spark, list(state.values())), target, ["k"]) == {"insert": 0, "update": 0, "delete": 0}


def test_a_refresh_that_fails_half_way_is_done_again(spark, target, monkeypatch):
    refresh_from_snapshot(spark.range(5).selectExpr("id", "id AS v"), target, ["id"])
    monkeypatch.setattr(snapshots, "load_table", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
    changed = spark.range(1, 7).selectExpr("id", "id * 10 AS v")
    with pytest.raises(RuntimeError):
        refresh_from_snapshot(changed, target, ["id"])
    monkeypatch.undo()
    assert refresh_from_snapshot(changed, target, ["id"]) == {"insert": 2, "update": 4, "delete": 1}
    assert sorted(map(tuple, spark.table(target).collect())) == [(n, n * 10) for n in range(1, 7)]


def test_rows_of_others_stay_and_bad_keys_fail(spark, target):
    load_table(spark.createDataFrame([(100, 1)], "id long, v long"), target)
    refresh_from_snapshot(spark.range(2).selectExpr("id", "id AS v"), target, ["id"])
    refresh_from_snapshot(spark.range(0).selectExpr("id", "id AS v"), target, ["id"])
    assert list(map(tuple, spark.table(target).collect())) == [(100, 1)]
    for rows in ([(None, 1)], [(1, 1), (1, 2)]):
        with pytest.raises(ValueError, match="unique and not NULL"):
            refresh_from_snapshot(spark.createDataFrame(rows, "id long, v long"), target, ["id"])


def test_staleness_goes_down_chains_and_around_cycles(spark):
    latest = spark.createDataFrame([(name, day) for name, day in [("a", 9), ("b", 2), ("c", 3), ("d", 4), ("e", 5), ("x", 1), ("y", 1), ("z", 1)]],
                                   "table_name string, ts int")
    edges = [("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("b", "e"), ("x", "y"), ("y", "z"), ("z", "x"), ("never", "x"), ("after", "never"), (None, "a"), ("x", None)]
    frame = spark.createDataFrame(edges, "table_name string, depends_on string")
    assert sorted(r.table_name for r in stale_tables(frame.where("table_name IS NOT NULL"), latest).collect() if r.table_name) == ["after", "b", "never"]
    got = {r.table_name: r.steps for r in stale_downstream(frame.where("table_name IS NOT NULL"), latest).collect()}
    assert got == {"b": 0, "c": 1, "d": 2, "e": 3, "never": 0, "after": 0}
    several = frame.where("table_name IS NOT NULL").groupBy("table_name").agg(F.collect_list("depends_on").alias("depends_on"))
    assert {r.table_name: r.steps for r in stale_downstream(several, latest).collect()} == got
    assert stale_downstream(frame.limit(0), latest).count() == 0
