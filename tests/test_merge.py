"""MERGE with clauses against a plain loop, and changes of partitioned tables."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tablemill.operators import rewrite
from tablemill.operators.rewrite import (
    delete_rows,
    finish_change,
    merge_rows,
    update_rows,
    upsert,
    when_matched_delete,
    when_matched_update,
    when_not_matched_by_source_delete,
    when_not_matched_by_source_update,
    when_not_matched_insert,
)
from tablemill.operators.tables import load_table, properties

T, S = (lambda name: F.col(f"target.{name}")), (lambda name: F.col(f"source.{name}"))
def clauses():
    return [
        when_matched_delete(S("v") > 90),
        when_matched_update({"v": T("v") + S("v")}, T("v") < 20),
        when_matched_update(condition=S("p") == "c"),
        when_not_matched_insert({"k": S("k"), "v": S("v") * 10, "p": F.lit("new")}, S("v") % 3 == 0),
        when_not_matched_insert(condition=S("v") % 3 == 1),
        when_not_matched_by_source_delete(T("v") % 5 == 0),
        when_not_matched_by_source_update({"p": F.lit(None), "v": -T("v")}, T("p") == "a"),
    ]


def plainly(target, source):
    """The same clauses, row by row; a comparison with None is not true."""
    known = {row[0]: row for row in source if row[0] is not None}
    out = []
    for k, v, p, x in target:
        hit = known.get(k) if k is not None else None
        if hit:
            _, sv, sp = hit
            if sv is not None and sv > 90:
                continue
            if v is not None and v < 20:
                out.append((k, None if sv is None else v + sv, p, x))
            elif sp == "c":
                out.append((k, sv, sp, x))
            else:
                out.append((k, v, p, x))
        elif v is not None and v % 5 == 0:
            continue
        elif p == "a":
            out.append((k, None if v is None else -v, None, x))
        else:
            out.append((k, v, p, x))
    have = {row[0] for row in target}
    for k, v, p in source:
        if k is None or k not in have:
            if v is not None and v % 3 == 0:
                out.append((k, v * 10, "new", None))
            elif v is not None and v % 3 == 1:
                out.append((k, v, p, None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,partition_by", [(1, []), (2, ["p"]), (3, []), (4, ["p"]), (5, ["p"])])
def test_merge_as_row_by_row(spark, target, seed, partition_by):
    draw = random.Random(seed)
    value = lambda low, high: draw.choice([None, *range(low, high)])
    place = lambda: draw.choice([None, "a", "b", "c", "it's", 'a"b\\'])
    before = [(value(0, 60), value(0, 100), place(), draw.randint(0, 9)) for _ in range(150)]
    keys = draw.sample(range(100), 60)
    source = [(k, value(0, 100), place()) for k in keys] + [(None, value(0, 100), place()) for _ in range(10)]
    # a key of several source rows that the target does not have is no error
    source += [(777, 3, "a"), (777, 4, "b")]
    load_table(spark.createDataFrame(before, "k long, v long, p string, x long"), target, partition_by=partition_by)
    merge_rows(target, spark.createDataFrame(source, "k int, v int, p string"), ["k"], clauses())
    got = spark.table(target).select("k", "v", "p", "x").collect()
    assert sorted(map(tuple, got), key=str) == plainly(before, source)


def test_merge_errors_and_names(spark, target):
    load_table(spark.createDataFrame([(1, 2.0)], "`a.b` long, v double"), target)
    twice = spark.createDataFrame([(1, 1.0), (1, 2.0)], "`a.b` long, v double")
    with pytest.raises(ValueError, match="several rows"):
        merge_rows(target, twice, ["a.b"], [when_matched_delete()])
    with pytest.raises(ValueError, match="no such columns"):
        merge_rows(target, twice.withColumn("w", F.lit(1)), ["a.b"], [when_not_matched_insert()])
    merge_rows(target, spark.createDataFrame([(1, float("nan")), (2, 5.0)], "`a.b` long, v double"), ["a.b"],
               [when_matched_update(), when_not_matched_insert()])
    assert sorted(map(tuple, spark.table(target).collect())) == [(1, None), (2, 5.0)]
    merge_rows(target, twice.limit(0), ["a.b"], [])
    assert spark.table(target).count() == 2


def test_merge_into_an_empty_table(spark, target):
    load_table(spark.createDataFrame([], "k long, p string"), target, partition_by=["p"])
    merge_rows(target, spark.createDataFrame([(1, "x"), (2, None), (3, "")], "k long, p string"), ["k"], [when_not_matched_insert()])
    assert sorted(map(tuple, spark.table(target).collect()), key=str) == [(1, "x"), (2, None), (3, None)]


PARTITIONS = [
    ("string", ["it's", 'say "x"', "a\\b", "a/b=c%", None, "plain"]),
    ("boolean", [True, False, None]),
    ("date", [dt.date(2026, 1, 1), dt.date(1999, 12, 31), None]),
    ("int", [0, -5, None]),
    ("timestamp", [dt.datetime(2026, 1, 1, 12, 30), dt.datetime(2026, 1, 2), None]),
    ("decimal(6,2)", [__import__("decimal").Decimal("1.50"), None]),
]


@pytest.mark.parametrize("kind,values", PARTITIONS)
def test_any_partition_value_goes(spark, target, kind, values):
    rows = [(n, value) for n, value in enumerate(values)] + [(100 + n, value) for n, value in enumerate(values)]
    load_table(spark.createDataFrame(rows, f"id long, p {kind}"), target, partition_by=["p"])
    for n in range(len(values)):
        delete_rows(spark, target, F.col("id") == n)
        update_rows(spark, target, F.col("id") == 100 + n, {"id": F.col("id") + 100})
        assert spark.sql(f"SHOW PARTITIONS {target}").count() == len(values) - n
        delete_rows(spark, target, F.col("id") == 200 + n)
        assert spark.sql(f"SHOW PARTITIONS {target}").count() == len(values) - n - 1
    assert spark.table(target).count() == 0


def test_empty_text_and_null_share_a_partition(spark, target):
    load_table(spark.createDataFrame([(1, None), (2, "x")], "id long, p string"), target, partition_by=["p"])
    upsert(target, spark.createDataFrame([(3, "")], "id long, p string"), ["id"])
    assert sorted(map(tuple, spark.table(target).collect()), key=str) == [(1, None), (2, "x"), (3, None)]


def test_a_change_that_stopped_half_way_is_completed(spark, target, monkeypatch):
    rows = [(n, p) for n, p in enumerate("aabbc")]
    load_table(spark.createDataFrame(rows, "id long, p string"), target, partition_by=["p"])

    def lost(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(rewrite, "_drop_emptied", lost)
    with pytest.raises(KeyboardInterrupt):
        delete_rows(spark, target, F.col("id").isin(0, 4))
    monkeypatch.undo()
    staged = json.loads(properties(spark, target)[rewrite.PENDING])
    finish_change(spark, target)
    assert sorted(map(tuple, spark.table(target).collect())) == [(1, "a"), (2, "b"), (3, "b")]
    assert not any(map(spark.catalog.tableExists, staged)) and rewrite.PENDING not in properties(spark, target)


def test_a_failed_change_leaves_the_table(spark, target):
    load_table(spark.createDataFrame([(n, "a") for n in range(5)], "id long, p string"), target, partition_by=["p"])
    with pytest.raises(Exception, match="broken"):
        update_rows(spark, target, F.col("id") > 2, {"id": F.raise_error(F.lit("broken")).cast("long")})
    assert sorted(row.id for row in spark.table(target).collect()) == list(range(5))
    assert rewrite.PENDING not in properties(spark, target)
