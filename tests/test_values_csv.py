import datetime as dt
import io
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from tablemill.functions.durations import duration_seconds
from tablemill.functions.values import MISSING_WORDS, float_text, for_loading, to_milliseconds
from tablemill.operators import csv_export
from tablemill.operators.csv_export import export_csv
from tablemill.sources.files import extract_csv

HARD = ["plain", 'say "x", y', "two\nlines", "cr\rlf\r\n", " spaces ", "comma,", "#x", "'q'", "\\back\\", 'end"', "ünï", "", None]


def text_of(path):
    parts = sorted(Path(path).glob("part-*.csv"))
    lines = [part.read_bytes().decode("utf-8") for part in parts if part.stat().st_size]
    head = lines[0].split("\n", 1)[0] + "\n"
    return head + "".join(part[len(head):] for part in lines)


def test_stored_values(spark):
    df = spark.createDataFrame(
        [(1, 2.5, float("nan"), dt.datetime(2026, 1, 1, 0, 0, 1, 123999), "x", [1])],
        "i int, f float, d double, t timestamp_ntz, s string, a array<int>",
    )
    stored = for_loading(df)
    assert [f.dataType.simpleString() for f in stored.schema] == ["bigint", "double", "double", "timestamp_ntz", "string", "array<int>"]
    assert tuple(stored.first()) == (1, 2.5, None, dt.datetime(2026, 1, 1, 0, 0, 1, 123000), "x", [1])


def test_milliseconds_are_cut_not_rounded_in_any_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist in New York on that day; before 1970 seconds count backwards
        stamps = ["2026-03-08 02:30:00.999999", "1969-12-31 23:59:59.000999", "2026-01-01 00:00:00", "1850-01-01 00:00:00.0019"]
        df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
        cut = df.select(to_milliseconds(F.col("t")).alias("t"))
        assert cut.schema["t"].dataType == T.TimestampNTZType()
        assert [r[0] for r in cut.select(F.col("t").cast("string")).collect()] == [
            "2026-03-08 02:30:00.999", "1969-12-31 23:59:59", "2026-01-01 00:00:00", "1850-01-01 00:00:00.001"
        ]
        zoned = df.select(to_milliseconds(F.to_timestamp(F.lit("2026-05-05 01:02:03.0049"))).alias("t"))
        assert zoned.schema["t"].dataType == T.TimestampType()
        assert zoned.select(F.col("t").cast("string")).first()[0] == "2026-05-05 01:02:03.004"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_float_text_is_that_of_pandas(spark):
    values = [0.0, -0.0, 1.0, -1.5, 12345678.9, 1e15, 1e16, 1.5e16, 1e-4, 0.00012345, 1e-5, 1.25e-7, 1e100, -2e-300,
              123456789012345.6, 9007199254740993.0, 0.1, 1 / 3, 5e-324, 1.7976931348623157e308, float("inf"), float("-inf")]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(float_text(F.col("v"))).collect()]
    want = [line for line in pd.DataFrame({"v": values}).to_csv(index=False).splitlines()[1:]]
    different = {(g, w) for g, w in zip(got, want) if g != w}
    # older JVMs write one digit more than needed for the smallest double
    assert different <= {("4.9e-324", "5e-324")}
    assert all(float(g) == v for g, v in zip(got, values))


def test_export_is_what_pandas_writes(spark, tmp_path):
    stamps = [dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1, 0, 0, 1, 500000), None]
    data = [
        (i, None if i % 4 == 3 else i * 1.5, [True, False, None][i % 3], stamps[i % 3], text)
        for i, text in enumerate(HARD)
    ]
    df = spark.createDataFrame(data, "i long, f double, b boolean, t timestamp_ntz, s string").coalesce(1)
    frame = pd.DataFrame(data, columns=list("ifbts")).astype({"b": "boolean"}).convert_dtypes(dtype_backend="pyarrow")
    frame["t"] = frame["t"].astype("timestamp[us][pyarrow]")
    frame["f"] = pd.Series([row[1] for row in data], dtype="double[pyarrow]")
    path = export_csv(df, str(tmp_path / "out"))
    want = pd.read_csv(io.StringIO(frame.to_csv(index=False)), dtype=str, keep_default_na=False)
    got = pd.read_csv(io.StringIO(text_of(path)), dtype=str, keep_default_na=False)
    pd.testing.assert_frame_equal(got, want)


def test_round_trip_of_hard_text(spark, tmp_path):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(HARD + ["NA", "null", "nan"])], "i long, s string")
    back = extract_csv(spark, export_csv(df, str(tmp_path / "out")), df.schema)
    want = {i: (s or None) for i, s in enumerate(HARD)} | {len(HARD) + k: None for k in range(3)}
    assert {r.i: r.s for r in back.collect()} == want
    assert back.schema.simpleString() == df.schema.simpleString()


def test_a_lone_column_keeps_its_empty_rows(spark, tmp_path):
    df = spark.createDataFrame([("x",), (None,), ("",), ('q"',)], "s string").coalesce(1)
    path = export_csv(df, str(tmp_path / "out"))
    assert text_of(path) == 's\nx\n""\n""\n"q"""\n'
    assert [r.s for r in extract_csv(spark, path, "s string").collect()] == ["x", None, None, 'q"']
    numbers = export_csv(spark.createDataFrame([(1,), (None,)], "n long"), str(tmp_path / "n"))
    assert sorted(r.n or 0 for r in extract_csv(spark, numbers, "n long").collect()) == [0, 1]


def test_export_replaces_and_splits(spark, tmp_path):
    path = str(tmp_path / "out")
    export_csv(spark.range(10), path)
    export_csv(spark.range(100).coalesce(1), path, rows_per_file=30)
    assert len(list(Path(path).glob("part-*.csv"))) == 4
    assert extract_csv(spark, path, "id long").agg(F.sum("id")).first()[0] == 4950


def test_single_file(spark, tmp_path):
    path = export_csv(spark.range(50), str(tmp_path / "one"), single_file=True, rows_per_file=20)
    assert len(list(Path(path).glob("part-*.csv"))) == 1
    with pytest.raises(ValueError):
        export_csv(None, path)


def test_plain_files_are_split_and_quoted_line_breaks_are_not(spark, tmp_path):
    plain = export_csv(spark.range(200_000).selectExpr("id", "concat('some text, ', id) AS t"), str(tmp_path / "plain"), single_file=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert extract_csv(spark, plain, "id long, t string").rdd.getNumPartitions() > 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    broken = export_csv(spark.createDataFrame([(1, 'a\nb "c"'), (2, "d\re")], "id long, t string"), str(tmp_path / "broken"))
    assert sorted((r.id, r.t) for r in extract_csv(spark, broken, "id long, t string").collect()) == [(1, 'a\nb "c"'), (2, "d\re")]


def test_nested_and_binary_values_round_trip(spark, tmp_path):
    df = spark.createDataFrame([([1.5, 2.0], {"a": 1}, bytearray(b"\x00\xff"))], "a array<double>, m map<string,int>, b binary")
    back = extract_csv(spark, export_csv(df, str(tmp_path / "out")), df.schema)
    assert back.first() == df.first()


def test_every_missing_word(spark, tmp_path):
    file = tmp_path / "m.csv"
    file.write_text("n,s\n" + "".join(f'{i},"{word}"\n' for i, word in enumerate(MISSING_WORDS)) + "99,NAN\n", encoding="utf-8")
    found = extract_csv(spark, str(file), "n long, s string")
    assert found.where("s IS NOT NULL").collect()[0].s == "NAN"
    assert found.count() == len(MISSING_WORDS) + 1
    pd_missing = pd.read_csv(file)["s"].isna().sum()
    assert found.where("s IS NULL").count() == pd_missing


def test_columns_go_by_header_name(spark, tmp_path):
    file = tmp_path / "h.csv"
    file.write_text("b,a,c\n1,x,9\n", encoding="utf-8")
    assert extract_csv(spark, str(file), "a string, b long").first().asDict() == {"a": "x", "b": 1}


def test_values_of_another_type_fail(spark, tmp_path):
    file = tmp_path / "bad.csv"
    file.write_text("n\n1\nx\n", encoding="utf-8")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        extract_csv(spark, str(file), "n long").collect()


def test_inferred_types(spark, tmp_path):
    file = tmp_path / "i.csv"
    file.write_text(
        "w,f,e,b,t,n,l,m\n1,1.5,1e-3,True,2026-01-01 00:00:01,,99999999999999999999,1\n-2,2,inf,false,2026-01-02,NA,1,x\n",
        encoding="utf-8",
    )
    found = extract_csv(spark, str(file))
    want = ["bigint", "double", "double", "boolean", "string", "string", "string", "string"]
    assert [f.dataType.simpleString() for f in found.schema] == want
    first = found.orderBy(F.desc("w")).first()
    assert (first.w, first.f, first.e, first.b, first.t, first.n) == (1, 1.5, 0.001, True, "2026-01-01 00:00:01", None)


def test_a_header_alone_and_differing_headers(spark, tmp_path):
    file = tmp_path / "e.csv"
    file.write_text("a,b\n", encoding="utf-8")
    assert extract_csv(spark, str(file)).columns == ["a", "b"]
    assert extract_csv(spark, str(file), "a long, b string").count() == 0
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    (folder / "2.csv").write_text("b,a\n1,2\n", encoding="utf-8")
    with pytest.raises(Exception):
        extract_csv(spark, str(folder), "a long, b long").collect()


def test_durations(spark):
    cases = {"90": 90.0, "1s": 1.0, " 2.5M ": 150.0, "3 h": 10800.0, "4d": 345600.0, "5w": 3024000.0, "60.5": 60.5}
    df = spark.createDataFrame([(c,) for c in [*cases, None]], "s string").select("s", duration_seconds(F.col("s")).alias("n"))
    assert {r.s: r.n for r in df.collect()} == {**cases, None: None}
    for wrong in ("", "h", "-1s", "1 y", "1.s", "1h2"):
        with pytest.raises(Exception, match="not a duration"):
            spark.createDataFrame([(wrong,)], "s string").select(duration_seconds(F.col("s"))).collect()
