"""CSV with line breaks inside quotes, cut at every place, against Python's reader."""

import csv
import random

import pytest

from tablemill.operators.csv_export import export_csv
from tablemill.sources.csv_records import csv_with_breaks
from tablemill.sources.files import extract_csv

PIECES = ["a", "b c", "\n", "\n\n", "\r\n", '"', '""', ",", "é", "x" * 40, "", "'", "\\"]


def rows_of(seed, count=120):
    draw = random.Random(seed)
    return [[str(n), "".join(draw.choices(PIECES, k=draw.randint(0, 6))), "".join(draw.choices(PIECES, k=2))] for n in range(count)]


def write(path, rows, end="\n"):
    with open(path, "w", newline="") as file:
        csv.writer(file, lineterminator=end).writerows([["id", "a b", "c.d"], *rows])


@pytest.mark.parametrize("seed,piece,end", [(1, "64b", "\n"), (2, "257b", "\r\n"), (3, "1g", "\n"), (4, "1000b", "\n")])
def test_records_across_pieces(spark, tmp_path, seed, piece, end):
    rows = rows_of(seed)
    for number in range(3):
        write(tmp_path / f"{number}.csv", rows[number::3], end)
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        found = csv_with_breaks(spark, str(tmp_path))
        assert found.columns == ["id", "a b", "c.d"]
        got = sorted((int(r[0]), r[1] or "", r[2] or "") for r in found.collect())
        many = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == [(int(n), a, c) for n, a, c in rows] and (piece == "1g" or many > 3)


def test_same_rows_as_one_task(spark, tmp_path):
    df = spark.createDataFrame([(n, a, None if n % 5 else c) for n, (_, a, c) in enumerate(rows_of(9))], "id long, `a b` string, c string")
    path = export_csv(df, str(tmp_path / "out"))
    split, whole = extract_csv(spark, path, df.schema), extract_csv(spark, path, df.schema, multiline=True)
    assert split.exceptAll(whole).count() == 0 and split.count() == whole.count() == 120
    assert "MapIn" not in split._jdf.queryExecution().toString()


def test_files_that_are_not_so_made(spark, tmp_path):
    for name, text in (("stray", 'id,v\n1,5" pipe\n2,"a\nb"\n'), ("twice", 'v,v\n1,"a\nb"\n')):
        (tmp_path / f"{name}.csv").write_text(text)
        assert csv_with_breaks(spark, str(tmp_path / f"{name}.csv")) is None
    for name, header in (("one", "id,v"), ("two", "id,w")):
        (tmp_path / "mixed").mkdir(exist_ok=True)
        (tmp_path / "mixed" / f"{name}.csv").write_text(f'{header}\n1,"a\nb"\n')
    assert csv_with_breaks(spark, str(tmp_path / "mixed")) is None
    (tmp_path / "empty.csv").write_text("")
    assert csv_with_breaks(spark, str(tmp_path / "empty.csv")) is None
