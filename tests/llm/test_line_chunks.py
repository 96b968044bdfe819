"""Chunks of lines on rows that the tables do not hold."""

from pyspark.sql import functions as F

from tablemill.llm.line_chunks import remove_repeated_chunks

BLOCK = "\n".join(f"shared line {i}" for i in range(40))


def test_shifted_block_goes_but_for_its_edges(spark):
    rows = [(1, BLOCK), (2, "a new first line\n" + BLOCK), (3, BLOCK + "\nand one after"), (4, "other\nlines")]
    got = {r.doc_id: r for r in remove_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[4].n_removed == 0
    assert got[1].kept_text == BLOCK
    for doc in (2, 3):
        assert got[doc].n_lines == 41
        assert 25 <= got[doc].n_removed <= 40
    assert "a new first line" in got[2].kept_text and "and one after" in got[3].kept_text


def test_odd_rows(spark):
    rows = [(None, BLOCK), (7, BLOCK), (7, BLOCK), (8, None), (9, ""), (10, "\n\n\n"), (11, "x" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("no", F.lit("x")).withColumn("key", F.lit(1))
    got = sorted(((r.doc_id, r.n_lines, r.n_removed > 0) for r in remove_repeated_chunks(df).collect()), key=str)
    assert [r for r in got if r[0] != 10] == sorted(
        [(None, 40, True), (7, 40, False), (7, 40, False), (8, 0, False), (9, 0, False), (11, 1, False)], key=str
    )
    assert [r[1] for r in got if r[0] == 10] == [4]


def test_short_passages_and_runs_of_equal_lines(spark):
    def around(no, passage):
        return "\n".join([f"before {no} {i}" for i in range(3)] + passage + [f"after {no} {i}" for i in range(3)])

    short = [[f"passage {p} line {i}" for i in range(4)] for p in range(60)]
    rows = [(2 * p + copy, around(2 * p + copy, passage)) for p, passage in enumerate(short) for copy in (0, 1)]
    rows += [(1000 + r, around(1000 + r, [f"the same {r // 2}"] * 40)) for r in range(40)]
    got = {r.doc_id: r for r in remove_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[2 * p].n_removed == 0 for p in range(60))
    assert sum(got[2 * p + 1].n_removed for p in range(60)) > 60 * 4 / 2
    assert sum(got[1001 + 2 * r].n_removed for r in range(20)) > 0.9 * 20 * 40
    # surroundings stay, and of each repeated line one copy
    kept = [line for r in got.values() for line in r.kept_text.split("\n")]
    assert {line for _, text in rows for line in text.split("\n")} == set(kept)
    assert all(kept.count(line) == 1 for line in kept if line.startswith(("before", "after")))


def test_empty_table(spark):
    assert remove_repeated_chunks(spark.createDataFrame([], "doc_id long, text string")).count() == 0
