"""Removal of repeated windows against a comparison of all windows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tablemill.llm import repeats
from tablemill.llm.fm_substrings import remove_repeated_words
from tablemill.llm.suffix_dedup import remove_repeated_bytes

LAST = 1 << 70


def expected(rows, length, words):
    places = {}
    split = [((text or "").encode().split() if words else (text or "").encode()) for _, text in rows]
    ids = [LAST if doc is None else doc for doc, _ in rows]
    for doc, items in zip(ids, split):
        for at in range(len(items) - length + 1):
            places.setdefault(tuple(items[at : at + length]), []).append((doc, at))
    out = []
    for place, items in zip(ids, split):
        gone = [False] * len(items)
        for at in range(len(items) - length + 1):
            found = places[tuple(items[at : at + length])]
            if min(found) < (place, at) if words else len(found) > 1:
                gone[at : at + length] = [True] * length
        left = [item for item, out_ in zip(items, gone) if not out_]
        spans = sum(now and not before for now, before in zip(gone, [False, *gone]))
        kept = b" ".join(left) if words else bytes(left)
        out.append((place, len(items), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def sample(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 3 else "a" for i in range(8)]
    passages = [" ".join(draw.choices(vocabulary, k=draw.randrange(3, 30))) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [draw.choice([draw.choice(passages), " ".join(draw.choices(vocabulary, k=draw.randrange(12))), "\n x\t"]) for _ in range(draw.randrange(5))]
        rows.append((draw.choice([i, i, i, None, 3]), draw.choice([" ".join(parts)] * 3 + [None, "", "z " * 40])))
    return rows


@pytest.mark.parametrize("many", [1000, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, monkeypatch, many, seed):
    monkeypatch.setattr(repeats.Cut, "most_segments", many)
    rows = sample(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x")).withColumn("d", F.lit(1))
    for words, length, operator in ((True, 5, remove_repeated_words), (False, 17, remove_repeated_bytes)):
        got = [(LAST if r.doc_id is None else r.doc_id, r.n_items, r.n_removed, r.n_spans, r.kept_sha256) for r in operator(df, length).collect()]
        assert sorted(got, key=str) == expected(rows, length, words)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeated_words(df).count() == 0
    assert remove_repeated_bytes(df).count() == 0


def test_long_text(spark):
    text = "one two three " * 50_000
    df = spark.createDataFrame([(1, text), (2, "ab cd"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_items, r.n_removed) for r in remove_repeated_words(df).collect()}
    assert got == {1: (150_000, 149_997), 2: (2, 0), 3: (0, 0)}
    got = {r.doc_id: (r.n_items, r.n_removed) for r in remove_repeated_bytes(df).collect()}
    assert got == {1: (700_000, 700_000), 2: (5, 0), 3: (0, 0)}


def test_repeats_inside_one_segment(spark):
    """Short periodic rows, whose windows all pick equal grams, with windows longer than a gram."""
    phrase = "one two three four five six seven"
    words = [
        (1, "same " * 21), (2, " ".join(f"a{i}" for i in range(30)) + " word" * 34), (3, f"{phrase} " * 4), (4, "once " * 20),
        (5, " ".join(f"b{i}" for i in range(60))), (None, "last " * 25), (6, "twice " * 22), (7, "twice " * 23),
    ]
    letters = [(1, "=" * 201), (2, "-" * 368), (3, "x" * 200), (4, "head " + "ab" * 150 + " tail"), (None, "~" * 300), (5, "+" * 210), (6, "+" * 220)]
    for rows, length, operator in ((words, 20, remove_repeated_words), (letters, 200, remove_repeated_bytes)):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = [(LAST if r.doc_id is None else r.doc_id, r.n_items, r.n_removed, r.n_spans, r.kept_sha256) for r in operator(df, length).collect()]
        want = expected(rows, length, operator is remove_repeated_words)
        assert sorted(got, key=str) == want
        assert {row[0] for row in want if row[2]} >= {1, 2, LAST}


def test_texts_without_id_whose_short_hashes_meet(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    meet = (
        spark.range(150_000).select(F.concat(F.col("id").cast("string"), F.lit(f" {passage}")).alias("text"))
        .groupBy(F.hash("text")).agg(F.collect_list("text").alias("texts")).where("size(texts) > 1").limit(3).collect()
    )
    assert meet
    rows = [(1, passage)] + [(None, text) for pair in meet for text in pair.texts] + [(None, meet[0].texts[0] + " and its own end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(LAST if r.doc_id is None else r.doc_id, r.n_items, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeated_bytes(df, 50).collect()]
    assert sorted(got, key=str) == expected(rows, 50, False)


def thue_morse(length):
    """The word of two letters, of a length that is a power of 2, whose complement has the same sum of powers modulo 2^64."""
    word = "a"
    while len(word) < length:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_long_words_that_powers_do_not_tell_apart(spark):
    word = thue_morse(2048)
    other = word.translate(str.maketrans("ab", "ba"))
    around = [f"w{i}" for i in range(25)]
    rows = [(i, " ".join(around[:13] + [one] + around[13:])) for i, one in enumerate([word, other, word])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in remove_repeated_words(df).collect()}
    assert got == {0: 0, 1: 0, 2: 26}
