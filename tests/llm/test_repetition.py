"""Repetition measures against a comparison of all suffixes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemill.llm.repetition import judge, keep_varied, repeated_for, repetition_stats


def longest_elsewhere(words):
    n, out = len(words), []
    for i in range(n):
        best = 0
        for j in range(n):
            same = 0
            while i != j and max(i, j) + same < n and words[i + same] == words[j + same]:
                same += 1
            best = max(best, same)
        out.append(best)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_longest_repeats(seed):
    draw = random.Random(seed)
    for _ in range(40):
        rows = [[draw.randrange(draw.choice([1, 2, 3, 9])) for _ in range(draw.randrange(40))] for _ in range(draw.randrange(1, 5))]
        ids = np.array(sum(rows, []), dtype=np.int64)
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        end = np.repeat(np.cumsum([len(r) for r in rows]), [len(r) for r in rows])
        assert list(repeated_for(ids, row, end)) == sum(map(longest_elsewhere, rows), [])


def test_verdicts(spark):
    varied = " ".join(f"w{i}" for i in range(300))
    rows = [
        (1, varied), (2, " ".join(varied.split()[:49])), (3, "the the " * 100), (4, varied + "\n" + " ".join(varied.split()[:120])),
        (5, None), (6, ""), (7, varied), (7, varied), (None, varied), (8, " ".join(f"t{i}" for i in range(200_000))),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("x"))
    got = judge(repetition_stats(df)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert {d for d, r in by.items() if r.kept} == {1, 7, 8, None}
    assert {d for d, r in by.items() if r.base_failed} == {2, 3, 4, 5, 6}
    assert by[4].longest_repeat == 120 and by[4].n_covered_words == 240 and by[3].longest_repeat == 199
    kept = keep_varied(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "7", "7", "8", "None"])
    assert keep_varied(df.limit(0)).count() == 0
