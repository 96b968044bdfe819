"""Collocations against plain counting of all n-grams."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemill.llm import collocations as module
from tablemill.llm.collocations import collocations

GAP, PIECE = re.compile(r"[^\x20\x09]+"), re.compile(r"[.,;:!?\x0A-\x0D]")


def by_counting(rows, least, covered, most, scale=2_000_000):
    upper = {ord(a): b for a, b in zip(module.UPPER, module.LOWER)}
    counts, n = Counter(), Counter()
    for lang, text in rows:
        for piece in PIECE.split((text or "").translate(upper)):
            words = GAP.findall(piece)
            n[lang or "und" if lang is None else lang] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    counts[lang if lang is not None else "und", tuple(words[at : at + size])] += 1
    frequent = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}
    found = []
    for (lang, words), a in frequent.items():
        cuts = [(scale * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        around = [
            f for (other, longer), f in frequent.items()
            if other == lang and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        ]
        if not any(100 * f >= covered * a for f in around):
            found.append((lang, -score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    found.sort()
    ranks, out = Counter(), []
    for lang, score, a, phrase, l, r in found:
        ranks[lang] += 1
        if ranks[lang] <= most:
            out.append((lang, ranks[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return out


def texts(seed):
    draw = np.random.default_rng(seed)
    words = ["New", "york", "city", "the", "of", "é", "ü!", "a,b", "x\x0by", "\x0c", "0", "ＮＥＷ", "nul\x00l", "it's"]
    gaps = [" ", "  ", "\t", " \t ", "\n", ". "]
    for _ in range(60):
        size = int(draw.integers(0, 40))
        yield "".join(words[int(w)] + gaps[int(g)] for w, g in zip(draw.integers(0, len(words), size), np.minimum(draw.geometric(0.6, size) - 1, 5)))


@pytest.mark.parametrize("least,most,size", [(3, 2000, 8 << 20), (4, 7, 200), (2, 50, 1)])
def test_as_counted(spark, monkeypatch, least, most, size):
    monkeypatch.setattr(module, "COUNTED_BYTES", size)
    rows = [(lang, text) for number, lang in enumerate(["en", None, "und", "de"]) for text in [*texts(number), None, "", " ", "new york " * 30]]
    rows += [("fr", "jamais vu")] * 3 + [("lonely", "word")]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("n", F.lit(1)).withColumn("w1", F.lit("x"))
    got = sorted(tuple(row) for row in collocations(df, least=least, covered=80, most=most).collect())
    want = by_counting([("und" if lang is None else lang, text) for lang, text in rows], least, 80, most)
    assert got == sorted(want) and want


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """Pairs that pass by chance only cost windows."""
    rows = [("en", text) for text in texts(5)]
    df = spark.createDataFrame(rows, "lang string, text string")
    want = sorted(tuple(row) for row in collocations(df, least=3).collect())
    monkeypatch.setattr(module, "frequent_grams", lambda *_: np.full(module.FILTER_BITS // 8, 255, np.uint8))
    assert sorted(tuple(row) for row in collocations(df, least=3).collect()) == want != []


def test_scores_stay_exact_beyond_64_bits(spark):
    df = spark.createDataFrame([("en", "a b " * 3)], "lang string, text string")
    got = [(row.phrase, row.score) for row in collocations(df, least=2, scale=10**9).collect()]
    assert got and all(score <= 10**9 for _, score in got)


def test_empty_frame(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations(df).collect() == []
    assert collocations(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")).collect() == []
