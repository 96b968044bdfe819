"""Vector codes against plain k-means in Python's integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemill.llm.vector_codes import Codebook, codebooks_sha256, compress, sequency_order, transform


def plainly(rows, parts, entries, rounds):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts)) * parts
    whole = lambda v: [math.floor(x * 1024) if abs(x) < 2**40 else int(x) * 1024 for x in v] + [0] * (width - len(v))
    cut = lambda v: [v[k * width // parts : (k + 1) * width // parts] for k in range(parts)]
    vectors = [(i, cut(whole(v)), label) for i, v, label in kept]
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][1]))[:entries]
    books = [[vectors[n][1][part] for n in first] for part in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda part, book: min((away(part, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        after = []
        for part, book in enumerate(books):
            hits = [[] for _ in book]
            for _, v, _ in vectors:
                hits[near(v[part], book)[1]].append(v[part])
            after.append([[sum(c) // len(h) for c in zip(*h)] if h else e for h, e in zip(hits, book)])
        books = after
    out = []
    for i, v, label in vectors:
        found = [near(v[part], books[part]) for part in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), min(sum(d for d, _ in found), 2**63 - 1)))
    sums = {}
    for _, label, _, error in out:
        sums[label] = sums.get(label, 0) + error
    return [(i, label, code, error, min(sums[label], 2**63 - 1)) for i, label, code, error in out], books


def made(seed, count=300, width=12, scale=1.0):
    draw = np.random.default_rng(seed)
    rows = [(n, [float(np.float32(x)) for x in draw.normal(0, scale, width)], int(draw.integers(0, 3)) if n % 4 else None) for n in range(count)]
    return rows + [(n, rows[0][1], 1) for n in range(count, count + 40)]


ODD = [(900, None, 1), (901, [1.0, None] + [0.0] * 10, 1), (902, [float("nan")] * 12, 2), (903, [float("-inf")] * 12, 2), (None, [0.5] * 12, 7), (None, [0.25] * 12, 7)]


@pytest.mark.parametrize("rows,entries,rounds", [
    (made(1) + ODD, 16, 4), (made(2, 20) + made(2, 20), 256, 2), (made(3, 50, 7) + [(77, [], None), (78, [1.0] * 3, 1)], 5, 3),
    (made(4, 60, 12, 1e-6), 8, 4), (made(5, 40, 4, 1e12), 6, 3), (made(6, 30, 8, 1e25) + [(99, [3.4e38] * 8, 1)], 4, 2),
])
def test_as_plain_k_means(spark, rows, entries, rounds):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    df = df.withColumns({"code": F.lit("x"), "error": F.lit(1)})
    coded, books = compress(df, parts=4, entries=entries, rounds=rounds)
    plain = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    want, want_books = plainly(plain, 4, entries, rounds)
    assert books == want_books
    key = lambda row: str(row)
    assert sorted((tuple(row) for row in coded.collect()), key=key) == sorted(want, key=key)


def test_empty_and_unusable(spark):
    for rows in ([], [(1, None, 1), (2, [float("nan")], 2)]):
        coded, books = compress(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
        assert coded.collect() == [] and books == [[], [], [], []]
        assert len(codebooks_sha256(books)) == 64


def test_search_is_exact_with_ties():
    draw = np.random.default_rng(0)
    for width in (1, 3, 8, 16):
        entries, parts = draw.integers(-3, 4, (37, width)), draw.integers(-4, 5, (700, width))
        entries[20] = entries[3]
        index, distance = Codebook(entries).nearest(parts)
        every = ((parts[:, None, :] - entries) ** 2).sum(axis=2)
        assert (index == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_rows_of_the_transform_are_in_sequency_order():
    signs = transform(np.eye(8, dtype=np.int64))[:, sequency_order(8)]
    assert [(np.diff(column) != 0).sum() for column in signs.T] == list(range(8))
    assert (signs.T @ signs == 8 * np.eye(8)).all()
