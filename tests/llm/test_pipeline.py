"""The pipeline against a plain version of each stage, and on odd rows."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablemill.llm.decontamination import judge_documents
from tablemill.llm.queries import table
from tablemill.llm.repetition import judge, repetition_stats
from tests.llm.test_near_duplicates import reach, shingles

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before the first stage and after each."""
    docs, found = table(spark, SF_DIR, "documents"), []
    found.append((docs, docs.collect()))
    for name, apply in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(apply(spark, docs, SF_DIR), name)
        found.append((docs, docs.collect()))
    return found


def test_columns(steps):
    for docs, _ in steps[1:-1]:
        assert docs.columns == steps[0][0].columns
    assert steps[-1][0].columns == [*steps[0][0].columns, "shard", "slot"]


def test_quality(spark, steps):
    kept = judge(repetition_stats(steps[0][0])).where("kept").select("doc_id").collect()
    assert sorted(r.doc_id for r in steps[1][1]) == sorted(r.doc_id for r in kept)
    assert len(steps[1][1]) < len(steps[0][1])


def test_near_dedup(steps):
    sets = {r.doc_id: shingles(r.text.encode().decode().lower(), 5) for r in steps[1][1]}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = {doc for doc, root in reach(sets, links).items() if doc == root}
    assert {r.doc_id for r in steps[2][1]} == want


def test_decontamination(spark, steps):
    held = judge_documents(steps[2][0], table(spark, SF_DIR, "benchmark")).where("NOT kept").collect()
    assert {r.doc_id for r in steps[3][1]} == {r.doc_id for r in steps[2][1]} - {r.doc_id for r in held}


def test_mix(steps):
    sources, taken = defaultdict(list), Counter(r.doc_id for r in steps[4][1])
    for r in steps[3][1]:
        draw = hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()
        sources[r.source].append((draw, r.doc_id, len(r.text.split())))
    size = {source: sum(one[2] for one in docs) for source, docs in sources.items()}
    weight = {source: (3, 1, 2)[i % 3] for i, source in enumerate(sorted(size))}
    free, left, target = set(size), 1.5 * sum(size.values()), {}
    while True:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total >= 2 * size[s]}
        if not above:
            break
        target |= {s: 2.0 * size[s] for s in above}
        left -= sum(2 * size[s] for s in above)
        free -= above
    target |= {s: left * weight[s] / total for s in free}
    for source, docs in sources.items():
        got = sum(taken[doc] * n for _, doc, n in docs)
        assert abs(got - target[source]) <= max(n for _, _, n in docs) / 2 + 1
    assert max(taken.values()) <= 2


def test_shards(steps):
    counts = Counter(r.shard for r in steps[5][1])
    assert len(steps[5][1]) == len(steps[4][1])
    assert max(counts.values()) - min(counts.get(shard, 0) for shard in range(24)) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in steps[5][1] if r.shard == shard) == list(range(n))


def test_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(80))
    long_ = " ".join(f"term{i}" for i in range(60_000))
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text, None, None, None), (None, None, None, None, None),
            (3, "", "en", "a", 0), (None, long_, "en", None, 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, size long, d long, key int"
    docs = spark.createDataFrame([(*row, "x", 1, 2, 3) for row in rows], schema)
    for name, apply in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(apply(spark, docs, SF_DIR), name)
    found = docs.collect()
    assert {r.doc_id for r in found} == {1, None}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, apply in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(apply(spark, docs, SF_DIR), name)
    assert docs.count() == 0
