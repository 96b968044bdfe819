"""Near-duplicates and components against brute force."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tablemill.llm.components import components
from tablemill.llm.key_marks import with_marks
from tablemill.llm import minhash
from tablemill.llm.minhash import keep_one_of_each, near_duplicates, shingle_sets, sign, tiles
from tablemill.session import application_dir

LAST = (1 << 63) - 1


def reach(nodes, links):
    found = {node: node for node in nodes}

    def root(node):
        while found[node] != node:
            node = found[node]
        return node

    for u, v in links:
        a, b = sorted((root(u), root(v)))
        found[b] = a
    return {node: root(node) for node in nodes}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(40)]
    links += [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)]
    df = spark.createDataFrame(links, "u long, v long")
    nodes = {n for u, v in links if u != v for n in (u, v)}
    got = {r.node: r.component for r in components(df).collect()}
    assert got == reach(nodes, links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingles(text, width):
    words = (text or "").split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


@pytest.mark.parametrize("width", [2, 5])
def test_against_all_pairs(spark, width):
    draw = random.Random(width)
    rows = []
    for i in range(30):
        words = [f"w{draw.randrange(300)}" for _ in range(draw.randrange(1, 120))]
        for _ in range(draw.randrange(1, 6)):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            for _ in range(draw.randrange(3)):
                words[draw.randrange(len(words))] = f"x{draw.randrange(9)}"
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "one  "), (None, "alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("d", F.lit("x")).withColumn("size", F.lit(0))
    sets = {LAST if d is None else d: shingles((t or "").lower(), width) for d, t in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = reach(sets, links)
    got = near_duplicates(df, width).collect()
    assert len(got) == len(rows)
    for r in got:
        d = LAST if r.doc_id is None else r.doc_id
        assert (LAST if r.component_id is None else r.component_id) == want[d]
        assert r.kept == (want[d] == d)
        assert r.n_shingles == len(sets[d])


@pytest.mark.parametrize("seed", [4, 5])
def test_templated_texts_in_small_tiles(spark, seed, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    draw = random.Random(seed)
    template, rows = [f"t{i}" for i in range(100)], []
    for _ in range(25):
        words = list(template)
        for place in draw.sample(range(100), draw.randrange(4, 12)):
            words[place] = f"x{draw.randrange(10**6)}"
        rows.append((len(rows), " ".join(words)))
        for _ in range(draw.randrange(3)):
            words[draw.randrange(100)] = f"y{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    sets = {d: shingles(t, 2) for d, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = reach(sets, links)
    assert len(set(want.values())) > 3
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_tiles_are_bounded_and_meet_each_pair_once(spark):
    rows = spark.range(700).selectExpr("id AS d", "unhex(sha2(CAST(id AS STRING), 256)) AS set_key", "id % 3 = 0 AS outside", "3 AS seekers", "7 AS soughts")
    dealt = rows.select("d", "outside", F.explode(tiles()).alias("tile")).select("d", "outside", "tile.*").collect()
    met, held = {}, {}
    for row in dealt:
        held.setdefault((row.seeker, row.sought), []).append(row)
    for tile in held.values():
        assert len(tile) < 250
        for one in tile:
            if one.seeks:
                assert one.outside
                for other in tile:
                    if other.is_sought:
                        met[one.d, other.d] = met.get((one.d, other.d), 0) + 1
    assert set(met.values()) == {1} and len(met) == 234 * 700


def test_rows_without_id_are_documents_of_their_own(spark):
    draw = random.Random(11)
    text = lambda: " ".join(f"w{draw.randrange(10**6)}" for _ in range(100))
    near = lambda one: one + " and more"
    a, b, c, d = (text() for _ in range(4))
    rows = [(1, a), (None, near(a)), (2, b), (None, near(b)), (None, c), (None, near(c)), (None, d), (None, d), (3, None), (None, None)]
    rows += [(4, text())] * 3 + [(None, text()) for _ in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"a.b": F.lit("x"), "_row": F.lit(1), "d": F.lit(2)})
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(df, 5).collect() if r.doc_id or r.component_id}
    assert got == {(1, 1, True), (None, 1, False), (2, 2, True), (None, 2, False), (3, 3, True), (4, 4, True)}
    kept = keep_one_of_each(df, 5)
    assert kept.columns == df.columns
    left = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    of_c = [pair for pair in left if pair[1] in (c, near(c))]
    assert len(of_c) == 1
    rest = [(1, a), (2, b), (0, d), (3, ""), (0, ""), rows[10], *((0, one) for _, one in rows[13:])]
    assert left == sorted([*of_c, *rest])


def test_signatures_tell_large_sets_apart():
    import numpy as np
    import pyarrow as pa

    draw = random.Random(2)
    texts = [" ".join(f"{name}{draw.randrange(10**9)}" for _ in range(3000)) for name in "ab"]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array([1, 2], pa.int64()), "d": pa.array([1, 2], pa.int64()), "h": pa.array([1, 2], pa.int32()), "text": pa.array(texts),
    })
    one, two = (np.frombuffer(row, np.uint8) for row in next(sign(5)([batch])).column("bytes_of").to_pylist())
    assert np.diff(shingle_sets(pa.array(texts), 5)[1]).min() > 2900 and (one == two).sum() < 20


def shuffled_bytes(plan):
    """What the shuffles below a plan's node wrote, in the plan as it ran."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_bytes(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_bytes(plan.plan())
    own = plan.metrics().apply("dataSize").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled_bytes(plan.children().apply(i)) for i in range(plan.children().size()))


def test_kept_texts_are_not_shuffled(spark):
    draw = random.Random(21)
    texts = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(300)) for _ in range(300)]
    rows = list(enumerate(texts + [text + " and more" for text in texts[:10]]))
    rows += [rows[50], rows[50], (None, texts[0])]
    os.makedirs(application_dir(spark), exist_ok=True)
    before, tables = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), set(os.listdir(application_dir(spark)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
        got = sorted((r.doc_id, r.text) for r in kept.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == rows[:300]
    assert shuffled_bytes(kept._jdf.queryExecution().executedPlan()) < 0.2 * sum(map(len, texts))
    # what the search for links has stored is gone
    assert len(set(os.listdir(application_dir(spark))) - tables) == 1


def test_marks(spark):
    rows = spark.range(20_000).selectExpr("id AS d", "CAST(id % 7 AS INT) AS h", "'x' AS _row")
    keys = rows.where("d % 100 = 3").select("d", "h").unionByName(spark.createDataFrame([(-1, 0)], "d long, h int"))
    marked = with_marks(rows, keys, ["d", "h"])
    assert marked.columns == ["d", "h", "_row", "_marked"] and marked.count() == 20_000
    found = {r.d for r in marked.where("_marked").collect()}
    assert found >= {d for d in range(20_000) if d % 100 == 3} and len(found) < 220
    assert with_marks(rows, keys.limit(0), ["d", "h"]).where("NOT _marked").count() == 20_000


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
