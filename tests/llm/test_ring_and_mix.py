"""Sharding and mixing on rows that the tables do not hold."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablemill.llm.hash_ring import assign_shards, plan, ring
from tablemill.llm.mixing import mix


@pytest.mark.parametrize("n_shards", [1, 3, 24])
@pytest.mark.parametrize("counts", [{}, {5: 1}, {i: i % 7 for i in range(0, 16_384, 3)}, {9: 100_000, 10: 1}])
def test_plan_takes_every_row_once(n_shards, counts):
    counts = {cell: n for cell, n in counts.items() if n}
    seen, slots = Counter(), {}
    for cell, start, end, shard, slot in plan(counts, n_shards):
        seen.update((cell, rank) for rank in range(start, end))
        slots.setdefault(shard, []).extend(range(slot, slot + end - start))
    assert seen == Counter((cell, rank) for cell, n in counts.items() for rank in range(n))
    sizes = [len(slots.get(shard, [])) for shard in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


def test_a_further_shard_moves_few_rows():
    assert set(ring(24)) <= set(ring(25))
    counts = {cell: 10 for cell in range(16_384)}

    def places(n):
        return {(cell, rank): shard for cell, start, end, shard, _ in plan(counts, n) for rank in range(start, end)}

    before, after = places(24), places(25)
    moved = sum(before[key] != after[key] for key in before)
    # a plain remainder would move 96 percent
    assert moved < 0.2 * len(before)


def test_odd_rows_are_placed(spark):
    rows = [(None, None)] * 50 + [(1, "a")] * 30 + [(i, "x") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("old")).withColumn("count", F.lit(1))
    found = assign_shards(df, ["doc_id", "text"], 7).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 7
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(n)) for s, n in sizes.items())
    assert assign_shards(df.limit(0), ["doc_id"], 7).count() == 0


def test_mix_of_odd_rows(spark):
    rows = [(i, "a" if i % 3 else None, i % 11) for i in range(300)] + [(None, "b", 5), (None, "b", 5), (7, "c", 0), (8, "c", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("target", F.lit("x"))
    found = mix(df, "size", [3, 1, 2], 1.5).collect()
    assert len(found) == len(rows)
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        taken, target = sum(r.size * r._times for r in own), own[0]._target
        assert abs(taken - target) <= max(r.size for r in own) / 2
        assert target <= 2 * own[0]._source_size and max(r._times for r in own) <= 2
    assert sum({r.source: r._target for r in found}.values()) == pytest.approx(1.5 * sum(r[2] for r in rows))
    assert mix(df.limit(0), "size", [3, 1, 2], 1.5).count() == 0
