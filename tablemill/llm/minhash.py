"""Near-duplicate documents by MinHash with banding, verified links and connected components.

Documents with the same set of shingles form a class, known by a hash of the set; its first document
stands for it.  Signatures of the classes are cut into bands, and classes that agree in a band meet in a
bucket.  A bucket never gives all its pairs: its first member is compared with all others, and links
join members to components.  Pairs inside one component cannot change the result, so what is left to compare
is pairs across components of a bucket; most buckets have none, and in the others signatures are compared first.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablemill.llm.anchors import gram_hashes, mixed, range_hashes, word_hashes
from tablemill.llm.arrow_text import raw_bytes, slices, word_places
from tablemill.llm.components import components
from tablemill.llm.key_marks import with_marks
from tablemill.llm.repeats import BYTE_HASH, NO_ID
from tablemill.llm.staged import passing, stage

# At a similarity of 0.8 a pair agrees in none of 40 bands of 5 with a chance of 1.3e-7.
BANDS, ROWS = 40, 5
# Members of a bucket in a block; a task compares two blocks at a time.
BLOCK = 2_000
PART_BYTES = 16 << 20
_draw = np.random.default_rng(20240611)
FACTORS = _draw.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SUMMANDS = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)

SIGNED = "doc_id long, d long, h int, n_shingles long, set_key binary, bands array<long>, bytes_of binary"


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, and the bounds of each text's in them.

    Shingles are ``width`` words, A-Z in lower case; a text with fewer words has them all as one.
    """
    raw, starts = raw_bytes(texts)
    raw = raw + np.uint8(32) * ((raw >= 65) & (raw <= 90)).astype(np.uint8)
    begins, ends, bounds = word_places(raw, starts)
    items = word_hashes(raw, begins, ends, BYTE_HASH)
    counts = np.diff(bounds)
    grams = gram_hashes(items, width) if len(items) >= width else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(counts)), counts)
    whole = np.arange(len(items)) + width <= bounds[1:][row]
    few = np.nonzero((counts > 0) & (counts < width))[0]
    hashes = np.concatenate([mixed(grams)[whole[: len(grams)]], range_hashes(items, bounds[few], bounds[few + 1])])
    row = np.concatenate([row[: len(grams)][whole[: len(grams)]], few])
    by = np.lexsort((hashes, row))
    hashes, row = hashes[by], row[by]
    new = np.ones(len(by), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.searchsorted(row[new], np.arange(len(counts) + 1))


def minima_of(hashes: np.ndarray, begins: np.ndarray, times: int) -> np.ndarray:
    """The smallest hash of each set under each of the first universal hash functions; no set is empty."""
    minima = np.zeros((times, len(begins)), np.uint64)
    if len(begins):
        for at in range(times):
            minima[at] = np.minimum.reduceat(hashes * FACTORS[at] + SUMMANDS[at], begins)
    return minima


def short_sets(width: int):
    """A task that gives each document's set with 32 bits a shingle; few shingles of a set fall together."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 19):
            hashes, bounds = shingle_sets(part.column("text"), width)
            short = (hashes >> np.uint64(32)).astype(np.uint32)
            sets = [np.unique(short[start:end]).tobytes() for start, end in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_pydict(
                {**{name: part.column(name) for name in ("set_key", "bytes_of")}, "short": pa.array(sets, pa.binary())}
            )

    return rows


def sign(width: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 19):
            hashes, bounds = shingle_sets(part.column("text"), width)
            sizes = np.diff(bounds)
            full = np.nonzero(sizes)[0]
            minima = minima_of(hashes, bounds[full], BANDS * ROWS)
            bands = np.zeros((len(full), BANDS), np.uint64)
            for band in range(BANDS):
                key = np.full(len(full), band + 1, np.uint64)
                for value in minima[band * ROWS : (band + 1) * ROWS]:
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + value)
                bands[:, band] = key
            # the sums of two mixings tell sets apart, whatever their order
            keys = np.zeros((len(sizes), 2), np.uint64)
            if len(full):
                keys[full, 0] = np.add.reduceat(mixed(hashes), bounds[full])
                keys[full, 1] = np.add.reduceat(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), bounds[full])
            has = sizes > 0
            # a minimum of many hashes begins with zeros, so the byte comes from its mixing
            packed = (mixed(minima) >> np.uint64(56)).astype(np.uint8).T
            number = np.cumsum(has) - 1
            yield pa.RecordBatch.from_pydict(
                {
                    **{name: part.column(name) for name in ("doc_id", "d", "h")},
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "set_key": pa.array([keys[i].tobytes() if has[i] else None for i in range(len(sizes))], pa.binary()),
                    "bands": pa.array([bands[number[i]].astype(np.int64) if has[i] else None for i in range(len(sizes))], pa.list_(pa.int64())),
                    "bytes_of": pa.array([packed[number[i]].tobytes() if has[i] else None for i in range(len(sizes))], pa.binary()),
                }
            )

    return rows


def least_equal(percent: int, times: int) -> int:
    """Equal minima of so many that a pair of that similarity has, but for a chance of about 1e-7."""
    share = percent / 100
    return math.floor(share * times - 5.3 * math.sqrt(share * (1 - share) * times))


def verify(width: int, percent: int):
    """Links among pairs: first by the share of equal minima, then by the sets themselves."""
    least = least_equal(percent, BANDS * ROWS)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text_b", 1 << 19):
            column = {name: part.column(name) for name in part.schema.names}
            signs = [
                np.frombuffer(b"".join(column[name].to_pylist()), np.uint8).reshape(-1, BANDS * ROWS) for name in ("bytes_a", "bytes_b")
            ]
            alike = np.nonzero((signs[0] == signs[1]).sum(axis=1) >= least)[0]
            linked = np.zeros(part.num_rows, bool)
            if len(alike):
                taken = pa.array(alike)
                sets = [shingle_sets(column[name].take(taken), width) for name in ("text_a", "text_b")]
                for at, pair in enumerate(alike):
                    a, b = (hashes[bounds[at] : bounds[at + 1]] for hashes, bounds in sets)
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    linked[pair] = 100 * both >= percent * (len(a) + len(b) - both)
            mask = pa.array(linked)
            yield pa.RecordBatch.from_pydict({"u": column["d_a"].filter(mask), "v": column["d_b"].filter(mask)})

    return rows


def across_components(percent: int):
    """A task that gives the pairs of buckets' members in different components that are similar enough.

    Only members outside the component of the bucket's first one look for partners.  Signatures are
    compared first, then short sets, with the shingles that fall together there counted as shared.
    """
    least = least_equal(percent, BANDS * ROWS)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        band, seeker, sought, seeks, is_sought, d, size, component, outside = (
            table.column(name).to_numpy()
            for name in ("band", "seeker", "sought", "seeks", "is_sought", "d", "size", "component", "outside")
        )
        signs = np.frombuffer(b"".join(table.column("bytes_of").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
        sets = [np.frombuffer(one, np.uint32) for one in table.column("short").to_pylist()]
        order = np.lexsort((sought, seeker, band))
        new = np.append(True, np.any([of[order[1:]] != of[order[:-1]] for of in (band, seeker, sought)], axis=0))
        left, right = [], []
        for group in np.split(order, np.nonzero(new)[0][1:]):
            here = group[is_sought[group]]
            for one in group[seeks[group]]:
                fits = (component[here] != component[one]) & (
                    100 * np.minimum(size[here], size[one]) >= percent * np.maximum(size[here], size[one])
                )
                # of two outsiders the one with the smaller id looks for the other
                fits &= ~outside[here] | (d[here] > d[one])
                found = here[fits]
                found = found[(signs[found] == signs[one]).sum(axis=1) >= least]
                if not len(found):
                    continue
                # all partners at once: how many of their shingles does this set hold
                lengths = np.array([len(sets[other]) for other in found])
                held_by = np.isin(np.concatenate([sets[other] for other in found]), sets[one])
                shared = np.add.reduceat(held_by, np.cumsum(lengths) - lengths, dtype=np.int64)
                shared += size[found] - lengths + size[one] - len(sets[one])
                found = found[100 * shared >= percent * (size[found] + size[one] - shared)]
                left += [one] * len(found)
                right += found.tolist()
        first, second = pa.array(left, pa.int64()), pa.array(right, pa.int64())
        yield from pa.table(
            {
                "key_a": table.column("set_key").take(first), "d_a": table.column("d").take(first),
                "set_key": table.column("set_key").take(second), "d": table.column("d").take(second),
            }
        ).to_batches()

    return rows


def tiles() -> Column:
    """The tiles of a bucket's member: (seeker, sought) are the numbers of the two blocks, and what it does there.

    Every member is sought in one block, by each block of seekers; one outside also seeks, in each block of
    members.  So a tile holds about two blocks however large the bucket is, and meets each pair once.
    """
    seeker, sought = (F.pmod(F.xxhash64("set_key"), F.col(blocks)).cast("int") for blocks in ("seekers", "soughts"))

    def blocks(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    def tile(a: Column, b: Column, seeks: Column, is_sought: Column) -> Column:
        return F.struct(a.alias("seeker"), b.alias("sought"), seeks.alias("seeks"), is_sought.alias("is_sought"))

    as_sought = F.transform(blocks("seekers"), lambda a: tile(a, sought, F.col("outside") & (a == seeker), F.lit(True)))
    others = F.filter(blocks("soughts"), lambda b: F.col("outside") & (b != sought))
    return F.concat(as_sought, F.transform(others, lambda b: tile(seeker, b, F.lit(True), F.lit(False))))


# Rows without doc_id are nodes from here on, one for each text.
FIRST_WITHOUT_ID = 1 << 62


def node_of() -> tuple[Column, Column]:
    """A row's node and a hash of its text; together they are its key."""
    own = F.lit(FIRST_WITHOUT_ID) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    return F.coalesce(F.col("doc_id").cast("long"), own), F.hash("text")


def noded(df: DataFrame) -> DataFrame:
    """doc_id and text with the row's key (d, h)."""
    node, text_hash = node_of()
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", node.alias("d"), text_hash.alias("h"))


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, d, h, n_shingles, component_id and kept of every row of ``df`` (doc_id, text).

    Rows are linked if their sets of shingles have at least ``percent`` percent of their union in common;
    every pair that meets in a band and could join two components is compared on full sets.  component_id is
    the smallest doc_id that can be reached, and the row with that doc_id is kept.  Rows without doc_id are documents of
    their own, one for each text, and come after all others, whose ids are below 2 to the 62; where none
    but such rows are linked, component_id is NULL and one text of them is kept.
    NULL and empty texts have no set and are linked with nothing.  Rows that agree in doc_id and are the first
    of their sets count as one document.  An empty frame gives no rows; other columns are ignored.
    """
    spark, rows = df.sparkSession, noded(df)
    signed = stage(rows.mapInArrow(sign(width), SIGNED), "signed")
    classes = stage(
        signed.where("n_shingles > 0").groupBy("set_key").agg(
            F.min(F.struct("d", "h")).alias("first"), F.first("n_shingles").alias("size"),
        ).select("set_key", "first.*", "size"),
        "classes",
    )
    firsts = stage(
        classes.join(signed.select("d", "h", "set_key", "bands", "bytes_of"), ["d", "h", "set_key"]).dropDuplicates(["set_key"]), "firsts"
    )
    banded = firsts.select("set_key", "d", "size", F.explode("bands").alias("band"))
    leaders = stage(
        banded.groupBy("band").agg(F.min(F.struct("d", "set_key")).alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
            "band", F.col("leader.d").alias("d_a"), F.col("leader.set_key").alias("key_a")
        ),
        "leaders",
    )
    members = stage(banded.join(leaders, "band"), "members")
    needed = stage(
        firsts.join(members.select("set_key").distinct(), "set_key", "left_semi").select("set_key", "d", "h", "bytes_of"), "needed"
    )
    # most texts meet no other and stay where they are
    texts = with_marks(rows.select("d", "h", "text"), needed, ["d", "h"]).where("_marked")
    content = stage(texts.join(needed, ["d", "h"]).select("set_key", "text", "bytes_of").dropDuplicates(["set_key"]), "content")

    def compare(pairs: DataFrame) -> DataFrame:
        """Links among pairs (key_a, d_a, set_key, d)."""
        pairs = stage(pairs.where("key_a <> set_key").distinct(), "pairs")
        left = content.select(F.col("set_key").alias("key_a"), F.col("text").alias("text_a"), F.col("bytes_of").alias("bytes_a"))
        right = content.select("set_key", F.col("text").alias("text_b"), F.col("bytes_of").alias("bytes_b"))
        met = pairs.join(left, "key_a").join(right, "set_key")
        return stage(
            met.select("d_a", F.col("d").alias("d_b"), "text_a", "text_b", "bytes_a", "bytes_b").mapInArrow(
                verify(width, percent), "u long, v long"
            ),
            "links",
        )

    links = compare(members.select("key_a", "d_a", "set_key", "d"))
    reached = stage(components(links), "reached")
    # members with their components; in a bucket with several, those outside its first member's are left to compare
    apart = (
        members.join(reached.withColumnRenamed("node", "d"), "d", "left")
        .withColumn("component", F.coalesce("component", "d"))
        .join(reached.select(F.col("node").alias("d_a"), F.col("component").alias("component_a")), "d_a", "left")
        .withColumn("outside", F.col("component") != F.coalesce("component_a", "d_a"))
        .select("band", "set_key", "d", "size", "component", "outside")
    )
    apart = stage(apart, "members-apart")
    open_bands = stage(
        apart.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.count_if("outside").alias("n_outside")).where("n_outside > 0")
        .select("band", *[F.ceil(F.col(n) / BLOCK).cast("int").alias(blocks) for n, blocks in (("n_outside", "seekers"), ("n", "soughts"))]),
        "open-bands",
    )
    # a large bucket is dealt out in tiles: a block of those outside, which seek partners, and a block of all its members
    still = stage(apart.join(open_bands, "band"), "still-apart")
    sets = content.join(still.select("set_key").distinct(), "set_key", "left_semi")
    sets = stage(sets.mapInArrow(short_sets(width), "set_key binary, bytes_of binary, short binary"), "short-sets")
    dealt = still.select("band", "set_key", "d", "size", "component", "outside", F.explode(tiles()).alias("tile"))
    dealt = dealt.select("band", "set_key", "d", "size", "component", "outside", "tile.*")
    n_bytes = dealt.agg(F.sum(F.col("size") * 4 + 300)).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(n_bytes / PART_BYTES))
    pairs = dealt.join(sets, "set_key").repartition(parts, "band", "seeker", "sought").mapInArrow(
        across_components(percent), "key_a binary, d_a long, set_key binary, d long"
    )
    more = compare(pairs)
    if not more.isEmpty():
        reached = stage(components(links.unionByName(more)), "reached")
    of_class = stage(
        classes.join(reached.withColumnRenamed("node", "d"), "d", "left").select("set_key", F.coalesce("component", "d").alias("component")),
        "class-components",
    )
    found = signed.join(of_class, "set_key", "left").withColumn("component", F.coalesce("component", "d"))
    return found.select(
        "doc_id", "d", "h", "n_shingles",
        F.when(F.col("component") < FIRST_WITHOUT_ID, F.col("component")).alias("component_id"),
        (F.col("d") == F.col("component")).alias("kept"),
    )


def keep_one_of_each(df: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` (doc_id, text and any other columns) that ``near_duplicates`` keeps, unchanged.

    Of rows that agree in doc_id and text one stays.
    """
    with passing():
        found = near_duplicates(df, width, percent).groupBy("d", "h").agg(
            F.count_if("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows")
        )
        # all other rows stay, and need not be looked up
        doubtful = found.where("_kept = 0 OR _rows > 1")
        doubtful = stage(doubtful.select(F.col("d").alias("_d"), F.col("h").alias("_h"), "_kept"), "doubtful", lasting=True)
    node, text_hash = node_of()
    row = F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in df.columns])
    rows = df.select(row.alias("_row"), node.alias("_d"), text_hash.alias("_h"), F.col("text").alias("_text"))
    rows = with_marks(rows, doubtful, ["_d", "_h"])
    looked_up = rows.where("_marked").join(doubtful, ["_d", "_h"], "left").where("_kept IS NULL OR _kept > 0")
    # texts that differ although their hashes agree both stay
    several = looked_up.dropDuplicates(["_d", "_text"])
    return rows.where("NOT _marked").select("_row").union(several.select("_row")).select("_row.*")


def keep_keys(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """A semi or anti join of ``df`` to row keys (_d, _h)."""
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return df.join(keys, (d == keys["_d"]) & (F.xxhash64(df["text"]) == keys["_h"]), how)
