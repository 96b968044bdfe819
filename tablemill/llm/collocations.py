"""Collocations: phrases of two to four words that are far more frequent than their parts let expect.

Only the longest windows are counted: each word with the three that follow it in its piece, padded where
the piece ends.  Counts of shorter phrases are sums over the windows that begin with them, and Spark's ROLLUP
gives these sums for all shorter prefixes at once, so no n-grams of lower orders are made.

Most windows of a corpus occur once.  First passes therefore count hashes of two and of three neighbouring words; a
hash seen fewer than ``least`` times stands for words that no candidate can hold together, and windows are padded
from there on.  Words that are in no other pairs begin no window and only add to the number of words.  Words that share
a hash only make the count too large, and what passes travels as a Bloom filter of fixed size, which errs on that
side as well: what is padded is never needed, so results stay exact at any size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablemill.llm.arrow_text import gathered, raw_bytes
from tablemill.llm.staged import stage
from tablemill.operators.batches import top_per_batch

ORDER = 4
WORDS = [f"w{number}" for number in range(1, ORDER + 1)]
NO_LANGUAGE = "und"
# Texts that are counted together before their windows are shuffled.
COUNTED_BYTES = 2 << 20
WORDS_AT_ONCE = 1 << 15
# Stands between a language and the first word of a window; words do not hold it.
MARK = "\x0b"
# Smaller partitions of the input are counted together, for fewer rows to shuffle.
TASK_BYTES = 64 << 20
# The Bloom filter's size in bits, whatever the input.
FILTER_BITS = 1 << 27
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

IS_GAP = np.zeros(256, bool)
IS_GAP[[0x20, 0x09]] = True
ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True


# One multiplier per place in a word; words that are longer use them again.
PLACES = np.frombuffer(b"".join(xxhash.xxh3_128_digest(bytes([n])) for n in range(128)), np.uint64) | np.uint64(1)


class Occurrences:
    """All words of some texts in order, by hashes of language and word."""

    def __init__(self, texts: pa.Array, languages: pa.Array):
        raw, starts = raw_bytes(texts)
        ends_piece = ENDS_PIECE[raw]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = ~(IS_GAP[raw] | ends_piece)
        begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
        # where a text begins, a word ends and another begins
        edge = starts[(starts > 0) & (starts < len(raw))]
        begins[edge], ends[edge] = inside[edge + 1], inside[edge]
        first = np.nonzero(begins)[0]
        self.lengths = (np.nonzero(ends)[0] - first).astype(np.int32)
        self.letters = raw[inside[1:-1]]
        #: whether a word and the next one are in the same piece
        self.joined = np.ones(len(first), bool)
        for cuts in (np.nonzero(ends_piece)[0], starts[1:]):
            following = np.searchsorted(first, cuts)
            self.joined[following[following > 0] - 1] = False
        spoken = languages.dictionary_encode()
        self.languages = spoken.dictionary
        of_text = spoken.indices.to_numpy(zero_copy_only=False)
        #: the language of each word
        self.spoken = np.repeat(of_text, np.diff(np.searchsorted(first, starts)))
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        """32 bits for each word in its language."""
        bounds = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        sums = np.zeros(len(self.lengths), np.uint64)
        for start in range(0, len(sums), WORDS_AT_ONCE):
            stop = min(start + WORDS_AT_ONCE, len(sums))
            letters = self.letters[bounds[start] : bounds[stop]].astype(np.uint64) + np.uint64(1)
            begins = bounds[start:stop] - bounds[start]
            place = np.arange(len(letters)) - np.repeat(begins, self.lengths[start:stop])
            letters *= PLACES[place % len(PLACES)]
            sums[start:stop] = np.add.reduceat(letters, begins)
        seeds = np.array([xxhash.xxh3_64_intdigest(name) for name in self.languages.to_pylist()], np.uint64)
        mixed = (sums ^ seeds[self.spoken]) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)

    def pairs(self) -> np.ndarray:
        """The hashes of each word and the next one, whether joined or not; none for the last."""
        return self.hashes[:-1] << np.uint64(32) | self.hashes[1:]

    def triples(self) -> np.ndarray:
        """A hash of each word and the next two, whether joined or not; none for the last two."""
        mixed = self.pairs()[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ self.hashes[2:]
        return (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)

    def chosen(self, kept: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Numbers of the words that are kept, and languages and words by number."""
        letters = np.ascontiguousarray(self.letters[np.repeat(kept, self.lengths)])
        offsets = np.concatenate([[0], np.cumsum(self.lengths[kept])]).astype(np.int32)
        spelled = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
        code, size = spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(spelled.dictionary))
        met, ids = np.unique(self.spoken[kept] * size + code, return_inverse=True)
        return ids, self.languages.take(pa.array(met // size)), spelled.dictionary.take(pa.array(met % size))


def probes(keys: np.ndarray) -> list[np.ndarray]:
    """The filter's bits of each pair, or of each word, whose keys are below 2 to the 32."""
    mixed = (keys + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD1B54A32D192ED03)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    size = np.uint64(FILTER_BITS)
    return [(mixed >> np.uint64(37)).astype(np.int64) % FILTER_BITS, ((mixed ^ (mixed >> np.uint64(31))) % size).astype(np.int64)]


def passes(seen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter holds each key."""
    one, two = ((seen[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool) for bit in probes(keys))
    return one & two


def occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[Occurrences]:
    for part in gathered(batches, "text", COUNTED_BYTES):
        yield Occurrences(pc.ascii_lower(part.column("text")), part.column("lang"))


def joined_pairs(met: Occurrences, seen: np.ndarray) -> np.ndarray:
    """Whether a word goes on to the next one by a pair that the filter holds; nothing for the last."""
    held = passes(seen, met.hashes)
    return met.joined[:-1] & held[:-1] & held[1:] & passes(seen, met.pairs())


def count_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of neighbouring words, and how often each pair occurs in some texts."""
    for met in occurrences(batches):
        if len(met.lengths) > 1:
            yield _counted(met.pairs()[met.joined[:-1]])


def count_triples(known):
    """The same of three words in a row whose pairs the broadcast filter holds."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in occurrences(batches):
            if len(met.lengths) > 2:
                going = joined_pairs(met, known.value)
                yield _counted(met.triples()[going[:-1] & going[1:]])

    return count


def _counted(keys: np.ndarray) -> pa.RecordBatch:
    found, times = np.unique(keys, return_counts=True)
    return pa.RecordBatch.from_pydict({"gram": pa.array(found.view(np.int64)), "n": pa.array(times)})


def bits_of(with_words: bool):
    """A task that gives the bits that hashes set in the filter, 64 of them in a row; of pairs also those of their words."""
    def to_bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("gram").to_numpy().view(np.uint64)
            if with_words:
                keys = np.concatenate([keys, keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)])
            bits = np.unique(np.concatenate(probes(keys)))
            values = (np.uint64(1) << (bits % 64).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_pydict({"place": pa.array((bits // 64).astype(np.int32)), "bits": pa.array(values)})

    return to_bits


def frequent_grams(rows: DataFrame, least: int) -> np.ndarray:
    """The Bloom filter, as bytes of bits, of two and three words that may occur ``least`` times in one language."""
    words = np.zeros(FILTER_BITS // 64, np.int64)
    for order in (2, 3):
        known = rows.sparkSession.sparkContext.broadcast(words.view(np.uint8))
        counted = rows.mapInArrow(count_pairs if order == 2 else count_triples(known), "gram long, n long")
        frequent = counted.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("gram")
        bits = frequent.mapInArrow(bits_of(order == 2), "place int, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits"))
        # at most one row of 12 bytes for each 64 bits of the filter comes to the driver
        found = stage(bits, "frequent-grams").toArrow()
        np.bitwise_or.at(words, found.column("place").to_numpy(), found.column("bits").to_numpy())
        known.destroy()
    return words.view(np.uint8)


def windows_of(known):
    """A task that counts the padded windows of some texts; ``known`` is the broadcast filter."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in occurrences(batches):
            if len(met.lengths):
                yield from tally(met, known.value)

    return count


def tally(met: Occurrences, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Distinct windows with their counts, the first word behind its language, and a language's words as an empty word.

    A window goes on to its second word by a pair that the filter holds, to its third and fourth by three words.
    """
    kept = passes(seen, met.hashes)
    spoken, times = np.unique(met.spoken, return_counts=True)
    empty = pa.array([""] * len(spoken), pa.string())
    alone = pc.binary_join_element_wise(met.languages.take(pa.array(spoken)), empty, MARK)
    yield pa.RecordBatch.from_pydict({WORDS[0]: alone, **dict.fromkeys(WORDS[1:], empty), "n": pa.array(times)})
    pairs, triples = np.zeros((2, len(kept)), bool)
    if len(kept) > 1:
        pairs[:-1] = joined_pairs(met, seen)
    if len(kept) > 2:
        triples[:-2] = pairs[:-2] & pairs[1:-1] & passes(seen, met.triples())
    # a word that goes on is kept, and so are those that it goes on to
    ids, languages, words = met.chosen(kept)
    count, size = len(ids), len(words) + 1
    ids, pairs, triples = (np.append(one, np.zeros(ORDER, one.dtype)) for one in (ids + 1, pairs[kept], triples[kept]))
    goes_on = pairs[:count], triples[:count], triples[:count] & triples[1 : count + 1]
    leads = [ids[:count], *(np.where(going, ids[ahead : ahead + count], 0) for ahead, going in enumerate(goes_on, 1))]
    halves = [np.unique(one * size + two, return_inverse=True) for one, two in (leads[:2], leads[2:])]
    keys, times = np.unique(halves[0][1] * len(halves[1][0]) + halves[1][1], return_counts=True)
    front, back = halves[0][0][keys // max(1, len(halves[1][0]))], halves[1][0][keys % max(1, len(halves[1][0]))]
    first = pc.binary_join_element_wise(languages, words, MARK)
    spelled = pa.concat_arrays([pa.array([""]), words])
    columns = {WORDS[0]: first.take(pa.array(front // size - 1))}
    columns |= {name: spelled.take(pa.array(part)) for name, part in zip(WORDS[1:], (front % size, back // size, back % size))}
    yield pa.RecordBatch.from_pydict(columns | {"n": pa.array(times)})


def in_larger_tasks(rows: DataFrame) -> DataFrame:
    """The rows in fewer partitions, while all cores have some."""
    spark = rows.sparkSession
    together = TASK_BYTES // spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    parts = rows.rdd.getNumPartitions()
    return rows.coalesce(max(parts // max(1, together), min(parts, spark.sparkContext.defaultParallelism), 1))


def phrase_counts(df: DataFrame, least: int) -> DataFrame:
    """(lang, size, phrase, f): each phrase of up to four words that occurs ``least`` times in its language,
    and all words of a language as its phrase of size 0."""
    spark = df.sparkSession
    rows = df.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    rows = in_larger_tasks(rows)
    known = spark.sparkContext.broadcast(frequent_grams(rows, least))
    windows = rows.mapInArrow(windows_of(known), f"{', '.join(f'{name} string' for name in WORDS)}, n long")
    sums = spark.sql(
        f"SELECT {', '.join(WORDS)}, {ORDER} - bit_count(grouping_id()) AS size, sum(n) AS f FROM {{windows}} GROUP BY ROLLUP ({', '.join(WORDS)})",
        windows=windows,
    )
    first = F.substring_index(WORDS[0], MARK, -1)
    lang = F.substr(F.col(WORDS[0]), F.lit(1), F.length(WORDS[0]) - F.length(first) - 1)
    spelled = F.array(first, *WORDS[1:])
    # a prefix that ends in padding is a shorter phrase, whose own sum is there as well
    ended = F.element_at(spelled, F.greatest(F.col("size"), F.lit(1)).cast("int")) == ""
    total = (F.col("size") == 1) & (first == "")
    kept = sums.where((F.col("size") > 0) & (total | ~ended & (F.col("f") >= least)))
    kept = kept.withColumns({"lang": lang, "size": F.when(total, 0).otherwise(F.col("size"))})
    phrase = F.array_join(F.array_compact(spelled), " ")
    counts = stage(kept.select("lang", F.col("size").cast("int").alias("size"), phrase.alias("phrase"), "f"), "phrases")
    known.destroy()
    return counts


def _part(words: Column, start: int, size: int) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(df: DataFrame, *, least: int = 30, covered: int = 80, most: int = 2000, scale: int = 2_000_000) -> DataFrame:
    """The first ``most`` phrases of each language in ``df`` (lang, text): lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line breaks into pieces, these at spaces and tabs into
    words.  A phrase of two to four words that occurs a >= ``least`` times within pieces, overlaps included, is a
    candidate.  A cut into two parts that occur l and r times scores floor(scale * a / (l + r)); the lowest cut
    counts, of equal ones the first.  Candidates inside a longer candidate with f >= covered percent of a go.
    The order is score and a descending, then the phrase by its bytes.  n is all words of the language.

    NULL languages are ``und``, NULL texts are empty; repeated rows count each time; languages without a
    candidate give no row, so an empty frame gives none.  Other columns are ignored.  ``df`` is read twice
    and has to give the same rows.
    """
    counts = phrase_counts(df, least)
    words = F.split("phrase", " ")
    candidates = counts.where("size > 1")
    cuts = F.array(*[
        F.when(F.col("size") > k, F.struct(F.lit(k).alias("k"), _part(words, 1, k).alias("first"), _part(words, k + 1, ORDER).alias("rest")))
        for k in range(1, ORDER)
    ])
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.array_compact(cuts)).alias("cut"))
    parts = counts.where("size > 0")
    cut = cut.select("lang", "phrase", "a", "cut.*")
    cut = cut.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    wide = lambda column: F.col(column).cast("decimal(20,0)")
    score = F.call_function("div", F.lit(scale).cast("decimal(10,0)") * wide("a"), wide("l") + wide("r"))
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    scored = cut.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.*")

    inner = F.array(*[
        F.when(F.col("size") > max(size, start + size - 2), _part(words, start, size))
        for size in range(2, ORDER) for start in range(1, ORDER - size + 2)
    ])
    longer = candidates.where("size > 2").select("lang", F.explode(F.array_compact(inner)).alias("phrase"), "f")
    longest = longer.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    apart = scored.join(longest, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * wide("around") < covered * wide("a"))
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    first = top_per_batch(apart.select("lang", "phrase", "a", "l", "r", "score"), "lang", order, most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
