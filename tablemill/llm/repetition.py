"""Quality rules on repetition, from a suffix array of words with longest common prefixes.

The words of a slice of documents are ranked by prefixes of doubling length until every suffix of
every document has its place.  Neighbours in that order have their longest common prefix read off
the ranks kept on the way.  A suffix repeats elsewhere in its document for as many words as it shares
with the better neighbour, so these prefixes give all maximal repeated substrings.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tablemill.llm.arrow_text import bounds, byte_lengths, numbered, slices, sums, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A repeat counts from this many words on; shorter ones are common in ordinary prose.
LEAST_REPEAT = 8
MAX_COVERED_PERCENT = 45
MAX_LONGEST = 100

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_covered_words long, longest_repeat long"
)


def suffix_ranks(key: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of all suffixes, and the ranks by prefixes of 1, 2, 4, ... items.

    ``end`` is where the row of each item ends; suffixes stop there, shorter before longer, equal ones in
    the order of their places.
    """
    n = len(key)
    if not n:
        return np.zeros(0, np.int64), []
    longest = int((end - np.arange(n)).max(initial=0))
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    levels, reach = [rank.copy()], 1
    alone = new & np.concatenate([new[1:], [True]])
    open_ = order[~alone]
    while len(open_) and reach < longest:
        far = open_ + reach
        next_ = np.where(far < end[open_], rank[np.minimum(far, n - 1)] + 1, 0)
        # one number for both, so that one sort will do; n is far below the root of its range
        both = rank[open_] * (n + 1) + next_
        by = np.argsort(both)
        open_, both = open_[by], both[by]
        own = both // (n + 1)
        at = np.arange(len(open_))
        split = np.concatenate([[True], both[1:] != both[:-1]])
        group = np.concatenate([[True], own[1:] != own[:-1]])
        begins = np.maximum.accumulate(np.where(split, at, 0))
        rank[open_] = own + begins - np.maximum.accumulate(np.where(group, at, 0))
        order[rank[open_] + at - begins] = open_
        levels.append(rank.copy())
        reach *= 2
        open_ = open_[~(split & np.concatenate([split[1:], [True]]))]
    if len(open_):
        open_ = open_[np.lexsort((open_, rank[open_]))]
        own = rank[open_]
        at = np.arange(len(open_))
        order[own + at - np.maximum.accumulate(np.where(np.concatenate([[True], own[1:] != own[:-1]]), at, 0))] = open_
    return order, levels


def repeated_for(ids: np.ndarray, row: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each word, how many words from there on also stand elsewhere in its row."""
    n = len(ids)
    if n < 2:
        return np.zeros(n, np.int64)
    order, levels = suffix_ranks(row * (ids.max(initial=0) + 1) + ids, end)
    left, right = order[:-1], order[1:]
    pairs = np.nonzero(levels[0][left] == levels[0][right])[0]
    left, right = left[pairs], right[pairs]
    shared = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + shared, right + shared
        inside = (a < end[left]) & (b < end[right])
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        shared += same << k
    found = np.zeros(n, np.int64)
    found[left] = shared
    found[right] = np.maximum(found[right], shared)
    # a suffix is the right one of a pair once and the left one once
    return found


def covered(starts: np.ndarray, lengths: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in a span."""
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edges[:n]) > 0


def line_copies(texts: pa.Array) -> np.ndarray:
    """For each text, its lines with a word that equal an earlier line of it."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    flat = lists.flatten()
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    some = pc.match_substring_regex(flat, r"[^\x20\x09-\x0D]")
    row = np.repeat(np.arange(len(texts)), counts)[some.to_numpy(zero_copy_only=False)]
    ids, distinct = numbered(flat.filter(some))
    different = np.unique(row * max(1, len(distinct)) + ids) // max(1, len(distinct))
    return np.bincount(row, minlength=len(texts)) - np.bincount(different, minlength=len(texts))


def measure(least: int, nested: bool = False):
    """A task that adds to each row its measures, or one column ``_measures`` of them if ``nested``.

    Repeats of ``least`` words and more count.
    """
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = part.column("text")
            counts, flat = words(texts)
            starts = bounds(counts)
            ids, distinct = numbered(flat)
            row = np.repeat(np.arange(len(counts)), counts)
            end = np.repeat(starts[1:], counts)
            chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)[ids] if len(ids) else ids
            lasts = repeated_for(ids, row, end)
            three = np.nonzero(lasts >= 3)[0]
            long_ = np.nonzero(lasts >= least)[0]
            longest = np.zeros(len(counts), np.int64)
            np.maximum.at(longest, row[long_], lasts[long_])
            symbols = pc.fill_null(pc.count_substring_regex(texts, r"[#*$%&|<>]"), 0)
            found = pa.RecordBatch.from_pydict(
                {
                    "n_words": pa.array(counts, pa.int64()),
                    "word_chars": pa.array(sums(chars, starts)),
                    "n_symbols": symbols.cast(pa.int64()),
                    "n_dup_lines": pa.array(line_copies(texts), pa.int64()),
                    "n_repeat_words": pa.array(sums(covered(three, 3, len(ids)), starts)),
                    "n_covered_words": pa.array(sums(covered(long_, lasts[long_], len(ids)), starts)),
                    "longest_repeat": pa.array(longest),
                }
            )
            if nested:
                yield part.append_column("_measures", found.to_struct_array())
            else:
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *found.columns], ["doc_id", *found.schema.names])

    return rows


def repetition_stats(df: DataFrame, least: int = LEAST_REPEAT) -> DataFrame:
    """The measures of every row of ``df`` (doc_id, text); see ``judge`` for what they decide.

    NULL and empty texts have no words, and all measures are 0.  Repeated rows each give a row, an empty
    frame none.  Other columns are ignored.  A text is handled whole, in one task; nothing is shuffled.
    """
    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(measure(least), f"doc_id long, {MEASURES}")


def keep_varied(df: DataFrame, least: int = LEAST_REPEAT) -> DataFrame:
    """The rows of ``df`` (text and any other columns but ``_measures``) that ``judge`` keeps, unchanged."""
    schema = T.StructType([*df.schema.fields, T.StructField("_measures", T._parse_datatype_string(MEASURES))])
    measured = df.mapInArrow(measure(least, nested=True), schema)
    row = F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in df.columns])
    kept = judge(measured.select(row.alias("_row"), "_measures.*"))
    return kept.where("kept").select("_row.*")


def judge(stats: DataFrame, max_covered_percent: int = MAX_COVERED_PERCENT, max_longest: int = MAX_LONGEST) -> DataFrame:
    """``stats`` with ``base_failed`` and ``kept``.

    A document fails the base rules with fewer than 50 words or with over half of them in repeated
    3-word windows.  It is kept if it passes them, repeats cover at most that percentage of its words,
    and the longest repeat has at most ``max_longest`` words.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    kept = (
        ~failed
        & (100 * F.col("n_covered_words") <= max_covered_percent * F.col("n_words"))
        & (F.col("longest_repeat") <= max_longest)
    )
    return stats.withColumn("base_failed", failed).withColumn("kept", kept)
