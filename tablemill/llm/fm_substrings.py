"""Removal of repeated word windows with an FM-index per shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablemill.llm.arrow_text import bounds, numbered, words
from tablemill.llm.fm_index import FMIndex
from tablemill.llm.repeats import Cut, Index, without_repeats

GRAM = 6


def later_windows(length: int) -> Index:
    """Marks the windows that also start earlier, by streaming the shard's contents through its index.

    Windows are ranked by doc_id and start; rows that share a doc_id share its ranks.  The smallest rank in
    a window's interval of suffixes is where it starts first.
    """
    def search(columns: dict[str, np.ndarray], contents: list[bytes]) -> list[np.ndarray]:
        counts, flat = words(pa.array(contents, pa.binary()).cast(pa.string()))
        starts = bounds(counts)
        ids, _ = numbered(flat)
        index = FMIndex(ids + 1, starts)
        n_windows = columns["n_windows"].astype(np.int64)
        begins = np.cumsum(n_windows) - n_windows
        row = np.repeat(np.arange(len(contents)), n_windows)
        at = starts[row] + np.arange(len(row)) - begins[row]
        d, start = columns["d"][row], columns["start"][row] + at - starts[row]
        by = np.lexsort((start, d))
        new = np.append(True, (d[by[1:]] != d[by[:-1]]) | (start[by[1:]] != start[by[:-1]]))
        rank = np.empty(len(at), np.int64)
        rank[by] = np.cumsum(new)
        # other places hold the ends of contents, where no window starts
        ranks = np.zeros(len(ids), np.int64)
        ranks[at] = rank
        which, low, high = index.search(at, length)
        marked = np.zeros(len(at), bool)
        marked[which] = index.smallest(ranks, low, high) < rank[which]
        return np.split(marked, begins[1:])

    return search


def remove_repeated_words(df: DataFrame, length: int = 20) -> DataFrame:
    """Every row of ``df`` (doc_id, text) with n_items (words), n_removed, n_spans and kept_sha256.

    A word goes if a window of ``length`` words covers it that also starts earlier: in a smaller doc_id, or
    further ahead in the same document.  What is left is joined by one space for the digest.  NULL and
    empty texts have no words; a text shorter than a window keeps all.  A NULL doc_id comes after all
    others.  Rows that share a doc_id share a place, and each is judged by its own text: a window at the
    same word of both is earlier in neither.  An empty frame gives no rows; other columns are ignored.
    """
    return without_repeats(df, Cut(True, length, min(GRAM, length)), later_windows(length), keep_first=True)
