"""Removal of repeated byte strings with a suffix array per shard, built by induced sorting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tablemill.llm.induced import permuted_prefixes, suffix_array
from tablemill.llm.repeats import Cut, Index, without_repeats

GRAM = 32


def repeated_anywhere(length: int) -> Index:
    """Marks the windows of which the shard holds another: those that share ``length`` bytes with a neighbour.

    Contents with copies elsewhere are repeated as they are.
    """
    def search(columns: dict[str, np.ndarray], contents: list[bytes]) -> list[np.ndarray]:
        # symbol 0 ends a content; the bytes of a text become 1 to 256
        sizes = np.array([len(one) for one in contents], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        raw = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8)
        symbols = raw.astype(np.int64) + 1
        symbols[starts + sizes] = 0
        order = suffix_array(symbols)
        shared = permuted_prefixes(raw, order, length)
        after = np.zeros(len(raw), np.int64)
        after[order[:-1]] = shared[order[1:]]
        repeated = (shared >= length) | (after >= length)
        marked = []
        for start, count, copies in zip(starts.tolist(), columns["n_windows"].tolist(), columns["copies"].tolist()):
            marked.append(np.ones(count, bool) if copies > 1 else repeated[start : start + count])
        return marked

    return search


def remove_repeated_bytes(df: DataFrame, length: int = 200) -> DataFrame:
    """Every row of ``df`` (doc_id, text) with n_items (bytes), n_removed, n_spans and kept_sha256.

    A byte goes if a string of ``length`` bytes covers it that also starts anywhere else, in this text or
    another; all copies go, and overlapping ones count.  NULL and empty texts have no bytes; a text
    shorter than ``length`` keeps all.  Repeated rows are copies of each other.  An empty frame gives no
    rows; other columns are ignored.
    """
    return without_repeats(df, Cut(False, length, min(GRAM, length)), repeated_anywhere(length), keep_first=False)
