"""Suffix arrays by induced sorting, and permuted longest common prefixes.

Suffixes are classified by whether they are smaller or larger than the next one.  The leftmost smaller
ones are sorted first; all others follow from them in two scans over the buckets of first symbols, each
bucket handled as arrays of suffixes.
"""

from __future__ import annotations

import numpy as np

from tablemill.llm.repetition import suffix_ranks

# Above so many symbols a bucket each is too fine for arrays, and names are sorted by doubling.
MAX_BUCKETS = 1024


def classify(s: np.ndarray) -> np.ndarray:
    """True for suffixes that are smaller than the next one; the last suffix is larger than the empty one."""
    n = len(s)
    rises = np.zeros(n, bool)
    rises[:-1] = s[:-1] < s[1:]
    decided = np.ones(n, bool)
    decided[:-1] = s[:-1] != s[1:]
    # a suffix in a run of one symbol is as the last of the run
    at = np.where(decided, np.arange(n), n)
    return rises[np.minimum.accumulate(at[::-1])[::-1]]


def induce(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order of all suffixes, given the leftmost smaller ones in order within each bucket."""
    n, buckets = len(s), len(sizes)
    out = np.full(n, -1, np.int64)
    head = np.concatenate([[0], np.cumsum(sizes)])
    tail = head[1:].copy()
    seed_bounds = np.concatenate([[0], np.cumsum(np.bincount(s[seeds], minlength=buckets))])

    def put(found: np.ndarray, ends: np.ndarray, step: int) -> None:
        symbol = s[found]
        by = np.argsort(symbol, kind="stable")
        counts = np.bincount(symbol, minlength=buckets)
        firsts = np.cumsum(counts) - counts
        symbol = symbol[by]
        rank = np.arange(len(found)) - firsts[symbol]
        out[ends[symbol] + rank if step > 0 else ends[symbol] - 1 - rank] = found[by]
        ends += step * counts

    ends = head[:-1].copy()
    put(np.array([n - 1]), ends, 1)
    for bucket in range(buckets):
        done = head[bucket]
        while done < ends[bucket]:
            block = out[done : ends[bucket]]
            done = ends[bucket]
            before = block[block > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                put(before, ends, 1)
        block = seeds[seed_bounds[bucket] : seed_bounds[bucket + 1]]
        before = block[block > 0] - 1
        if len(before):
            put(before, ends, 1)
    larger_end = ends
    ends = tail.copy()
    for bucket in range(buckets - 1, -1, -1):
        done = tail[bucket]
        while done > ends[bucket]:
            block = out[ends[bucket] : done][::-1]
            done = ends[bucket]
            before = block[block > 0] - 1
            before = before[smaller[before]]
            if len(before):
                put(before, ends, -1)
        block = out[head[bucket] : larger_end[bucket]][::-1]
        before = block[block > 0] - 1
        before = before[smaller[before]]
        if len(before):
            put(before, ends, -1)
    return out


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a sequence of small non-negative numbers."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    sizes = np.bincount(s)
    if len(sizes) > MAX_BUCKETS:
        return suffix_ranks(s, np.full(n, n))[0]
    smaller = classify(s)
    leftmost = smaller.copy()
    leftmost[0] = False
    leftmost[1:] &= ~smaller[:-1]
    places = np.nonzero(leftmost)[0]
    if len(places) == 0:
        return induce(s, smaller, places, sizes)
    symbols = s.astype(np.uint16)
    by_bucket = places[np.argsort(symbols[places], kind="stable")]
    order = induce(symbols, smaller, by_bucket, sizes)
    order = order[leftmost[order]]
    if len(order) > 1:
        # substrings from one leftmost smaller suffix to the next get equal names if they are equal
        end = np.full(n, n)
        end[places[:-1]] = places[1:] + 1
        a, b = order[:-1], order[1:]
        long_a, long_b = end[a] - a, end[b] - b
        # the substring that reaches the end of the text is unlike any other
        same = (long_a == long_b) & (a != places[-1]) & (b != places[-1])
        check = np.nonzero(same)[0]
        step = 0
        while len(check):
            equal = symbols[a[check] + step] == symbols[b[check] + step]
            same[check[~equal]] = False
            step += 1
            check = check[equal & (step < long_a[check])]
        name = np.zeros(n, np.int64)
        name[order] = np.concatenate([[0], np.cumsum(~same)])
        names = name[places]
        if not same.any():
            inner = np.argsort(names)
        else:
            inner = suffix_array(names)
        order = places[inner]
    # within a bucket the order stays; buckets come in order since it is an order of suffixes
    return induce(symbols, smaller, order, sizes)


def permuted_prefixes(raw: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in place order, the bytes it shares with the suffix before it in ``order``, up to ``most``.

    The suffix one place on shares at least one byte less, so all but each 32nd start from that bound.
    """
    n = len(raw)
    reach = most + 32
    padded = np.concatenate([raw, np.arange(1, 17, dtype=np.uint8)])
    words = np.ndarray((n + 8,), "<u8", padded.tobytes(), strides=(1,))
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)

    def compare(at: np.ndarray) -> None:
        at = at[(before[at] >= 0) & (shared[at] < reach)]
        while len(at):
            left, right = at + shared[at], before[at] + shared[at]
            inside = np.maximum(left, right) < n
            at, left, right = at[inside], left[inside], right[inside]
            differ = words[left] ^ words[right]
            some = differ != 0
            low = differ[some] & (~differ[some] + np.uint64(1))
            shared[at[some]] += np.bitwise_count(low - np.uint64(1)) >> np.uint8(3)
            at = at[~some]
            shared[at] += 8
            at = at[shared[at] < reach]

    to_end = n - np.maximum(np.arange(n), before)
    base = np.arange(0, n, 32)
    compare(base)
    shared = np.minimum(shared, to_end)
    bound = np.repeat(shared[base], 32)[:n] - np.arange(n) % 32
    rest = np.arange(n) % 32 != 0
    shared[rest] = np.maximum(bound[rest], 0)
    compare(np.nonzero(rest)[0])
    return np.minimum(np.minimum(shared, to_end), most)
