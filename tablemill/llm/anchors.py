"""Anchors: which windows of a sequence can equal windows elsewhere, found without comparing them all.

Each window of ``length`` items picks the k-gram in it with the smallest hash, the leftmost of equal
ones.  Equal windows pick equal k-grams, so a window whose k-gram stands nowhere else in the corpus has
no equal.  Consecutive windows that pick equal k-grams form one segment, which ends at the latest where its
first window no longer reaches: periodic text gives few segments too, and none is longer than two windows.
Equal windows of one segment pick different places, so only a segment that picks several can hold them.
"""

from __future__ import annotations

import hashlib

import numpy as np

# From so many bytes on a word is hashed by itself: powers modulo 2^64 give some different words of 1,024 letters one sum.
LONG_WORD = 512
PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of each value (the finaliser of SplitMix64)."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def power(base: np.uint64, times: int) -> np.uint64:
    return np.uint64(pow(int(base), times, 1 << 64))


def gram_hashes(items: np.ndarray, k: int, prime: np.uint64 = PRIME) -> np.ndarray:
    """A hash of each run of k items, by doubling; runs that reach over the end are left out."""
    done, reach = None, 1
    part, left = items, k
    # part holds hashes of runs of ``reach`` items; done those of the bits of k seen so far
    size = 0
    while left:
        if left & 1:
            if done is None:
                done, size = part, reach
            else:
                n = len(items) - size - reach + 1
                if n <= 0:
                    return np.zeros(0, np.uint64)
                done = done[:n] * power(prime, reach) + part[size : size + n]
                size += reach
        left >>= 1
        if left:
            n = len(items) - 2 * reach + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            part = part[:n] * power(prime, reach) + part[reach : reach + n]
            reach *= 2
    return done


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    best, reach = values, 1
    while reach * 2 <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best


def powers(n: int, prime: np.uint64 = PRIME) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2^64, and their inverses."""
    both = []
    for base in (int(prime), pow(int(prime), -1, 1 << 64)):
        out = np.ones(n, np.uint64)
        filled = 1
        while filled < n:
            more = min(filled, n - filled)
            out[filled : filled + more] = out[:more] * np.uint64(pow(base, filled, 1 << 64))
            filled += more
        both.append(out)
    return both[0], both[1]


def range_hashes(items: np.ndarray, begins: np.ndarray, ends: np.ndarray, prime: np.uint64 = PRIME) -> np.ndarray:
    """A hash of each range of items, equal for equal ranges."""
    power_of, inverse = powers(len(items) + 1, prime)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(items * power_of[:-1], dtype=np.uint64)])
    return mixed((running[ends] - running[begins]) * inverse[begins] + (ends - begins).astype(np.uint64) * prime)


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A hash of each word, given where words begin and end in ``raw`` and a number for each byte."""
    hashes = range_hashes(table[raw], begins, ends)
    salt = int(table[0]).to_bytes(8, "little")
    for at in np.nonzero(ends - begins >= LONG_WORD)[0].tolist():
        digest = hashlib.blake2b(raw[begins[at] : ends[at]].tobytes(), digest_size=8, key=salt).digest()
        hashes[at] = int.from_bytes(digest, "little")
    return hashes


def segments(items: np.ndarray, starts: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(key, row, start within the row, number of windows, whether it picks several places) of every segment.

    ``items`` are 64-bit hashes of the rows' items one after the other, ``starts`` the bounds of the rows.
    """
    nothing = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, bool))
    if len(items) < length:
        return nothing
    hashes = mixed(gram_hashes(items, k))
    # the place fills the low bits, so of equal hashes the leftmost is the smallest
    bits = np.uint64(max(20, len(hashes).bit_length()))
    packed = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width = length - k + 1
    place = (sliding_min(packed, width) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    picked = hashes[place]
    fits = np.diff(starts) >= length
    usable = np.zeros(len(place) + 1, np.int8)
    np.add.at(usable, starts[:-1][fits], 1)
    ends = starts[1:][fits] - length + 1
    np.add.at(usable, np.minimum(ends, len(place)), -1)
    inside = np.cumsum(usable[:-1]) > 0
    before = np.concatenate([[False], inside[:-1]])
    # windows of neighbouring rows may pick equal k-grams, so rows are told apart by where they begin
    before[starts[:-1][starts[:-1] < len(place)]] = False
    run = inside & ~before
    run[1:] |= inside[1:] & (picked[1:] != picked[:-1])
    if not run.any():
        return nothing
    since = np.arange(len(place)) - np.maximum.accumulate(np.where(run, np.arange(len(place)), 0))
    at = np.nonzero(inside & (since % width == 0))[0]
    counts = np.add.reduceat(inside, at, dtype=np.int64)
    # places never move back from a window to the next
    periodic = place[at + counts - 1] != place[at]
    row = np.searchsorted(starts, at, "right") - 1
    return picked[at].astype(np.int64), row, at - starts[row], counts, periodic
