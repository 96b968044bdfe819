"""A succinct full-text index of word sequences: Burrows-Wheeler transform in a wavelet tree of packed bits."""

from __future__ import annotations

import numpy as np

from tablemill.llm.repetition import suffix_ranks


class Bits:
    """A bit vector, 64 bits to a word, with the ones before each word counted."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1]

    def ones(self, at: np.ndarray) -> np.ndarray:
        """The ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """Rank of any symbol at any place; one bit vector for each bit of the symbols, high bits first."""

    def __init__(self, symbols: np.ndarray, n_bits: int):
        self.levels, self.zeros, self.n_bits = [], [], n_bits
        for level in range(n_bits - 1, -1, -1):
            bits = (symbols >> level & 1).astype(bool)
            self.levels.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def ranks(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol stands before its two places."""
        first = np.zeros(len(symbols), np.int64)
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbols >> (self.n_bits - 1 - level) & 1).astype(bool)
            a, b, c = bits.ones(first), bits.ones(low), bits.ones(high)
            first = np.where(one, zeros + a, first - a)
            low = np.where(one, zeros + b, low - b)
            high = np.where(one, zeros + c, high - c)
        return low - first, high - first


class FMIndex:
    """Rows of symbols from 1 on, each ended by a separator, in their given order."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray):
        n, rows = len(symbols), len(starts) - 1
        row = np.repeat(np.arange(rows), np.diff(starts))
        order, _ = suffix_ranks(symbols, starts[1:][row])
        self.symbols, self.starts = symbols, starts
        # row r's separator follows its symbols and is smaller than any symbol
        self.places = np.concatenate([starts[1:], order])
        self.is_end = np.arange(n + rows) < rows
        previous = np.empty(n + rows, np.int64)
        previous[:rows] = np.where(np.diff(starts) > 0, symbols[np.maximum(starts[1:] - 1, 0)], 0) if n else 0
        begins = np.zeros(n + 1, bool)
        begins[starts] = True
        previous[rows:] = np.where(begins[order], 0, symbols[order - 1])
        most = int(symbols.max(initial=0))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(previous, minlength=most + 1))])
        self.tree = WaveletTree(previous, max(1, most.bit_length()))

    def search(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of the windows of ``length`` symbols at places ``at`` of the indexed rows.

        All windows go one symbol at a time; one whose interval holds a single suffix matches itself
        alone and is dropped.  What remains is returned: which of ``at``, and its interval of suffixes.
        """
        which = np.arange(len(at))
        low = np.zeros(len(at), np.int64)
        high = np.full(len(at), len(self.places))
        for step in range(length - 1, -1, -1):
            symbol = self.symbols[at[which] + step]
            low, high = self.tree.ranks(symbol, low, high)
            low, high = self.before[symbol] + low, self.before[symbol] + high
            more = high - low > 1
            which, low, high = which[more], low[more], high[more]
        return which, low, high

    def smallest(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest value of a suffix in each interval; ``values`` has one for each place."""
        found = np.empty(len(low), np.int64)
        size = high - low
        best, reach = np.append(values, 0)[self.places], 1
        while True:
            now = (size >= reach) & (size < 2 * reach)
            found[now] = np.minimum(best[low[now]], best[high[now] - reach])
            if not (size >= 2 * reach).any():
                return found
            best = np.minimum(best[:-reach], best[reach:])
            reach *= 2
