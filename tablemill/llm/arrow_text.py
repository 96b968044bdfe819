"""Texts in Arrow batches: slices of bounded bytes, words, and sums over the words of each row."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words are runs of other characters than these: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts fill at most ``most`` bytes, or of one row if that is longer."""
    for batch in batches:
        ends = np.cumsum(byte_lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_lengths(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text, 0 for null."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of words in each text, and all words in order; null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    some = pc.greater(pc.binary_length(flat), 0)
    row = np.repeat(np.arange(len(texts)), counts)[some.to_numpy(zero_copy_only=False)]
    return np.bincount(row, minlength=len(texts)), flat.filter(some)


def numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each value, equal for equal values, and the distinct values by number."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def bounds(counts: np.ndarray) -> np.ndarray:
    """Where the values of each row begin in the concatenation; the last item is the total."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums over the values of each row, given ``bounds``."""
    running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return running[starts[1:]] - running[starts[:-1]]


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other, and the bounds of each."""
    filled = pc.fill_null(texts, "").cast(pa.string())
    _, offsets, data = filled.buffers()
    bound = np.frombuffer(offsets, np.int32)[filled.offset : filled.offset + len(filled) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bound[0] : bound[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bound - bound[0]


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_places(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end in the bytes of all texts, and the bounds of each text in words."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~IS_SPACE[raw]
    begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    # where a text begins, a word ends and another begins
    edge = starts[(starts > 0) & (starts < len(raw))]
    begins[edge] = inside[edge + 1]
    ends[edge] = inside[edge]
    first = np.nonzero(begins)[0]
    return first, np.nonzero(ends)[0], np.searchsorted(first, starts)


def gathered(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """All rows in batches whose texts fill about ``most`` bytes, or of one row if that is longer."""
    waiting, size = [], 0
    for part in slices(batches, column, most):
        # rows without text count as well, so that a batch's rows are bounded
        waiting.append(part)
        size += int(byte_lengths(part.column(column)).sum()) + 64 * part.num_rows
        if size >= most:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting, size = [], 0
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
