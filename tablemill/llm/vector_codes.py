"""Vectors as codes of one byte per part, with codebooks learned by rounds of exact integer k-means.

A vector is cut into parts, and each part gets the index of the nearest entry of its codebook.  The search
transforms parts and entries, zero-padded to a power of two, by the Walsh-Hadamard transform: sums and differences
alone, under which squared distances are only scaled by the padded length.  Squared differences are then added up in
sequency order, smooth coefficients first, which hold most of a distance early: an entry whose running sum
passes the best full sum so far is out.  All of it is in whole numbers, so ties and results are exact.

Each round is one pass over the vectors: tasks assign parts and send sums per entry, which Spark adds up.  Codebooks
have a fixed size, and only they travel to the driver and back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablemill.llm.staged import stage
from tablemill.operators.skew import look_up

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
# Parts searched together: with all entries they fill a few MB.
ROWS_AT_ONCE = 512
# Sums of components beyond 64 bits travel in limbs of so many bits.
LIMB_BITS = 40
LARGEST = (1 << 63) - 1


def sequency_order(size: int) -> np.ndarray:
    """The rows of the natural Walsh-Hadamard matrix by their number of sign changes."""
    signs = transform(np.eye(size, dtype=np.int64))
    return np.argsort((np.diff(signs, axis=0) != 0).sum(axis=0), kind="stable")


def transform(values: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform along the last axis, whose length is a power of two."""
    size, half = values.shape[-1], 1
    while half < size:
        pairs = values.reshape(*values.shape[:-1], size // (2 * half), 2, half)
        values = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(values.shape)
        half *= 2
    return values


class Codebook:
    """The entries of one part, ready for the search of nearest ones."""

    def __init__(self, entries: np.ndarray):
        self.width = entries.shape[1]
        self.size = 1 << max(0, self.width - 1).bit_length()
        self.order = sequency_order(self.size)
        self.entries = entries
        self.largest = max([abs(int(x)) for x in entries.ravel()], default=0)
        # coefficients are sums of all components
        self.spectrum = self.transformed(entries if self.largest * self.size < LARGEST else entries.astype(object))

    def transformed(self, parts: np.ndarray) -> np.ndarray:
        """Coefficients in sequency order, one row of them per coefficient."""
        padded = np.zeros((len(parts), self.size), parts.dtype)
        padded[:, : self.width] = parts
        return np.ascontiguousarray(transform(padded)[:, self.order].T)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each part its nearest entry, the lowest index of equally near ones, and the squared distance."""
        # sums of squares of the differences' coefficients must fit 64 bits; larger numbers are Python's
        bound = max(self.largest, max(int(parts.max()), -int(parts.min())) if parts.size else 0)
        exact = np.int64 if (2 * bound * self.size) ** 2 < LARGEST else object
        index, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), exact)
        spectrum = self.spectrum.astype(exact)
        for start in range(0, len(parts), ROWS_AT_ONCE):
            index[start : start + ROWS_AT_ONCE], distance[start : start + ROWS_AT_ONCE] = self._search(
                self.transformed(parts[start : start + ROWS_AT_ONCE].astype(exact)), spectrum
            )
        return index, distance

    def _search(self, rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count, every = rows.shape[1], np.arange(rows.shape[1])
        first = max(1, self.size // 4)
        sums = np.zeros((count, entries.shape[1]), rows.dtype)
        for k in range(first):
            apart = rows[k][:, None] - entries[k]
            apart *= apart
            sums += apart
        # the full sum of the entry that leads so far bounds the least one
        leader = sums.argmin(axis=1)
        rest = rows[first:] - entries[first:, leader]
        best = sums[every, leader] + (rest * rest).sum(axis=0)
        row, entry = np.nonzero(sums <= best[:, None])
        running, step = sums[row, entry], max(1, self.size // 8)
        for start in range(first, self.size, step):
            for k in range(start, min(start + step, self.size)):
                apart = rows[k][row] - entries[k][entry]
                running += apart * apart
            alive = running <= best[row]
            row, entry, running = row[alive], entry[alive], running[alive]
        # rows and entries are in order, so the first of a row's least sums has the lowest index
        begins = np.searchsorted(row, every)
        least = np.minimum.reduceat(running, begins) if count else running
        hits = np.nonzero(running == least[row])[0]
        winner = hits[np.searchsorted(row[hits], every)]
        # a squared distance is the sum divided by the padded length
        return entry[winner], least // self.size


def whole(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(1024 x) of each component, shorter vectors padded with zeros; Python's integers where 64 bits are too few."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if not len(values) or np.abs(values).max() < 2.0**50:
        numbers = np.floor(values * SCALE).astype(np.int64)
    else:
        numbers = np.array([int(x) * SCALE if abs(x) >= 2.0**50 else int(np.floor(x * SCALE)) for x in values.tolist()], object)
    padded = np.zeros((len(lengths), width), numbers.dtype)
    padded[np.arange(width) < lengths[:, None]] = numbers
    return padded


def limbs(number: int) -> Iterator[tuple[int, int]]:
    """A number in pieces of some bits, the last one with the sign."""
    place = 0
    while not -LARGEST <= number <= LARGEST:
        yield place, number & ((1 << LIMB_BITS) - 1)
        number, place = number >> LIMB_BITS, place + 1
    yield place, number


def assigned(books: list[Codebook], width: int):
    """For each batch, its parts with their nearest entries and squared distances."""
    def search(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            parts = np.split(whole(batch.column("embedding"), width), len(books), axis=1)
            yield batch, [(part, *book.nearest(part)) for part, book in zip(parts, books)]

    return search


def sums_of(books: list[Codebook], width: int):
    """A task that sends, per codebook entry, the number of its parts (position -1) and the sums of their components."""
    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        narrow = [np.zeros((len(book.entries), book.width + 1), object) for book in books]
        for _, found in assigned(books, width)(batches):
            for total, (part, index, _) in zip(narrow, found):
                order = np.argsort(index, kind="stable")
                met, starts = np.unique(index[order], return_index=True)
                if not len(met):
                    continue
                # sums of a batch fit 64 bits while components do with 20 bits to spare
                wide = part.dtype != object and (not part.size or np.abs(part).max() < 1 << 43) and len(part) < 1 << 20
                summed = np.add.reduceat(part[order] if wide else part[order].astype(object), starts, axis=0)
                total[met, 1:] += summed.astype(object)
                total[met, 0] += np.diff(np.append(starts, len(index))).astype(object)
        rows = [
            (part, entry, place - 1, limb, piece)
            for part, total in enumerate(narrow) for entry in range(len(total)) if total[entry, 0]
            for place in range(total.shape[1]) for limb, piece in limbs(int(total[entry, place]))
        ]
        names = ("part", "entry", "place", "limb")
        columns = {name: pa.array([row[at] for row in rows], pa.int32()) for at, name in enumerate(names)}
        yield pa.RecordBatch.from_pydict(columns | {"piece": pa.array([row[4] for row in rows], pa.int64())})

    return add_up


def learned(rows: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after one round; an entry without parts stays."""
    ready = [Codebook(entries) for entries in books]
    sent = rows.select("embedding").mapInArrow(sums_of(ready, width), "part int, entry int, place int, limb int, piece long")
    sums: dict[tuple[int, int, int], int] = {}
    # entries x width sums at most, and a few more where they pass 64 bits
    total = F.sum(F.col("piece").cast("decimal(38,0)")).alias("piece")
    for row in sent.groupBy("part", "entry", "place", "limb").agg(total).collect():
        key = row["part"], row["entry"], row["place"]
        sums[key] = sums.get(key, 0) + (int(row["piece"]) << (LIMB_BITS * row["limb"]))
    after = []
    for part, entries in enumerate(books):
        replaced = [
            [sums[part, entry, place] // count for place in range(entries.shape[1])]
            if (count := sums.get((part, entry, -1))) else entries[entry].tolist()
            for entry in range(len(entries))
        ]
        after.append(_integers(replaced, entries.shape))
    return after


def _integers(rows: list[list[int]], shape: tuple[int, int]) -> np.ndarray:
    small = all(-LARGEST <= value <= LARGEST for row in rows for value in row)
    return np.array(rows, np.int64 if small else object).reshape(shape)


def _codes(books: list[Codebook], width: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in assigned(books, width)(batches):
            codes = np.stack([index for _, index, _ in found], axis=1).astype(np.uint8)
            error = sum(distance.astype(object) for _, _, distance in found)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                "code": pa.array([row.tobytes().hex() for row in codes], pa.string()),
                "error": pa.array([min(int(value), LARGEST) for value in error], pa.int64()),
            })

    return write


def compress(df: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[list[list[int]]]]:
    """A code and its error for each vector of ``df`` (vec_id, embedding, label), and the codebooks by part.

    Rows whose vector is NULL or holds NULL, NaN or an infinity go.  Components count as floor(1024 x), exactly
    also where that passes 64 bits; an error beyond 64 bits is given as the largest number of 64 bits.  Codebooks
    start as the parts of the ``entries`` rows with the smallest vec_id (NULL last, equal ones by vector), fewer
    if there are fewer rows, at most 256.  Vectors that are shorter than the longest, or of a length that
    ``parts`` does not divide, count as padded with zeros.  Repeated rows count each time; an empty frame gives
    no rows and empty codebooks.  Other columns are ignored.

    The frame has vec_id, label, code (two hex digits per part), error, and label_error, the errors of all rows
    with the same label (NULLs together) added up.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of one byte has 1 to 256 entries")
    usable = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = stage(df.select("vec_id", "embedding", "label").where(F.coalesce(usable, F.lit(False))), "vectors")
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = max(1, -(-longest // parts)) * parts
    kind = rows.schema["vec_id"].dataType.simpleString()
    starts = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).toArrow()
    first = whole(starts.column("embedding").combine_chunks(), width) if starts.num_rows else np.zeros((0, width), np.int64)
    books = np.split(first, parts, axis=1)
    if len(first):
        for _ in range(rounds):
            books = learned(rows, books, width)
    schema = f"vec_id {kind}, label {rows.schema['label'].dataType.simpleString()}, code string, error long"
    coded = stage(rows.mapInArrow(_codes([Codebook(entries) for entries in books], width), schema), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)"))
    errors = coded.groupBy("label").agg(total.cast("long").alias("label_error"))
    return look_up(coded, errors, ["label"]), [[[int(x) for x in entry] for entry in book] for book in books]


def codebooks_sha256(books: list[list[list[int]]]) -> str:
    """Hex digest of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
