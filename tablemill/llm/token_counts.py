"""Token counts without token ids: pieces are counted once per distinct pre-token.

A byte-level BPE never merges across pre-tokens, so a text has as many tokens as its pre-tokens
have pieces.  Texts are cut into pre-tokens in chunks of bounded bytes; a chunk keeps its distinct
pre-tokens and, for each document, which of them occur how often.  The distinct pre-tokens of all
chunks are counted by the tokenizer once, joined back to the chunks, and summed per document.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tablemill.llm.arrow_text import byte_lengths, slices
from tablemill.llm.staged import stage

# The pre-token pattern of the byte-level vocabulary and its special string.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = "<|endoftext|>"
CHUNK_BYTES = 32 << 20

CHUNKS = (
    "chunk string, doc_ids array<long>, n_bytes array<long>, n_specials array<long>, "
    "starts array<int>, frequencies binary, pre_tokens array<string>"
)


def pack(terms: np.ndarray, times: np.ndarray) -> bytes:
    """Terms, as differences from one to the next, and times, byte by byte of all and compressed."""
    both = np.concatenate([np.diff(terms, prepend=0), times]).astype("<i4")
    return zlib.compress(np.ascontiguousarray(both.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view("<i4").ravel().astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def pre_tokens(text: str, find=regex.compile(PATTERN).findall) -> tuple[list[str], int]:
    """The pre-tokens of a text and the number of special strings in it, each one token of its own."""
    parts = text.split(SPECIAL)
    found = find(parts[0])
    for part in parts[1:]:
        found += find(part)
    return found, len(parts) - 1


def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk of documents: their frequencies, and the distinct pre-tokens."""
    from pyspark import TaskContext

    task, number = TaskContext.get().partitionId(), 0
    chunk = Chunk()
    for batch in batches:
        sizes = byte_lengths(batch.column("text")).tolist()
        for doc_id, text, size in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), sizes):
            chunk.add(doc_id, text or "", size)
            if chunk.size >= CHUNK_BYTES:
                yield chunk.row(f"{task}-{number}")
                chunk, number = Chunk(), number + 1
    if chunk.doc_ids:
        yield chunk.row(f"{task}-{number}")


class Chunk:
    """Documents as counts of numbered pre-tokens."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.doc_ids, self.sizes, self.specials, self.starts = [], [], [], [0]
        self.terms, self.times, self.size = [], [], 0

    def add(self, doc_id: int | None, text: str, size: int) -> None:
        found, special = pre_tokens(text)
        counts, numbers = Counter(found), self.numbers
        terms = np.fromiter((numbers.setdefault(term, len(numbers)) for term in counts), np.int32, len(counts))
        order = np.argsort(terms)
        self.terms.append(terms[order])
        self.times.append(np.fromiter(counts.values(), np.int32, len(counts))[order])
        self.starts.append(self.starts[-1] + len(counts))
        self.doc_ids.append(doc_id)
        self.sizes.append(size)
        self.specials.append(special)
        # rows without text count as well, so that a chunk's rows are bounded
        self.size += size + 64

    def row(self, name: str) -> pa.RecordBatch:
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        values = {
            "chunk": ([name], pa.string()), "doc_ids": ([self.doc_ids], longs), "n_bytes": ([self.sizes], longs),
            "n_specials": ([self.specials], longs), "starts": ([self.starts], ints),
            "frequencies": ([pack(np.concatenate(self.terms), np.concatenate(self.times))], pa.binary()),
            "pre_tokens": ([list(self.numbers)], pa.list_(pa.string())),
        }
        return pa.RecordBatch.from_pydict({key: pa.array(value, kind) for key, (value, kind) in values.items()})


def pieces_of(path: str):
    """A task that adds ``pieces`` to distinct pre-tokens; ``path`` is the tokenizer's file."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.from_file(path)
        for part in slices(batches, "pre_token", 1 << 20):
            column = part.column("pre_token")
            pieces = [len(one) for one in tokenizer.encode_batch_fast(column.to_pylist(), add_special_tokens=False)]
            yield pa.RecordBatch.from_pydict({"pre_token": column, "pieces": pa.array(pieces, pa.int32())})

    return count


def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequencies times pieces, summed per document."""
    for batch in batches:
        for at in range(batch.num_rows):
            doc_ids, n_bytes, specials, starts, counted = (
                batch.column(name)[at].values for name in ("doc_ids", "n_bytes", "n_specials", "starts", "counted")
            )
            terms, times = unpack(batch.column("frequencies")[at].as_py())
            counts = np.zeros(len(counted), np.int64)
            counts[counted.field("term").to_numpy()] = counted.field("pieces").to_numpy()
            worth = np.concatenate([[0], np.cumsum(times * counts[terms])])
            tokens = np.diff(worth[starts.to_numpy()]) + specials.to_numpy()
            yield pa.RecordBatch.from_pydict({"doc_id": doc_ids, "n_bytes": n_bytes, "n_tokens": pa.array(tokens)})


def count_tokens(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of ``df`` (doc_id, text).

    ``path`` is a byte-level BPE file of the tokenizers library with the fixed pattern above, readable
    on every executor.  NULL and empty texts have no bytes and no tokens; the special string is one
    token, as by the library's default; repeated rows each give a row; an empty frame gives no rows.
    Other columns are ignored.
    """
    chunks = stage(df.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, CHUNKS), "token-chunks")
    terms = chunks.select("chunk", F.posexplode("pre_tokens").alias("term", "pre_token"))
    distinct = terms.select("pre_token").distinct()
    counted = stage(distinct.mapInArrow(pieces_of(path), "pre_token string, pieces int"), "token-pieces")
    by_chunk = stage(
        terms.join(counted, "pre_token").groupBy("chunk").agg(F.collect_list(F.struct("term", "pieces")).alias("counted")),
        "chunk-pieces",
    )
    met = chunks.drop("pre_tokens").join(by_chunk, "chunk", "left")
    met = met.withColumn("counted", F.coalesce("counted", F.array().cast("array<struct<term:int,pieces:int>>")))
    return met.drop("chunk").mapInArrow(add_up, "doc_id long, n_bytes long, n_tokens long")
