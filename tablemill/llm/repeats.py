"""Windows that stand more than once in a corpus: what substring removal by any index has in common.

Comparing all windows of all texts would move each text many times over.  Instead:

1. each text is cut into segments by its anchors (see ``anchors``); only segments whose anchor stands
   elsewhere too, or that pick it in several places, can hold a window that stands more than once, and only
   hashes of segments are shuffled to find them;
2. segments that are equal as a whole are represented by the first of them;
3. the representatives' contents go to shards by anchor, so equal windows meet in a shard, which an
   index over the shard's contents compares exactly;
4. an anchor with more different segments than fill a shard is not put into one: its windows are counted
   one by one, by hash.
5. what is found goes back to the texts by row.

Rows are known by doc_id and a hash of their text.  NULL ids come last.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablemill.llm.anchors import mixed, range_hashes, segments, word_hashes
from tablemill.llm.arrow_text import raw_bytes, slices, word_places
from tablemill.llm.staged import stage

NO_ID = (1 << 63) - 1
SHARD_BYTES = 3 << 20

CANDIDATE = "anchor long, whole long, d long, h long, start int, n_windows int, periodic boolean"
PIECE = "anchor long, copies long, d long, h long, start int, n_windows int, content binary"
FOUND = "d long, h long, start int, n_windows int"
BYTE_HASH = mixed(np.arange(1, 257, dtype=np.uint64))
OTHER_BYTE_HASH = mixed(np.arange(1001, 1257, dtype=np.uint64))


@dataclass(frozen=True)
class Cut:
    """Windows of ``length`` items, which are words or bytes, with anchors of ``gram`` items."""

    words: bool
    length: int
    gram: int

    @property
    def item_bytes(self) -> int:
        return 8 if self.words else 1

    @property
    def most_segments(self) -> int:
        """How many different segments of one anchor fill a shard; a segment has less than twice a window's items."""
        return SHARD_BYTES // (2 * self.length * self.item_bytes)

    def items(self, raw: np.ndarray, starts: np.ndarray, table: np.ndarray = BYTE_HASH) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each item of all texts, and the bounds of each text in items."""
        if not self.words:
            return table[raw], starts
        begins, ends, bounds = word_places(raw, starts)
        return word_hashes(raw, begins, ends, table), bounds


def keyed(df: DataFrame) -> DataFrame:
    """doc_id and text with the row's key (d, h)."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"), F.xxhash64("text").alias("h"),
    )


def find_segments(cut: Cut):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 19):
            raw, starts = raw_bytes(part.column("text"))
            items, bounds = cut.items(raw, starts)
            anchor, row, start, count, periodic = segments(items, bounds, cut.length, cut.gram)
            begin = bounds[row] + start
            whole = range_hashes(items, begin, begin + count - 1 + cut.length).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": pa.array(anchor), "whole": pa.array(whole),
                    "d": part.column("d").take(pa.array(row)), "h": part.column("h").take(pa.array(row)),
                    "start": pa.array(start, pa.int32()), "n_windows": pa.array(count, pa.int32()),
                    "periodic": pa.array(periodic),
                }
            )

    return rows


def contents(cut: Cut, hot: bool):
    """The contents of the wanted segments of each row, or of hot ones a hash of every window."""
    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 19):
            out = {name: [] for name in ("anchor", "copies", "d", "h", "start", "n_windows", "content")}
            for text, d, h, wanted in zip(*(part.column(name).to_pylist() for name in ("text", "d", "h", "wanted"))):
                whole = (text or "").encode()
                split = whole.split() if cut.words else whole
                for one in wanted:
                    until = one["start"] + one["n_windows"] - 1 + cut.length
                    if until > len(split):
                        continue
                    content = split[one["start"] : until]
                    out["content"].append(b" ".join(content) if cut.words else content)
                    out["d"].append(d)
                    out["h"].append(h)
                    for name in ("anchor", "copies", "start", "n_windows"):
                        out[name].append(one[name])
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": pa.array(out["anchor"], pa.int64()), "copies": pa.array(out["copies"], pa.int64()),
                    "d": pa.array(out["d"], pa.int64()), "h": pa.array(out["h"], pa.int64()),
                    "start": pa.array(out["start"], pa.int32()), "n_windows": pa.array(out["n_windows"], pa.int32()),
                    "content": pa.array(out["content"], pa.binary()),
                }
            )

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 19):
            raw, starts = raw_bytes(part.column("text"))
            both = [cut.items(raw, starts, table) for table in (BYTE_HASH, OTHER_BYTE_HASH)]
            bounds = both[0][1]
            wanted = part.column("wanted")
            row = np.repeat(np.arange(part.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
            flat = wanted.flatten()
            start, count, copies = (
                flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("start", "n_windows", "copies")
            )
            fits = start + count - 1 + cut.length <= (bounds[1:] - bounds[:-1])[row]
            row, start, count, copies = row[fits], start[fits], count[fits], copies[fits]
            each = np.repeat(np.arange(len(row)), count)
            place = start[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
            at = bounds[row[each]] + place
            one, two = (range_hashes(items, at, at + cut.length).astype(np.int64) for items, _ in both)
            yield pa.RecordBatch.from_pydict(
                {
                    "one": pa.array(one), "two": pa.array(two), "copies": pa.array(copies[each]),
                    "d": part.column("d").take(pa.array(row[each])), "h": part.column("h").take(pa.array(row[each])),
                    "start": pa.array(place, pa.int32()),
                }
            )

    return windows if hot else pieces


Index = Callable[[dict[str, np.ndarray], list[bytes]], list[np.ndarray]]


def index_shard(search: Index):
    """A task that runs ``search`` over blocks of whole anchors and gives the runs of windows it marks."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        columns = {name: table.column(name).to_numpy() for name in ("anchor", "copies", "d", "h", "start", "n_windows")}
        content = table.column("content").to_pylist()
        by = np.argsort(columns["anchor"], kind="stable")
        anchor = columns["anchor"][by]
        size = np.cumsum([len(content[at]) for at in by])
        last = np.append(anchor[1:] != anchor[:-1], True)
        begin = 0
        while begin < len(by):
            before = size[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, before + SHARD_BYTES, "right")))
            end = int(np.nonzero(last[end - 1 :])[0][0]) + end
            block = by[begin:end]
            chosen = {name: values[block] for name, values in columns.items()}
            marked = search(chosen, [content[at] for at in block])
            row, offset, length = runs(marked)
            yield pa.RecordBatch.from_pydict(
                {
                    "d": pa.array(chosen["d"][row]), "h": pa.array(chosen["h"][row], pa.int64()),
                    "start": pa.array(chosen["start"][row] + offset, pa.int32()), "n_windows": pa.array(length, pa.int32()),
                }
            )
            begin = end

    return rows


def runs(marked: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, number) of the runs of true values in each row."""
    lengths = np.array([len(one) + 1 for one in marked], np.int64)
    flat = np.concatenate([np.append(one, False) for one in marked])
    bound = np.concatenate([[0], np.cumsum(lengths)])
    edges = np.diff(np.concatenate([[False], flat]).astype(np.int8))
    first, end = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
    row = np.searchsorted(bound, first, "right") - 1
    return row, first - bound[row], end - first


def repeated_windows(keyed_rows: DataFrame, cut: Cut, search: Index, keep_first: bool) -> DataFrame:
    """Runs of windows (d, h, start, n_windows) that equal a window elsewhere; only later ones if ``keep_first``.

    Runs of a row may meet but name each window at least once.
    """
    spark = keyed_rows.sparkSession
    found = keyed_rows.select("d", "h", "text").mapInArrow(find_segments(cut), CANDIDATE)
    counts = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("periodic").alias("periodic"))
    several = stage(counts.where("n > 1 OR periodic").select("anchor"), "anchors")
    candidates = stage(found.drop("periodic").join(several, "anchor"), "candidates")
    first = F.min(F.struct("d", "start", "h", "n_windows")).alias("first")
    chosen = stage(
        candidates.groupBy("anchor", "whole").agg(first, F.count(F.lit(1)).alias("copies")).select(
            "anchor", "whole", "first.*", "copies"
        ),
        "representatives",
    )
    # equal as a whole
    others = chosen.where("copies > 1").select("anchor", "whole", *[F.col(c).alias(f"first_{c}") for c in ("d", "h", "start")])
    equal = candidates.join(others, ["anchor", "whole"])
    if keep_first:
        equal = equal.where("(d, start) <> (first_d, first_start)")
    equal = equal.select("d", "h", "start", "n_windows")
    # representatives, each read from its row once
    per_anchor = stage(
        chosen.groupBy("anchor").agg(F.count(F.lit(1)).alias("different"), F.sum(F.col("n_windows") + cut.length).alias("items")),
        "per-anchor",
    )
    items = per_anchor.where(F.col("different") <= cut.most_segments).agg(F.sum("items")).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, math.ceil(items * cut.item_bytes / SHARD_BYTES))
    many = per_anchor.where(F.col("different") > cut.most_segments).select("anchor", F.lit(True).alias("many"))
    wanted = chosen.join(many, "anchor", "left").groupBy("d", "h").agg(
        F.collect_list(F.when(F.col("many").isNull(), F.struct("anchor", "copies", "start", "n_windows"))).alias("wanted"),
        F.collect_list(F.when(F.col("many"), F.struct("anchor", "copies", "start", "n_windows"))).alias("hot"),
    )
    texts = keyed_rows.select("d", "h", "text").join(wanted, ["d", "h"])
    read = stage(texts, "representative-texts")
    pieces = read.select("d", "h", "text", "wanted").where(F.size("wanted") > 0).mapInArrow(contents(cut, False), PIECE)
    indexed = pieces.repartition(shards, "anchor").mapInArrow(index_shard(search), FOUND)
    one_by_one = stage(
        read.select("d", "h", "text", F.col("hot").alias("wanted")).where(F.size("wanted") > 0).mapInArrow(
            contents(cut, True), "one long, two long, copies long, d long, h long, start int"
        ),
        "windows",
    )
    met = stage(
        one_by_one.groupBy("one", "two").agg(F.sum("copies").alias("times"), F.min(F.struct("d", "start")).alias("first")).where("times > 1"),
        "window-counts",
    )
    again = one_by_one.join(met, ["one", "two"])
    if keep_first:
        again = again.where("(d, start) <> (first.d, first.start)")
    again = again.select("d", "h", "start", F.lit(1).alias("n_windows"))
    return equal.unionByName(indexed).unionByName(again)


def remove(cut: Cut):
    """A task that removes the marked windows of each row and digests what is left."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            n_items, n_removed, n_spans, digest = [], [], [], []
            marked = part.column("marked")
            for at, text in enumerate(part.column("text").to_pylist()):
                whole = (text or "").encode()
                items = whole.split() if cut.words else np.frombuffer(whole, np.uint8)
                gone = np.zeros(len(items), bool)
                if marked[at].is_valid:
                    start, count = (marked[at].values.field(name).to_numpy().astype(np.int64) for name in ("start", "n_windows"))
                    edges = np.bincount(start, minlength=len(items) + 1) - np.bincount(
                        start + count - 1 + cut.length, minlength=len(items) + 1
                    )
                    gone = np.cumsum(edges[: len(items)]) > 0
                    if cut.words:
                        left = b" ".join([word for word, out in zip(items, gone.tolist()) if not out])
                    else:
                        left = items[~gone].tobytes()
                else:
                    left = b" ".join(items) if cut.words else whole
                n_items.append(len(items))
                n_removed.append(int(gone.sum()))
                n_spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
                digest.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "n_items": pa.array(n_items, pa.int64()),
                    "n_removed": pa.array(n_removed, pa.int64()),
                    "n_spans": pa.array(n_spans, pa.int64()),
                    "kept_sha256": pa.array(digest, pa.string()),
                }
            )

    return rows


def without_repeats(df: DataFrame, cut: Cut, search: Index, keep_first: bool) -> DataFrame:
    """doc_id, n_items, n_removed, n_spans and kept_sha256 of every row of ``df`` (doc_id, text)."""
    rows = keyed(df)
    marked = repeated_windows(rows, cut, search, keep_first)
    per_row = marked.groupBy("d", "h").agg(F.collect_list(F.struct("start", "n_windows")).alias("marked"))
    return rows.join(per_row, ["d", "h"], "left").select("doc_id", "text", "marked").mapInArrow(
        remove(cut), "doc_id long, n_items long, n_removed long, n_spans long, kept_sha256 string"
    )
