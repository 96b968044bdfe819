"""Encoding by a SentencePiece model of merge type without running its merges, and decoding.

Of all ways to write a text as pieces, the merges give the only one in which each two neighbours, merged anew by
themselves, come out as they were.  It is found by backtracking from left to right: the longest piece that matches
comes first, an Aho-Corasick automaton has it for each position; a piece must be compatible with the one before; else
its longest prefix that is a piece is tried; if none is left, a bit marks the position as failed, so that no other
way leads there again, and the piece before is taken back.  Mostly the longest pieces, one after the other, are compatible
at once, and nothing has to be searched.

Texts are cut where no piece reaches across, which for usual vocabularies is before each run of spaces.  What lies
between is encoded once per worker while a bounded memory holds it.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, types as T

from tablemill.llm.arrow_text import slices

SPACE = "▁"
SLICE_BYTES = 1 << 20
# What a worker remembers: parts of texts with their ids, of limited length, and pairs of pieces.
PARTS_KEPT, LONGEST_KEPT, PAIRS_KEPT = 600_000, 64, 1_000_000


class Vocabulary:
    """The pieces of a model of merge type with byte fallback and without user-defined symbols."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(self.model.get_piece_size())
        plain = [i for i in every if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        spelled = {self.model.id_to_piece(i): i for i in plain if not self.model.is_unused(i)}
        self.bytes = {self.model.id_to_piece(i): i for i in every if self.model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError(f"{path} has no byte fallback")
        self.scores = {piece: self.model.get_score(i) for piece, i in spelled.items()}
        self.alphabet = {letter for piece in spelled for letter in piece}
        # a piece that its own merges do not give never occurs; a letter that is no piece becomes bytes at the end
        reached = [piece for piece in spelled if self.merged(list(piece)) == [piece]]
        self.pieces = reached + sorted(self.alphabet - set(reached))
        self.ids = [
            array("i", [spelled[piece]] if piece in spelled else self.fallback(piece)).tobytes() for piece in self.pieces
        ]
        self.numbers = {piece: number for number, piece in enumerate(self.pieces)}
        self.lengths = [len(piece) for piece in self.pieces]
        self.shorter = [
            next((self.numbers[piece[:size]] for size in range(len(piece) - 1, 0, -1) if piece[:size] in self.numbers), -1)
            for piece in self.pieces
        ]
        self.encoder: Encoder | None = None
        self.parts = None if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in spelled) else f"{SPACE}*[^{SPACE}]+|{SPACE}+"

    def fallback(self, letter: str) -> list[int]:
        """A letter as the ids of its bytes."""
        return [self.bytes[f"<0x{byte:02X}>"] for byte in letter.encode()]

    def merged(self, symbols: list[str]) -> list[str]:
        """The pieces that merging leaves: the pair of best score first, of equal ones the leftmost."""
        symbols = list(symbols)
        while True:
            scores = [self.scores.get(one + two) for one, two in zip(symbols, symbols[1:])]
            known = [score for score in scores if score is not None]
            if not known:
                return symbols
            at = scores.index(max(known))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]


    def search(self) -> Encoder:
        """The search of this process, made when it is first needed."""
        if self.encoder is None:
            self.encoder = Encoder(self)
        return self.encoder


class Encoder:
    """The search of a worker, with what it remembers."""

    def __init__(self, vocabulary: Vocabulary):
        self.known = vocabulary
        self.matches = ahocorasick.Automaton()
        for number, piece in enumerate(vocabulary.pieces):
            self.matches.add_word(piece, number)
        self.matches.make_automaton()
        self.find = re.compile(vocabulary.parts).findall if vocabulary.parts else lambda text: [text] if text else []
        self.pairs: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}

    def compatible(self, one: int, two: int) -> bool:
        """Whether two pieces, merged anew from their letters, come out as they are."""
        key = one << 32 | two
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            left, right = self.known.pieces[one], self.known.pieces[two]
            found = self.pairs[key] = self.known.merged(list(left + right)) == [left, right]
        return found

    def longest_at(self, text: str) -> array:
        """The longest piece that begins at each letter."""
        lengths, longest = self.known.lengths, array("i", [-1]) * len(text)
        for end, number in self.matches.iter(text):
            start = end + 1 - lengths[number]
            # matches come by their ends, so a later one from the same start is longer
            longest[start] = number
        return longest

    def search(self, text: str) -> list[int]:
        """The pieces of a text whose letters all occur in pieces."""
        straight, pairs = [number for _, number in self.matches.iter_long(text)], self.pairs
        for one, two in zip(straight, straight[1:]):
            fits = pairs.get(one << 32 | two)
            if not (self.compatible(one, two) if fits is None else fits):
                return self.backtrack(text)
        return straight

    def backtrack(self, text: str) -> list[int]:
        lengths, shorter, longest = self.known.lengths, self.known.shorter, self.longest_at(text)
        failed, found, at = bytearray(len(text) // 8 + 1), [], 0
        piece = longest[0] if text else -1
        while at < len(text):
            before = found[-1] if found else -1
            while piece >= 0:
                end = at + lengths[piece]
                if not failed[end >> 3] >> (end & 7) & 1 and (before < 0 or self.compatible(before, piece)):
                    break
                piece = shorter[piece]
            if piece >= 0:
                found.append(piece)
                at = end
                piece = longest[at] if at < len(text) else -1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = found.pop()
                at -= lengths[piece]
        return found

    def part(self, text: str) -> bytes:
        """The ids of a part, four bytes each."""
        ids, start = [], 0
        for place, letter in enumerate(text):
            if letter not in self.known.alphabet:
                ids += [self.known.ids[piece] for piece in self.search(text[start:place])]
                ids.append(array("i", self.known.fallback(letter)).tobytes())
                start = place + 1
        ids += [self.known.ids[piece] for piece in self.search(text[start:])]
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        """The ids of a text, four bytes each; the model normalises it first."""
        kept, found = self.kept, []
        for part in self.find(self.known.model.normalize(text)):
            ids = kept.get(part)
            if ids is None:
                ids = self.part(part)
                if len(part) <= LONGEST_KEPT:
                    if len(kept) >= PARTS_KEPT:
                        kept.clear()
                    kept[part] = ids
            found.append(ids)
        return b"".join(found)


def _encoding(known):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = known.value.search()
        for part in slices(batches, "text", SLICE_BYTES):
            found = [encoder.encode(text or "") for text in part.column("text").to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "ids": ids})

    return run


def encode(df: DataFrame, path: str) -> DataFrame:
    """doc_id and ids, the token ids of each row's whole text in ``df`` (doc_id, text).

    ``path`` is a model file of the sentencepiece library of type BPE with byte fallback and without
    user-defined symbols, which the driver reads.  The ids are those of the library, without begin and end.
    NULL and empty texts have no ids; a letter that no piece holds becomes its bytes; names of special pieces
    inside texts are plain text; repeated rows each give a row; an empty frame gives no rows.  Other columns are
    ignored.
    """
    known = df.sparkSession.sparkContext.broadcast(Vocabulary(path))
    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", "text").mapInArrow(_encoding(known), f"doc_id {kind}, ids array<int>")


class Spelling:
    """What each id stands for, as bytes."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.surfaces = [self._surface(i) for i in range(self.model.get_piece_size())]
        #: whether the model puts a space before a text
        self.spaced = self.model.normalize("a").startswith(SPACE)

    def _surface(self, number: int) -> bytes | None:
        piece = self.model.id_to_piece(number)
        if self.model.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        if self.model.is_control(number) or self.model.is_unknown(number) or self.model.is_unused(number):
            return None
        return piece.replace(SPACE, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; the library has the last word on special pieces and on bytes that are no UTF-8."""
        try:
            if min(ids) < 0:
                raise IndexError("piece id is out of range.")
            text = b"".join([self.surfaces[number] for number in ids]).decode()
        except (TypeError, UnicodeDecodeError):
            return self.model.decode(ids)
        return text[1:] if self.spaced and text.startswith(" ") and not self.model.is_byte(ids[0]) else text


def _decoding(known, ids: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = known.value.decode
        for batch in batches:
            lists = batch.column(ids)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            values, start = lists.flatten(), 0
            while start < batch.num_rows:
                first = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, first + SLICE_BYTES // 4, "right")))
                numbers = values.slice(first, int(ends[stop - 1]) - first).to_numpy(zero_copy_only=False).tolist()
                bounds = [0, *(ends[start:stop] - first).tolist()]
                texts = [decode(numbers[at:to]) if to > at else "" for at, to in zip(bounds, bounds[1:])]
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])
                start = stop

    return run


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the text of its token ids by the model in ``path``, which the driver reads.

    NULL and no ids give empty text; bytes that are no UTF-8 become U+FFFD, as by the library; an id
    beyond the vocabulary fails.  Other columns stay, but for one named ``decoded``.
    """
    known = df.sparkSession.sparkContext.broadcast(Spelling(path))
    rows = df.drop("decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(_decoding(known, ids), schema)
