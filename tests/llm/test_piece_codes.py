"""Backtracking over pieces against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tablemill.llm import piece_codes
from tablemill.llm.piece_codes import Encoder, Vocabulary, decode, encode
from tablemill.llm.queries import QUERIES, table

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "   ", "a", " a", "a ", "▁", "▁▁a ▁", "a  b   c    d" + " " * 31 + "e", " " * 15, " " * 40, "=" * 77, "\n\n\t \r\n",
    "<s></s><unk><0x0A>", "\x00a\x00", "é" * 50, "é", "ﬁ ½ Ⅷ １２", "中文字符 日本語テキスト 한국어", "👩‍👩‍👧 𝔘𝔫𝔦", "​﻿ 　x\x85y",
    "a" * 3000, "ab" * 2000, "https://example.org/?q=1&r=%20", "int main() {\n    return 0;\n}", "The quick brown fox jumps over the lazy dog.",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Vocabulary(PATH))


def ids_of(encoder, text):
    packed = encoder.encode(text)
    return [int.from_bytes(packed[at : at + 4], "little") for at in range(0, len(packed), 4)]


def test_random_texts(library, encoder):
    draw = random.Random(1)
    letters = [" ", " ", " ", "▁", "\n", *"aabcdeeeinorstt.,0123", "é", "ß", "中", "ж", "😀", "́", "\x00"]
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in draw.sample(range(259, 32000), 4000)]
    for _ in range(3000):
        text = "".join(draw.choice(letters if draw.random() < 0.5 else pieces) for _ in range(draw.randint(0, 30)))
        assert ids_of(encoder, text) == library.encode(text), repr(text)


def test_whole_texts_without_cuts(library, encoder, monkeypatch):
    """The search itself, over words and spaces together, gives the same ids."""
    monkeypatch.setattr(encoder, "find", lambda text: [text] if text else [])
    for text in ODD[1:]:
        assert ids_of(encoder, text) == library.encode(text), repr(text)


@pytest.mark.parametrize("slice_bytes,parts_kept", [(1 << 20, 200_000), (50, 3)])
def test_as_the_library(spark, library, monkeypatch, slice_bytes, parts_kept):
    monkeypatch.setattr(piece_codes, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(piece_codes, "PARTS_KEPT", parts_kept)
    texts = [*ODD, *ODD[:3]]
    rows = [(None if n == 3 else n, text) for n, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("decoded", F.lit("y"))
    got = decode(encode(df, PATH), PATH).collect()
    want = [(n, library.encode(text or ""), library.decode(library.encode(text or ""))) for n, text in rows]
    key = lambda row: (row[0] is None, row[0] or 0)
    assert sorted((tuple(row) for row in got), key=key) == sorted(want, key=key)


def test_decoding_of_any_ids(spark, library):
    lists = [None, [], [0, 1, 2], [3 + 0xFF, 3 + 0x41], [3 + 0xE4, 3 + 0xB8, 3 + 0xAD], [3 + 0xE4, 29871], [29871, 29871]]
    df = spark.createDataFrame(list(enumerate(lists)), "n int, ids array<int>").withColumn("text", F.lit("kept"))
    got = {row.n: row for row in decode(df, PATH).collect()}
    assert [got[n].decoded for n in range(len(lists))] == [library.decode(one) if one else "" for one in lists]
    assert got[0].ids is None and got[1].text == "kept"


def test_query_on_the_table(spark, library):
    folder = "/root/testdata/sf0.001"
    got = {row.doc_id: tuple(row)[1:] for row in QUERIES["op13_piece_backtracking"](spark, folder).collect()}
    rows = table(spark, folder, "documents").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for row in rows:
        ids = library.encode(row.text or "")
        assert got[row.doc_id] == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))


def test_empty_frame(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert decode(encode(df, PATH), PATH).collect() == []
