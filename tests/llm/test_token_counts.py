"""Token counts against the library itself."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablemill.llm import token_counts
from tablemill.llm.queries import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "  a", "a  \n\n b\t\tc <|endoftext|>x<|endoftext|> ", "<|endoftext|>", "\x1c\x1d a   　b 's it's '  're",
    "é" * 3000, "a" * 20_000, " \n" * 50, "٣४ 12³ ½ Ⅷ", "​‍ zero\x85 n", "𝔘𝔫𝔦 👩‍👩‍👧 <|endoftext", "\x00 b", "it's a 'dog' they'll",
]


@pytest.mark.parametrize("chunk", [token_counts.CHUNK_BYTES, 100])
def test_as_the_library_counts(spark, monkeypatch, chunk):
    monkeypatch.setattr(token_counts, "CHUNK_BYTES", chunk)
    tokenizer = Tokenizer.from_file(PATH)
    texts = [*ODD, *ODD[:3], *(r.text for r in table(spark, "/root/testdata/sf0.001", "documents").select("text").collect())]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("chunk", F.lit("x"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(df, PATH).collect()}
    assert len(got) == len(texts)
    for doc, text in enumerate(texts):
        assert got[doc] == (len((text or "").encode()), len(tokenizer.encode(text or "", add_special_tokens=False))), text


def test_rows_without_id_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c")], "doc_id long, text string")
    assert sorted(str((r.doc_id, r.n_tokens)) for r in token_counts.count_tokens(df, PATH).collect()) == ["(1, 1)", "(None, 2)", "(None, 2)"]
    assert token_counts.count_tokens(df.limit(0), PATH).count() == 0
