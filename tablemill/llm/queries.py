"""The registered queries of this subpackage, with the SQL that gives the same rows where there is such SQL.

A query applies its operator to a whole table and derives the columns it returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablemill.llm import sql
from tablemill.llm.collocations import collocations
from tablemill.llm.decontamination import judge_documents
from tablemill.llm.fm_substrings import remove_repeated_words
from tablemill.llm.hash_ring import assign_shards
from tablemill.llm.html_region import main_texts
from tablemill.llm.line_chunks import remove_repeated_chunks
from tablemill.llm.minhash import near_duplicates
from tablemill.llm.mixing import mix, word_count
from tablemill.llm.piece_codes import decode, encode
from tablemill.llm.repetition import judge, repetition_stats
from tablemill.llm.suffix_dedup import remove_repeated_bytes
from tablemill.llm.token_counts import count_tokens
from tablemill.llm.vector_codes import codebooks_sha256, compress

TOKEN_LIMIT = 1024
SHARDS = 24
MIX_WEIGHTS = [3, 1, 2]
MIX_SHARE = 1.5
MIX_EPOCHS = 2.0

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query()
def op1_html_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


@query(sql.REPETITION)
def op2_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(repetition_stats(table(spark, sf_dir, "documents"))).drop("longest_repeat")


@query(sql.WORD_WINDOWS)
def op3_fm_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_words(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.col("n_items").alias("n_words"), "n_removed", "kept_sha256")


@query(sql.LINE_CHUNKS)
def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("kept_text", 256)).drop("kept_text")


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query()
def op6_hash_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = assign_shards(rows, ["doc_id", "text_crc32", "size"], SHARDS)
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


@query(sql.NEAR)
def op7_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op8_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).withColumnRenamed("n_items", "n_bytes")


@query(sql.MIXING)
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size"))
    mixed = mix(rows, "size", MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS)
    return mixed.select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("size") * F.col("_times")).alias("taken"),
    )


@query(sql.COLLOCATIONS)
def op11_rollup_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=30, covered=80, most=2000, scale=2_000_000)


@query(sql.VECTOR_CODES)
def op12_hadamard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)
    return coded.drop("label").withColumn("codebooks_sha256", F.lit(codebooks_sha256(books)))


@query()
def op13_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
