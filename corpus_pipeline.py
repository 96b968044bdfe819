"""From raw documents to shards for training, in five stages that each apply one operator of tablemill.llm.

A stage takes (spark, docs, sf_dir) and gives the documents it keeps; each is written and reread before
the next.  All but the last return the columns of documents.  The stages take NULLs in any column, empty
texts, repeated rows and empty tables as their operators do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablemill.llm.decontamination import without_contaminated
from tablemill.llm.hash_ring import assign_shards
from tablemill.llm.minhash import keep_one_of_each
from tablemill.llm.mixing import mixed_rows, word_count
from tablemill.llm.queries import MIX_EPOCHS, MIX_SHARE, MIX_WEIGHTS, SHARDS, table
from tablemill.llm.repetition import keep_varied
from tablemill.llm.staged import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Short and repetitive documents go."""
    return keep_varied(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 80 percent of their five-word shingles, the one with the smallest doc_id stays."""
    return keep_one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go, also with other numbers, names or units."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the weights of their sources ask, twice at most."""
    return mixed_rows(docs, word_count("text"), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row gets its shard and its place there."""
    return assign_shards(docs, ["doc_id", "text"], SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", sharding),
]

# Near-duplicates by signatures and templates are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
