"""Queries over merges and over changes of partitioned tables: each writes, then returns what the target holds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablemill.operators.rewrite import (
    delete_rows,
    merge_rows,
    update_rows,
    when_matched_delete,
    when_matched_update,
    when_not_matched_by_source_delete,
    when_not_matched_by_source_update,
    when_not_matched_insert,
)
from tablemill.operators.staging import scratch_database
from tablemill.operators.tables import load_table
from tablemill.plans.registry import query, table
from tablemill.streaming.snapshots import refresh_from_snapshot


def _target(spark: SparkSession, label: str) -> str:
    return f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex}"


_MERGED = """
WITH t AS (SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer),
s AS (SELECT p_partkey * 2 AS id, p_retailprice AS balance, 'part''s' AS segment FROM part)
SELECT coalesce(t.id, s.id) AS id,
    CASE WHEN t.id IS NULL THEN s.balance
        WHEN s.id IS NULL AND t.balance < 0 THEN 0
        WHEN s.id IS NOT NULL AND t.balance < 0 THEN t.balance + s.balance
        ELSE t.balance END AS balance,
    CASE WHEN t.id IS NULL THEN 'new'
        WHEN s.id IS NOT NULL AND NOT t.balance < 0 THEN s.segment
        ELSE t.segment END AS segment
FROM t FULL JOIN s ON t.id = s.id
WHERE CASE WHEN t.id IS NULL THEN s.id % 3 = 0
    WHEN s.id IS NULL THEN NOT t.id % 7 = 0
    ELSE NOT s.balance > 1500 END
"""


def _merged(spark: SparkSession, sf_dir: str, partition_by: list[str]) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_acctbal AS balance", "c_mktsegment AS segment")
    target = load_table(customers, _target(spark, "merged"), partition_by=partition_by)
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey * 2 AS id", "p_retailprice AS balance", "\"part's\" AS segment")
    merge_rows(target, parts, ["id"], [
        when_matched_delete(F.col("source.balance") > 1500),
        when_matched_update({"balance": F.col("target.balance") + F.col("source.balance")}, F.col("target.balance") < 0),
        when_matched_update({"segment": F.col("source.segment")}),
        when_not_matched_insert(
            {"id": F.col("source.id"), "balance": F.col("source.balance"), "segment": F.lit("new")}, F.col("source.id") % 3 == 0
        ),
        when_not_matched_by_source_delete(F.col("target.id") % 7 == 0),
        when_not_matched_by_source_update({"balance": F.lit(0)}, F.col("target.balance") < 0),
    ])
    return spark.table(target)


@query(_MERGED)
def merge_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of clause, each on a condition; the first that holds acts."""
    return _merged(spark, sf_dir, [])


@query(_MERGED)
def merge_clauses_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a partitioned table, whose rows change partitions."""
    return _merged(spark, sf_dir, ["segment"])


@query("""
SELECT c_custkey, c_acctbal, 'it''s "' || c_mktsegment || '" \\ ' || (c_custkey % 3) AS place FROM customer
WHERE c_custkey % 3 <> 1 OR c_mktsegment <> 'BUILDING'
""")
def delete_quoted_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions whose values hold quotes and backslashes change, and one that loses its rows goes."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal",
        F.concat(F.lit("it's \""), "c_mktsegment", F.lit('" \\ '), (F.col("c_custkey") % 3).cast("string")).alias("place"),
    )
    target = load_table(customers, _target(spark, "quoted"), partition_by=["place"])
    update_rows(spark, target, F.col("c_custkey") % 5 == 0, {"c_acctbal": F.col("c_acctbal") + 0})
    delete_rows(spark, target, F.col("place").contains("BUILDING") & (F.col("c_custkey") % 3 == 1))
    return spark.table(target)


@query("""
SELECT 'target' AS held_by, o_orderkey, o_orderstatus FROM orders
UNION ALL SELECT 'backup' AS held_by, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
""")
def load_beside_foreign_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the user's that is named like a backup stays what it is."""
    orders, target = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), _target(spark, "own")
    backup = load_table(orders.where("o_orderstatus = 'F'"), f"{target}_old_backup")
    load_table(orders, target)
    load_table(orders, target, recreate=True)
    return spark.table(target).select(F.lit("target").alias("held_by"), "*").unionByName(
        spark.table(backup).select(F.lit("backup").alias("held_by"), "*")
    )


@query("""
SELECT o_orderkey, upper(o_orderpriority) AS priority,
    CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderkey % 5 <> 0
UNION ALL SELECT -o_orderkey, upper(o_orderpriority), o_totalprice FROM orders WHERE o_orderkey % 5 = 1
""")
def refresh_after_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upstream is made anew with rows gone, changed and added; downstream gets the difference, and nothing the next time."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    upstream, target = load_table(orders, _target(spark, "upstream")), _target(spark, "downstream")
    sql = "SELECT o_orderkey, upper(o_orderpriority) AS priority, o_totalprice FROM input_df"
    refresh_from_snapshot(spark.table(upstream), target, ["o_orderkey"], sql=sql)
    kept = orders.where("o_orderkey % 5 <> 0").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    added = orders.where("o_orderkey % 5 = 1").withColumn("o_orderkey", -F.col("o_orderkey"))
    load_table(kept.unionByName(added), upstream, recreate=True)
    refresh_from_snapshot(spark.table(upstream), target, ["o_orderkey"], sql=sql)
    again = refresh_from_snapshot(spark.table(upstream), target, ["o_orderkey"], sql=sql)
    if any(again.values()):
        raise AssertionError(f"nothing had changed, but the refresh found {again}")
    return spark.table(target)
