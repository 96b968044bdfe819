"""Queries over sources: whole results, key ranges, parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablemill.operators.staging import scratch_database
from tablemill.plans.registry import query, table
from tablemill.sources.files import extract_parquet
from tablemill.sources.keyranges import batch_grid, pk_bounds, read_batch, with_pk_batches
from tablemill.sources.query import extract_sql

_GRID_ORACLE = """
WITH bounds AS (SELECT min(doc_id) AS lo, max(doc_id) AS hi FROM labels),
grid AS (SELECT unnest(generate_series(lo, hi, 5)) AS batch_key FROM bounds),
counts AS (
  SELECT lo + ((doc_id - lo) // 5) * 5 AS batch_key, count(*) AS n FROM labels, bounds
  WHERE doc_id IS NOT NULL GROUP BY 1
)
SELECT batch_key, coalesce(n, 0)::BIGINT AS n_rows FROM grid LEFT JOIN counts USING (batch_key)
"""


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'", name="extract_sql")
def extract_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"orders_{uuid.uuid4().hex}"
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    result = extract_sql(
        spark,
        ["SELECT o_orderkey, o_custkey, o_orderdate", "FROM IDENTIFIER(:source)", "WHERE o_orderstatus = :status"],
        args={"source": view, "status": "F"},
    )
    spark.catalog.dropTempView(view)
    return result


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def extract_from_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"customer_{uuid.uuid4().hex}"
    database = scratch_database(spark)
    table(spark, sf_dir, "customer").write.format("parquet").saveAsTable(f"{database}.{name}")
    return extract_sql(spark, f"SELECT c_custkey, c_name, c_mktsegment FROM {name}", namespace=database)


@query("""
SELECT vec_id, label, i AS place, embedding[i]::DOUBLE AS item FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i)
""")
def extract_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = extract_parquet(spark, f"{sf_dir}/embeddings.parquet")
    items = vectors.select("vec_id", "label", F.posexplode("embedding").alias("place", "item"))
    return items.select("vec_id", "label", (F.col("place") + 1).cast("bigint").alias("place"), F.col("item").cast("double").alias("item"))


@query("SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders", name="pk_bounds")
def key_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk_bounds(table(spark, sf_dir, "orders"), "o_orderkey")


@query("""
SELECT lo + ((o_orderkey - lo) // 50) * 50 AS batch_key, count(*) AS n_rows, min(o_orderkey) AS first_key
FROM orders, (SELECT min(o_orderkey) AS lo FROM orders) GROUP BY 1
""")
def pk_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = with_pk_batches(table(spark, sf_dir, "orders"), "o_orderkey", 50)
    return tagged.groupBy("batch_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_key")
    )


@query("""
SELECT lo + ((l_orderkey - lo) // 50) * 50 AS batch_key, count(*) AS n_rows,
       sum(l_quantity) AS quantity
FROM lineitem, (SELECT min(l_orderkey) AS lo FROM lineitem) GROUP BY 1
""")
def pk_batches_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = with_pk_batches(table(spark, sf_dir, "lineitem"), "l_orderkey", 50)
    return tagged.groupBy("batch_key").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("l_quantity").alias("quantity"),
    )


@query(_GRID_ORACLE)
def pk_batches_with_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_grid(table(spark, sf_dir, "labels"), "doc_id", 5)


_MIDDLE = """
WITH bounds AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) - min(o_orderkey) + 1 AS span FROM orders)
SELECT orders.* FROM orders, bounds
WHERE o_orderkey >= lo + (span + 2) // 3 AND o_orderkey < lo + 2 * ((span + 2) // 3)
"""


@query(_MIDDLE)
def read_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle one of three ranges that cover the table."""
    orders = table(spark, sf_dir, "orders")
    lo, hi = pk_bounds(orders, "o_orderkey").first()
    size = (hi - lo + 3) // 3
    return read_batch(orders, "o_orderkey", lo + size, size)


@query("SELECT * FROM orders")
def read_all_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges read one by one make up the table."""
    orders = table(spark, sf_dir, "orders")
    lo, hi = pk_bounds(orders, "o_orderkey").first()
    size = (hi - lo + 4) // 4
    parts = [read_batch(orders, "o_orderkey", lo + number * size, size) for number in range(4)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
