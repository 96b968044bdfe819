"""Queries over transforms: SQL on frames, batches by position, fan-in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablemill.operators.batches import batch_totals, sql_per_batch, sql_per_range, top_per_batch
from tablemill.operators.combine import conform, fan_in
from tablemill.operators.numbering import number_rows
from tablemill.operators.ranges import range_join
from tablemill.operators.skew import look_up
from tablemill.operators.splitting import split_by_position, split_within
from tablemill.operators.staging import scratch_database
from tablemill.operators.transform import passthrough, sql_transform
from tablemill.plans.flows import batch_sql_to_table
from tablemill.plans.registry import query, table
from tablemill.sources.keyranges import pk_bounds, with_pk_batches

UPPER_SQL = "SELECT p_partkey, upper(p_name) AS name, p_retailprice * 1.1 AS adjusted_price FROM input_df"

# Small enough that the tables are numbered range by range, as large ones are.
RANGE_ROWS = 12_000
# Fewer rows than the large groups of the small tables have.
HOT_ROWS = 1_000
# For the smallest of the tables.
FEW_ROWS = 100


@query("SELECT p_partkey, upper(p_name) AS name, p_retailprice * 1.1::DOUBLE AS adjusted_price FROM part")
def sql_transform_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 1.1 is a decimal literal in Spark SQL as well; against a double column it becomes a double
    return sql_transform(UPPER_SQL, table(spark, sf_dir, "part"))


@query("""
SELECT s_suppkey, s_acctbal, s_acctbal + s_suppkey AS sum_col, s_suppkey % 2 AS remainder
FROM supplier WHERE s_acctbal > 10
""")
def sql_transform_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_transform(
        "SELECT s_suppkey, s_acctbal, s_acctbal + s_suppkey AS sum_col, s_suppkey % 2 AS remainder "
        "FROM input_df WHERE s_acctbal > 10",
        table(spark, sf_dir, "supplier"),
    )


@query("""
SELECT event_id AS id, ts, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity,
       strftime(ts, '%Y-%m-%d') AS date_only, strftime(ts, '%H:%M:%S') AS time_only,
       row_number() OVER (ORDER BY ts, event_id) AS row_num
FROM events
""")
def sql_transform_shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parity, date and time text and the position in time, for every event."""
    shaped = sql_transform(
        """
        SELECT event_id AS id, ts, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity,
               date_format(ts, 'yyyy-MM-dd') AS date_only, date_format(ts, 'HH:mm:ss') AS time_only
        FROM input_df
        """,
        table(spark, sf_dir, "events"),
    )
    return number_rows(shaped, ["ts", "id"], into="row_num", tie_break=[], rows_per_task=RANGE_ROWS)


@query("""
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey
""")
def sql_two_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_transform(
        "SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM users_df JOIN orders_df ON c_custkey = o_custkey",
        users_df=table(spark, sf_dir, "customer"),
        orders_df=table(spark, sf_dir, "orders"),
    )


@query("""
SELECT event_id, event_type, json_extract_string(props, '$.k')::BIGINT AS k FROM events
WHERE props <> '{}' AND props IS NOT NULL
""")
def sql_with_braces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text that itself holds braces."""
    return sql_transform(
        "SELECT event_id, event_type, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM input_df "
        "WHERE props <> '{}'",
        table(spark, sf_dir, "events"),
    )


@query("SELECT * FROM customer")
def pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").transform(passthrough)


_BATCHED = """
WITH tagged AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority,
         lo + ((o_orderkey - lo) // 50) * 50 AS batch_key
  FROM orders, (SELECT min(o_orderkey) AS lo FROM orders)
)
"""


@query(_BATCHED + """
SELECT o_orderkey, upper(o_orderpriority) AS priority, o_totalprice, batch_key,
       row_number() OVER (PARTITION BY batch_key ORDER BY o_orderkey) AS row_in_batch,
       sum(o_totalprice::DECIMAL(18,2)) OVER (PARTITION BY batch_key)::DOUBLE AS batch_total
FROM tagged
""")
def batch_sql_fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-range batches, SQL within each, fan-in, load, read back."""
    target = f"{scratch_database(spark)}.fan_in_{uuid.uuid4().hex}"
    batch_sql_to_table(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        50,
        "SELECT o_orderkey, upper(o_orderpriority) AS priority, o_totalprice, batch_key FROM input_df",
        "o_totalprice",
        target,
    )
    return spark.table(target).withColumn("batch_total", F.col("batch_total").cast("double"))


@query(_BATCHED + """
SELECT batch_key, o_orderkey, o_totalprice FROM tagged
QUALIFY row_number() OVER (PARTITION BY batch_key ORDER BY o_totalprice DESC, o_orderkey) <= 3
""")
def batch_top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = with_pk_batches(table(spark, sf_dir, "orders"), "o_orderkey", 50)
    rows = tagged.select("batch_key", "o_orderkey", "o_totalprice")
    return top_per_batch(rows, "batch_key", [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("""
SELECT l_orderkey, l_returnflag, l_quantity, count(*) OVER (PARTITION BY l_returnflag) AS n_rows,
       sum(l_quantity) OVER (PARTITION BY l_returnflag) AS quantity
FROM lineitem
""")
def batch_totals_large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals for three groups that each hold a third of the table."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    return batch_totals(rows, "l_returnflag", {"n_rows": F.count(F.lit(1)), "quantity": F.sum("l_quantity")})


_QUARTERS = """
WITH bounds AS (SELECT min(o_orderkey) AS lo, (max(o_orderkey) - min(o_orderkey) + 4) // 4 AS size FROM orders),
tagged AS (
  SELECT orders.*, lo + ((o_orderkey - lo) // size) * size AS batch_key FROM orders, bounds
)
SELECT batch_key, o_orderstatus, count(*) AS n_rows,
       rank() OVER (PARTITION BY batch_key ORDER BY count(*) DESC) AS place
FROM tagged GROUP BY batch_key, o_orderstatus
"""
_STATUS_SQL = """
SELECT o_orderstatus, count(*) AS n_rows, CAST(rank() OVER (ORDER BY count(*) DESC) AS BIGINT) AS place
FROM input_df GROUP BY o_orderstatus
"""


@query(_QUARTERS)
def batch_any_sql_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL that aggregates and ranks, run on each quarter of the key span."""
    orders = table(spark, sf_dir, "orders")
    lo, hi = pk_bounds(orders, "o_orderkey").first()
    return sql_per_range(orders, _STATUS_SQL, "o_orderkey", (hi - lo + 4) // 4)


@query(_QUARTERS)
def batch_any_sql_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a frame that carries its batch keys."""
    orders = table(spark, sf_dir, "orders")
    lo, hi = pk_bounds(orders, "o_orderkey").first()
    return sql_per_batch(with_pk_batches(orders, "o_orderkey", (hi - lo + 4) // 4), _STATUS_SQL)


@query("""
SELECT o_orderkey // 50 * 50 AS batch_key, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1
""")
def batch_any_sql_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any SQL on each batch of 50 keys of the first key's multiples, however many there are."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sql_per_batch(
        with_pk_batches(orders, "o_orderkey", 50, lo=0), "SELECT count(*) AS n, max(o_totalprice) AS top FROM input_df"
    )


@query("""
WITH tagged AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderkey // 50 * 50 AS batch_key FROM orders),
ranked AS (SELECT *, row_number() OVER (PARTITION BY batch_key ORDER BY o_totalprice DESC, o_orderkey) AS place FROM tagged),
totals AS (SELECT batch_key, count(*) AS n, max(o_totalprice) AS top FROM tagged GROUP BY batch_key)
SELECT batch_key, o_orderkey, o_totalprice, n, top FROM ranked JOIN totals USING (batch_key) WHERE place <= 3
""")
def batch_any_sql_lateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL with a CTE, an aggregate, a join and ORDER BY ... LIMIT on each batch, all batches in one plan."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sql_per_batch(with_pk_batches(orders, "o_orderkey", 50, lo=0), """
        WITH totals AS (SELECT count(*) AS n, max(o_totalprice) AS top FROM input_df)
        SELECT o_orderkey, o_totalprice, n, top FROM input_df CROSS JOIN totals ORDER BY o_totalprice DESC, o_orderkey LIMIT 3
    """)


@query("""
WITH placed AS (
  SELECT o_orderkey, o_orderstatus, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch_no FROM orders
)
SELECT o_orderkey, o_orderstatus, batch_no, min(o_orderkey) OVER (PARTITION BY batch_no) AS batch_key FROM placed
""", name="split_by_position")
def split_by_row_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return split_by_position(rows, "o_orderkey", 100, rows_per_task=RANGE_ROWS)


@query("""
WITH placed AS (
  SELECT doc_id, quality, toxic, (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS batch_no FROM labels
)
SELECT doc_id, quality, toxic, batch_no, min(doc_id) OVER (PARTITION BY batch_no) AS batch_key FROM placed
""")
def split_with_key_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 50 rows, however far apart their keys are."""
    labels = table(spark, sf_dir, "labels")
    return split_by_position(labels, "doc_id", 50, rows_per_task=FEW_ROWS)


@query("""
WITH tied AS (
  SELECT c_nationkey, c_custkey, row_number() OVER (ORDER BY c_nationkey, c_custkey) - 1 AS place FROM customer
), placed AS (SELECT c_nationkey, c_custkey, place // 40 AS batch_no FROM tied)
SELECT c_nationkey, c_custkey, batch_no, min(c_nationkey) OVER (PARTITION BY batch_no) AS batch_key FROM placed
""")
def split_with_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 distinct keys with many rows each: ties go by the second column."""
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey")
    return split_by_position(rows, "c_nationkey", 40, rows_per_task=HOT_ROWS, tie_break="c_custkey")


@query(_BATCHED.replace("50", "200") + """
, placed AS (
  SELECT o_orderkey, batch_key,
         (row_number() OVER (PARTITION BY batch_key ORDER BY o_orderkey) - 1) // 30 AS sub_no
  FROM tagged
)
SELECT o_orderkey, batch_key, sub_no, min(o_orderkey) OVER (PARTITION BY batch_key, sub_no) AS sub_key FROM placed
""")
def split_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = with_pk_batches(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 200)
    return split_within(tagged, "o_orderkey", 30)


@query("""
WITH placed AS (
  SELECT l_returnflag, l_partkey, l_quantity,
         (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_partkey) - 1) // 1000 AS sub_no
  FROM lineitem
)
SELECT l_returnflag, sub_no, count(*) AS n_rows, min(l_partkey) AS sub_key, max(l_partkey) AS last_key
FROM placed GROUP BY l_returnflag, sub_no
""")
def split_nested_large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs within three groups that each hold a third of the table, keys repeated."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_partkey", "l_quantity")
    runs = split_within(rows, "l_partkey", 1000, "l_returnflag", rows_per_task=RANGE_ROWS)
    return runs.groupBy("l_returnflag", "sub_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.first("sub_key").alias("sub_key"), F.max("l_partkey").alias("last_key")
    )


@query("""
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS brand FROM customer
UNION ALL BY NAME
SELECT p_partkey AS id, p_name AS name, p_brand AS brand FROM part
""")
def fan_in_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    parts = table(spark, sf_dir, "part").selectExpr("p_brand AS brand", "p_name AS name", "p_partkey AS id")
    return fan_in([people, parts])


@query("""
SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, NULL::DATE AS since FROM supplier
""")
def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "supplier"), "s_suppkey BIGINT, s_name STRING, s_nationkey BIGINT, since DATE")


@query("""
SELECT o_orderkey, o_orderstatus, row_number() OVER w AS place,
       (sum(o_totalprice::DECIMAL(18,2)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE AS so_far
FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey)
""")
def running_sums_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and running sums in a few large groups, each cut into ranges."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    numbered = number_rows(
        orders, "o_orderkey", "o_orderstatus", into="place", rows_per_task=HOT_ROWS,
        running={"so_far": F.col("o_totalprice").cast("decimal(18,2)")},
    )
    return numbered.select("o_orderkey", "o_orderstatus", "place", F.col("so_far").cast("double").alias("so_far"))


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) <= 1500
""")
def batch_top_many_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More first rows per batch than Spark limits before the shuffle by itself."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return top_per_batch(orders, "o_orderstatus", [F.desc("o_totalprice"), F.asc("o_orderkey")], 1500)


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag, n FROM lineitem
JOIN (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag) USING (l_returnflag)
""")
def look_up_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join to one row per key where each key has a large share of the rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    counts = lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return look_up(lines, counts, ["l_returnflag"], rows_per_task=HOT_ROWS)


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, p_partkey FROM lineitem JOIN part
ON l_extendedprice BETWEEN p_retailprice * 20 AND p_retailprice * 20 + 5
""")
def join_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose price lies in the interval of a part."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    parts = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice") * 20).alias("low"))
    found = range_join(items, parts, F.col("l_extendedprice"), F.col("low"), F.col("low") + 5, width=5)
    return found.drop("low")
