"""SQL that users pass through: joins, aggregates, windows, sets and warehouse functions.

Nothing is built for these; each shows that the SQL runs on bound frames as Spark plans it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablemill.operators.numbering import number_rows
from tablemill.operators.transform import sql_transform
from tablemill.plans.registry import query, table


def _run(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return sql_transform(sql, **{name: table(spark, sf_dir, name) for name in names})


JOIN_INNER = """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey, o_orderstatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
JOIN_LEFT = """
SELECT c_custkey, c_name, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'
"""
JOIN_SEMI = "SELECT * FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')"
JOIN_ANTI = "SELECT * FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)"
AGG_DISTINCT = """
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders,
       sum(l_quantity) AS quantity, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""
AGG_ROLLUP = """
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, sum(l_quantity) AS quantity
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
"""
AGG_CUBE = "SELECT o_orderstatus, o_orderpriority, count(*) AS n_rows FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)"
GROUPING_SETS = """
SELECT c_nationkey, c_mktsegment, count(*) AS n_rows FROM customer
GROUP BY GROUPING SETS ((c_nationkey), (c_mktsegment), ())
"""
WINDOW_RANK_RUNNING = """
SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
FROM orders
"""
TOP_K = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"
SET_INTERSECT = "SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier"
SET_EXCEPT = "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 200000"
SET_UNION = "SELECT c_nationkey AS nation FROM customer UNION SELECT n_nationkey FROM nation"
THREE_JOINS = """
SELECT r_name, n_name, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name
"""


@query(JOIN_INNER)
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, JOIN_INNER, "lineitem", "orders")


@query(JOIN_LEFT)
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, JOIN_LEFT, "customer", "orders")


@query(JOIN_SEMI)
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, JOIN_SEMI, "customer", "orders")


@query(JOIN_ANTI)
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, JOIN_ANTI, "part", "lineitem")


@query(THREE_JOINS)
def join_several(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, THREE_JOINS, "orders", "customer", "nation", "region")


@query(AGG_DISTINCT)
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, AGG_DISTINCT, "lineitem")


@query(AGG_ROLLUP)
def agg_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, AGG_ROLLUP, "lineitem")


@query(AGG_CUBE)
def agg_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, AGG_CUBE, "orders")


@query(GROUPING_SETS)
def agg_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, GROUPING_SETS, "customer")


@query(WINDOW_RANK_RUNNING)
def window_rank_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By range, not by SQL window: one customer may hold any share of the orders."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    numbered = number_rows(
        rows, ["o_orderdate", "o_orderkey"], "o_custkey", into="place", tie_break=[],
        running={"running": F.col("o_totalprice").cast("decimal(18,2)")},
    )
    return numbered.select("o_custkey", "o_orderkey", "place", F.col("running").cast("double").alias("running"))


@query(TOP_K)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, TOP_K, "orders")


@query(SET_INTERSECT)
def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, SET_INTERSECT, "customer", "supplier")


@query(SET_EXCEPT)
def set_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, SET_EXCEPT, "customer", "orders")


@query(SET_UNION)
def set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, SET_UNION, "customer", "nation")


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 1000 THEN 'large' ELSE 'small' END AS size_class,
       coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS priority,
       CASE WHEN nullif(o_orderstatus, 'F') IS NOT NULL THEN 'open' ELSE 'final' END AS state,
       o_orderdate + INTERVAL 10 DAY AS due, date_diff('day', TIMESTAMP '1990-01-01', o_orderdate) AS age_days
FROM orders
""")
def warehouse_conditionals_and_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IFF, NVL, IFNULL, NVL2, DATEADD and DATEDIFF of other warehouses, in Spark's names."""
    return _run(spark, sf_dir, """
        SELECT o_orderkey, if(o_totalprice > 1000, 'large', 'small') AS size_class,
               nvl(ifnull(nullif(o_orderpriority, '5-LOW'), NULL), 'none') AS priority,
               nvl2(nullif(o_orderstatus, 'F'), 'open', 'final') AS state,
               CAST(dateadd(DAY, 10, o_orderdate) AS TIMESTAMP_NTZ) AS due,
               CAST(datediff(o_orderdate, TIMESTAMP_NTZ '1990-01-01 00:00:00') AS BIGINT) AS age_days
        FROM orders
        """, "orders")


@query("""
SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS built,
       '{"id":' || event_id || '}' AS as_variant
FROM events
""")
def warehouse_semi_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PARSE_JSON, OBJECT_CONSTRUCT and TO_VARIANT as Spark names them."""
    return _run(spark, sf_dir, """
        SELECT event_id, try_variant_get(parse_json(props), '$.k', 'bigint') AS k,
               to_json(named_struct('id', event_id, 'type', event_type)) AS built,
               to_json(to_variant_object(named_struct('id', event_id))) AS as_variant
        FROM events
        """, "events")


@query("SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS nations FROM nation GROUP BY n_regionkey")
def warehouse_listagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, """
        SELECT n_regionkey, listagg(n_name, ', ') WITHIN GROUP (ORDER BY n_name) AS nations
        FROM nation GROUP BY n_regionkey
        """, "nation")


@query("""
SELECT vec_id, (unnest(generate_series(1, len(embedding))) - 1)::INTEGER AS place, unnest(embedding)::DOUBLE AS x
FROM embeddings
""")
def warehouse_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLATTEN as ``posexplode``."""
    return _run(spark, sf_dir, """
        SELECT vec_id, place, CAST(x AS DOUBLE) AS x FROM embeddings LATERAL VIEW posexplode(embedding) AS place, x
        """, "embeddings")
