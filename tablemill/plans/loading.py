"""Queries over sinks: each writes, then returns what the target holds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablemill.operators.csv_export import export_csv
from tablemill.operators.rewrite import delete_rows, update_rows, upsert
from tablemill.operators.staging import scratch_database
from tablemill.operators.tables import insert_select, load_table, run_statement
from tablemill.plans.flows import (
    batches_to_table,
    csv_to_table,
    query_to_table,
    staged_to_table,
    table_and_csv,
    table_to_table,
    union_to_table,
)
from tablemill.plans.registry import query, table
from tablemill.session import drop_path, fresh_path
from tablemill.sources.files import extract_csv
from tablemill.streaming.refresh import REFRESH_COLUMNS, compact, refresh
from tablemill.streaming.totals import RunningTotals, average_of, count_of, largest_of, latest_of, smallest_of, total_of

# A file of long texts is read by one task.
LONG_TEXT_ROWS = 50_000


def _target(spark: SparkSession, label: str) -> str:
    return f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex}"


def _file(sf_dir: str, name: str) -> str:
    return f"parquet.`{sf_dir.rstrip('/')}/{name}.parquet`"


@query("SELECT * FROM orders")
def load_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(table_to_table(table(spark, sf_dir, "orders"), _target(spark, "created")))


@query("""
SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def load_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading again appends again; whole-number columns are stored as BIGINT."""
    customers, target = table(spark, sf_dir, "customer"), _target(spark, "appended")
    load_table(customers, target)
    # the second frame has its columns in another order: they match by name
    load_table(customers.select(*reversed(customers.columns)), target)
    return spark.table(target)


@query("SELECT * FROM orders")
def load_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = table(spark, sf_dir, "orders"), _target(spark, "recreated")
    load_table(orders.select("o_orderkey", "o_orderstatus"), target)
    load_table(orders, target, recreate=True)
    return spark.table(target)


@query("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders")
def load_recreate_from_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame that replaces a table reads that table."""
    target = load_table(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), _target(spark, "own"))
    load_table(spark.table(target).withColumn("o_totalprice", F.col("o_totalprice") * 2), target, recreate=True)
    return spark.table(target)


@query("""
SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT s_suppkey, NULL, NULL, s_acctbal FROM supplier
""")
def load_column_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    target = load_table(suppliers, _target(spark, "subset"))
    load_table(suppliers.select("s_acctbal", "s_suppkey"), target)
    return spark.table(target)


@query("SELECT event_id, date_trunc('millisecond', ts)::TIMESTAMP AS ts, value FROM events")
def load_ms_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return spark.table(load_table(events, _target(spark, "stamped")))


@query("SELECT event_id, CASE WHEN value < 10 THEN NULL ELSE value END AS value FROM events")
def load_nan_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("value") < 10, float("nan")).otherwise(F.col("value")).alias("value")
    )
    return spark.table(load_table(events, _target(spark, "nan")))


@query("""
SELECT vec_id, label::BIGINT AS label, i AS place, embedding[i]::DOUBLE AS item
FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i)
""")
def load_nested_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays are stored as arrays."""
    stored = spark.table(load_table(table(spark, sf_dir, "embeddings"), _target(spark, "nested")))
    items = stored.select("vec_id", "label", F.posexplode("embedding").alias("place", "item"))
    return items.select("vec_id", "label", (F.col("place") + 1).cast("bigint").alias("place"), F.col("item").cast("double").alias("item"))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def insert_select_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = f"SELECT o_orderkey, o_orderstatus FROM {_file(sf_dir, 'orders')}"
    return spark.table(query_to_table(spark, sql, _target(spark, "ctas")))


@query("""
SELECT o_orderkey AS id, o_orderdate AS ts FROM orders UNION ALL SELECT o_custkey AS id, o_orderdate AS ts FROM orders
""")
def insert_select_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second query's columns go by position."""
    target = _target(spark, "inserted")
    query_to_table(spark, f"SELECT o_orderkey AS id, o_orderdate AS ts FROM {_file(sf_dir, 'orders')}", target)
    query_to_table(spark, f"SELECT o_custkey, o_orderdate FROM {_file(sf_dir, 'orders')}", target)
    return spark.table(target)


@query("SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def insert_select_from_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = insert_select(spark, f"SELECT * FROM {_file(sf_dir, 'supplier')}", _target(spark, "doubled"))
    insert_select(spark, f"SELECT * FROM {target}", target)
    return spark.table(target)


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_name <> 'none'")
def statement_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements without a target: create, truncate, insert, select."""
    target = _target(spark, "direct")
    run_statement(spark, f"CREATE TABLE {target} (s_suppkey BIGINT, s_name STRING) USING parquet")
    run_statement(spark, f"INSERT INTO {target} VALUES (-1, 'none')")
    run_statement(spark, f"TRUNCATE TABLE {target}")
    run_statement(spark, f"INSERT INTO {target} SELECT s_suppkey, s_name FROM {_file(sf_dir, 'supplier')}")
    return run_statement(spark, f"SELECT * FROM {target} WHERE s_name <> :none", {"none": "none"})


@query("SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts with quotes, commas and line breaks."""
    documents = table(spark, sf_dir, "documents")
    path = export_csv(documents, fresh_path(spark, "documents-csv"), rows_per_file=LONG_TEXT_ROWS)
    return extract_csv(spark, path, documents.schema)


@query("SELECT page_id, nullif(url, '') AS url, nullif(html, '') AS html FROM pages")
def csv_round_trip_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = export_csv(pages, fresh_path(spark, "pages-csv"), rows_per_file=LONG_TEXT_ROWS)
    return extract_csv(spark, path, pages.schema)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def csv_round_trip_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps with microseconds, doubles and JSON text keep their values."""
    events = table(spark, sf_dir, "events")
    return extract_csv(spark, export_csv(events, fresh_path(spark, "events-csv")), events.schema)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       o_orderpriority
FROM orders
""")
def csv_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a schema numbers are found and timestamps stay text."""
    path = export_csv(table(spark, sf_dir, "orders"), fresh_path(spark, "orders-csv"))
    return extract_csv(spark, path)


@query("SELECT * FROM orders")
def csv_to_table_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = table(spark, sf_dir, "orders"), _target(spark, "from_csv")
    path = export_csv(orders, fresh_path(spark, "orders-csv"))
    csv_to_table(spark, path, orders.schema, target)
    csv_to_table(spark, path, orders.schema, target)
    return spark.table(target)


@query("""
SELECT 'table' AS target, p_partkey, p_name, p_retailprice FROM part
UNION ALL SELECT 'csv' AS target, p_partkey, p_name, p_retailprice FROM part
""")
def multi_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    written = table_and_csv(parts, _target(spark, "both"), fresh_path(spark, "both-csv"))
    from_csv = extract_csv(spark, written["csv"], parts.schema)
    from_table = spark.table(written["table"])
    return from_table.select(F.lit("table").alias("target"), "*").unionByName(
        from_csv.select(F.lit("csv").alias("target"), "*")
    )


@query("SELECT * FROM orders")
def batched_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, "batched")
    return spark.table(batches_to_table(table(spark, sf_dir, "orders"), "o_orderkey", 50, target))


@query("""
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer
""")
def fan_in_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [
        table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance"),
        table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance"),
    ]
    return spark.table(union_to_table(frames, _target(spark, "united")))


@query("""
SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS spent
FROM orders GROUP BY o_custkey
""")
def staged_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = staged_to_table(
        spark,
        table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice"),
        "temp_test",
        "SELECT o_custkey, count(*) AS n_orders, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM temp_test GROUP BY o_custkey",
        _target(spark, "staged"),
    )
    return spark.table(target)


@query("""
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM orders
""")
def update_by_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = load_table(rows, _target(spark, "updated"))
    update_rows(spark, target, F.col("o_orderstatus") == "F", {"o_totalprice": F.col("o_totalprice") * 2})
    return spark.table(target)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE (o_orderstatus = 'F') IS NOT TRUE")
def delete_by_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = load_table(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), _target(spark, "deleted"))
    delete_rows(spark, target, F.col("o_orderstatus") == "F")
    return spark.table(target)


@query("""
SELECT c_custkey AS id, c_acctbal AS balance FROM customer WHERE c_custkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT p_partkey AS id, p_retailprice AS balance FROM part
""")
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = load_table(
        table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_acctbal AS balance"), _target(spark, "upserted")
    )
    upsert(target, table(spark, sf_dir, "part").selectExpr("p_retailprice AS balance", "p_partkey AS id"), ["id"])
    return spark.table(target)


def _events_in_files(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """The events table as several files, as if they had arrived one after the other."""
    events, path = table(spark, sf_dir, "events"), fresh_path(spark, "arrivals")
    events.repartition(4, "event_id").write.parquet(path)
    return path, events.schema


@query("SELECT event_id, user_id, event_type, value FROM events")
def incremental_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive, the target is refreshed, more files arrive, it is refreshed again."""
    path, target, checkpoint = fresh_path(spark, "arrivals"), _target(spark, "fresh"), fresh_path(spark, "progress")
    events = table(spark, sf_dir, "events")
    middle = pk_middle(events, "event_id")
    for part in (events.where(F.col("event_id") < middle), events.where(F.col("event_id") >= middle)):
        part.write.mode("append").parquet(path)
        refresh(
            spark, path, events.schema, target, checkpoint,
            transform=lambda rows: rows.select("event_id", "user_id", "event_type", "value"),
        )
    return spark.table(target).drop(*REFRESH_COLUMNS)


def pk_middle(df: DataFrame, pk: str) -> int:
    lo, hi = df.agg(F.min(pk), F.max(pk)).first()
    return (lo + hi) // 2


@query("""
SELECT event_type, count(*) AS n_events, sum(value::DECIMAL(18,6))::DOUBLE AS total FROM events GROUP BY event_type
""")
def refresh_sql_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL runs on each arriving batch; the partial results add up to the whole."""
    path, schema = _events_in_files(spark, sf_dir)
    target = refresh(
        spark, path, schema, _target(spark, "partial"), fresh_path(spark, "progress"),
        sql="SELECT event_type, count(*) AS n_events, "
            "sum(CAST(value AS DECIMAL(18,6))) AS total FROM input_df GROUP BY event_type",
        files_per_batch=1,
    )
    return spark.table(target).groupBy("event_type").agg(
        F.sum("n_events").alias("n_events"), F.sum("total").cast("double").alias("total")
    )


@query("""
SELECT user_id, event_type, count(*) AS n_events, sum(value::DECIMAL(18,6)) AS total, min(ts) AS first_ts, max(ts) AS last_ts,
       max({'ts': ts, 'value': value}).value AS last_value,
       round((sum(value::DECIMAL(18,6)) / count(value))::DOUBLE, 6) AS mean_value
FROM events GROUP BY user_id, event_type
""")
def refresh_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per key over files that arrive, with a batch that runs again, states folded, and more files after that."""
    path, progress, events = fresh_path(spark, "arrivals"), fresh_path(spark, "progress"), table(spark, sf_dir, "events")
    amount = F.col("value").cast("decimal(18,6)")
    running = RunningTotals(_target(spark, "totals"), ["user_id", "event_type"], {
        "n_events": count_of(), "total": total_of(amount), "first_ts": smallest_of(F.col("ts")), "last_ts": largest_of(F.col("ts")),
        "last_value": latest_of(F.col("value"), F.col("ts")), "mean_value": average_of(amount),
    })
    for third in range(3):
        events.where(F.col("event_id") % 3 == third).coalesce(2).write.mode("append").parquet(path)
        running.refresh(spark, path, events.schema, progress, files_per_batch=1)
        if third == 1:
            # as if the driver had been lost before the last batch was noted as done
            last = spark.table(running.target).where("refresh_batch >= 0").agg(F.max("refresh_batch")).first()[0]
            drop_path(spark, f"{progress}/commits/{last}")
            running.refresh(spark, path, events.schema, progress, files_per_batch=1)
            running.fold(spark)
    return running.totals(spark).withColumn("mean_value", F.round(F.col("mean_value").cast("double"), 6))


@query("SELECT event_id AS id, value FROM events UNION ALL SELECT o_orderkey AS id, o_totalprice AS value FROM orders")
def refresh_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources, each with its own progress, feed one table, which is compacted and refreshed again."""
    target = _target(spark, "two_sources")
    sources = {
        "events": table(spark, sf_dir, "events").selectExpr("event_id AS id", "value"),
        "orders": table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_totalprice AS value"),
    }
    folders = {name: (fresh_path(spark, name), fresh_path(spark, "progress")) for name in sources}
    for half in (0, 1):
        for name, rows in sources.items():
            path, progress = folders[name]
            rows.where(F.col("id") % 2 == half).write.mode("append").parquet(path)
            refresh(spark, path, rows.schema, target, progress)
        compact(spark, target)
    return spark.table(target).drop(*REFRESH_COLUMNS)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 1000")
def refresh_chain_table_csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table, its CSV export, and a table that is refreshed from the CSV."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    first = load_table(orders, _target(spark, "upstream"))
    folder = export_csv(spark.table(first), fresh_path(spark, "chain-csv"))
    target = refresh(
        spark, folder, orders.schema, _target(spark, "downstream"), fresh_path(spark, "progress"),
        sql="SELECT * FROM input_df WHERE o_totalprice > 1000", source_format="csv", header="true",
    )
    return spark.table(target).drop(*REFRESH_COLUMNS)


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderstatus
FROM orders WHERE NOT (o_orderstatus = 'P')
""")
def update_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the partitions with changed rows are written, and one that loses all its rows goes."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    target = load_table(orders, _target(spark, "by_status"), partition_by=["o_orderstatus"])
    update_rows(spark, target, F.col("o_orderstatus") == "F", {"o_totalprice": F.col("o_totalprice") * 2})
    delete_rows(spark, target, F.col("o_orderstatus") == "P")
    return spark.table(target)


@query("""
SELECT c_custkey AS id, c_name AS name, coalesce(p_retailprice, c_acctbal) AS balance
FROM customer LEFT JOIN part ON c_custkey = p_partkey
UNION ALL
SELECT p_partkey AS id, NULL AS name, p_retailprice AS balance FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)
""")
def upsert_chosen_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched rows change in one column and keep the others."""
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    target = load_table(customers, _target(spark, "chosen"))
    upsert(target, table(spark, sf_dir, "part").selectExpr("p_retailprice AS balance", "p_partkey AS id"), ["id"], update=["balance"])
    return spark.table(target)
