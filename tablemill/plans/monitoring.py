"""Queries over a run-event table, which is derived from the events table.

Each user is taken for a run, each event for a log entry whose text follows from its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablemill.functions.durations import duration_seconds
from tablemill.operators.runlog import (
    classify_runs,
    last_built,
    latest_per_table,
    min_rows_check,
    newer_than,
    retry_plan,
    stale_downstream,
    stale_tables,
)
from tablemill.operators.staging import scratch_database, temp_name
from tablemill.operators.tables import ShortLoad, load_at_least
from tablemill.operators.transform import sql_transform
from tablemill.plans.registry import query, table

_MESSAGES = """
CASE event_id % 29 WHEN 0 THEN 'Container OOM killed' WHEN 1 THEN 'worker was Evicted: out of memory'
  WHEN 2 THEN 'Pod was deleted' WHEN 3 THEN 'node failure on host' WHEN 4 THEN 'Cannot allocate memory'
  WHEN 5 THEN 'preempted' ELSE 'step finished' END
"""
_RUN_EVENTS = f"""
SELECT user_id AS run_id, event_id AS seq, ts, event_type AS table_name,
       CASE WHEN event_id % 3 = 0 THEN 'materialized' ELSE 'log' END AS status,
       {_MESSAGES} AS message, user_id % 6 AS attempt
FROM """

_CLASSES = f"""
WITH run_events AS ({_RUN_EVENTS} events),
found AS (
  SELECT run_id, seq, attempt, CASE
    WHEN regexp_matches(lower(message), 'out of memory|oom killed|memory limit exceeded|cannot allocate memory|killed by oom')
      THEN 'oom'
    WHEN regexp_matches(lower(message), 'pod was deleted|terminated|evicted|node failure|preempted') THEN 'pod_deleted'
  END AS found
  FROM run_events
),
classes AS (
  SELECT run_id, coalesce(arg_min(found, seq) FILTER (WHERE found IS NOT NULL), 'other') AS failure_class,
         max(attempt) AS attempt
  FROM found GROUP BY run_id
)
"""


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_transform(_RUN_EVENTS + " input_df", table(spark, sf_dir, "events"))


@query(_CLASSES + "SELECT run_id, failure_class FROM classes", name="classify_runs")
def classify_failed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_runs(run_events(spark, sf_dir))


@query(_CLASSES + """
SELECT run_id, failure_class, attempt, attempt < 4 AS retry,
       CASE WHEN attempt < 4 THEN attempt + 1 END AS next_attempt,
       CASE WHEN attempt < 4 THEN least(90 * pow(3.0, attempt), 1800)::DOUBLE END AS delay_seconds,
       CASE WHEN attempt < 4 THEN CASE WHEN failure_class = 'oom' THEN 2.0 ELSE 1.0 END::DOUBLE END AS memory_factor
FROM classes
""", name="retry_plan")
def plan_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = classify_runs(run_events(spark, sf_dir), attempt=F.max("attempt"))
    return retry_plan(runs, max_attempts=4, base_delay="1.5m", factor=3.0, max_delay="30 m")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity * CASE l_linenumber % 5 WHEN 0 THEN 1 WHEN 1 THEN 60 WHEN 2 THEN 3600
  WHEN 3 THEN 86400 ELSE 604800 END AS seconds
FROM lineitem
""")
def duration_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.element_at(F.array(*map(F.lit, ("", "m", "H", " d", "w"))), F.col("l_linenumber") % 5 + 1)
    text = F.concat(F.col("l_quantity").cast("string"), unit)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", duration_seconds(text).alias("seconds"))


_LATEST = f"""
WITH run_events AS ({_RUN_EVENTS} events),
latest AS (
  SELECT table_name, max(ts) AS ts, arg_max(run_id, {{'ts': ts, 'run_id': run_id}}) AS run_id
  FROM run_events WHERE status = 'materialized' GROUP BY table_name
)
"""


@query(_LATEST + "SELECT * FROM latest", name="latest_per_table")
def latest_build_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_table(run_events(spark, sf_dir), "materialized")


@query(_LATEST + "SELECT * FROM latest WHERE ts > (SELECT min(ts) FROM latest)")
def builds_newer_than(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_per_table(run_events(spark, sf_dir), "materialized")
    return newer_than(latest, latest.agg(F.min("ts")).scalar())


@query("""
WITH latest AS (SELECT 'table_' || user_id AS table_name, max(ts) AS ts FROM events GROUP BY user_id),
edges AS (
  SELECT DISTINCT 'table_' || user_id AS table_name, 'table_' || (user_id // 2) AS depends_on FROM events
  UNION ALL SELECT DISTINCT 'report_' || event_type, 'table_' || user_id FROM events
),
newest AS (
  SELECT edges.table_name, max(latest.ts) AS newest_upstream_ts
  FROM edges LEFT JOIN latest ON edges.depends_on = latest.table_name GROUP BY edges.table_name
)
SELECT table_name, ts, newest_upstream_ts FROM newest LEFT JOIN latest USING (table_name)
WHERE ts IS NULL OR newest_upstream_ts > ts
""", name="stale_tables")
def stale_downstream_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per user that depends on another user's, and never-built reports per event type."""
    events = table(spark, sf_dir, "events").selectExpr(
        "concat('table_', user_id) AS table_name", "concat('table_', user_id div 2) AS upstream",
        "concat('report_', event_type) AS report", "ts",
    )
    per_user = events.select("table_name", F.col("upstream").alias("depends_on")).distinct()
    reports = events.select(F.col("report").alias("table_name"), F.col("table_name").alias("depends_on")).distinct()
    edges = per_user.unionByName(reports)
    return stale_tables(edges, last_built(events))


@query("""
WITH RECURSIVE latest AS (SELECT 'table_' || user_id AS table_name, max(ts) AS ts FROM events GROUP BY user_id),
edges AS (
  SELECT DISTINCT 'table_' || user_id AS table_name, 'table_' || (user_id + 1) AS depends_on FROM events WHERE user_id % 6 <> 5
  UNION ALL SELECT DISTINCT 'table_' || (user_id + 5), 'table_' || user_id FROM events WHERE user_id % 12 = 0
),
stale AS (
  SELECT edges.table_name FROM edges LEFT JOIN latest up ON edges.depends_on = up.table_name
  LEFT JOIN latest own ON edges.table_name = own.table_name
  GROUP BY edges.table_name, own.ts HAVING own.ts IS NULL OR max(up.ts) > own.ts
),
ways(table_name, steps) AS (
  SELECT table_name, 0 FROM stale
  UNION SELECT edges.table_name, steps + 1 FROM ways JOIN edges ON edges.depends_on = ways.table_name WHERE steps < 12
)
SELECT table_name, min(steps)::INT AS steps FROM ways GROUP BY table_name
""")
def stale_tables_transitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of six tables, every other one closed to a cycle: what depends on a stale table is stale as well."""
    events = table(spark, sf_dir, "events")
    chain = events.where("user_id % 6 <> 5").selectExpr("concat('table_', user_id) AS table_name", "concat('table_', user_id + 1) AS depends_on")
    back = events.where("user_id % 12 = 0").selectExpr("concat('table_', user_id + 5) AS table_name", "concat('table_', user_id) AS depends_on")
    edges = chain.distinct().unionByName(back.distinct())
    return stale_downstream(edges, last_built(events.selectExpr("concat('table_', user_id) AS table_name", "ts")))


@query("""
SELECT 'orders' AS dataset, count(*) AS n_rows, count(*) >= 1000 AS passed FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*) >= 1000 FROM lineitem
UNION ALL SELECT 'region', count(*), count(*) >= 1000 FROM region
""", name="min_rows_check")
def min_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return min_rows_check({name: table(spark, sf_dir, name) for name in ("orders", "lineitem", "region")}, 1000)


@query("""
SELECT 'orders' AS dataset, count(*) AS n_rows, TRUE AS passed FROM orders
UNION ALL SELECT 'lineitem', count(*), TRUE FROM lineitem
UNION ALL SELECT 'region', 0, FALSE
""")
def min_rows_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are counted while they are loaded; a load that falls short leaves no table."""
    report = []
    for name in ("orders", "lineitem", "region"):
        target = f"{scratch_database(spark)}.{temp_name('checked')}"
        try:
            load_at_least(table(spark, sf_dir, name), target, 100)
        except ShortLoad:
            report.append((name, 0, spark.catalog.tableExists(target)))
        else:
            report.append((name, spark.table(target).count(), True))
    return spark.createDataFrame(report, "dataset string, n_rows long, passed boolean")
