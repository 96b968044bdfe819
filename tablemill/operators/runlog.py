"""Jobs over run-event tables: ``(run_id, seq, ts, table_name, status, message, attempt)``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tablemill.functions.durations import duration_seconds
from tablemill.operators.skew import look_up
from tablemill.operators.staging import store

# Texts that tell why a run failed, first the memory texts, then the pod texts.
MEMORY_TEXTS = (
    "out of memory",
    "oom killed",
    "memory limit exceeded",
    "cannot allocate memory",
    "killed by oom",
)
POD_TEXTS = (
    "pod was deleted",
    "terminated",
    "evicted",
    "node failure",
    "preempted",
)


def _mentions(message: Column, texts: tuple[str, ...]) -> Column:
    # none of the texts holds a character that is special in a pattern
    return F.lower(message).rlike("|".join(texts))


def failure_class(message: Column) -> Column:
    """``oom`` or ``pod_deleted`` for a message that says so, else NULL."""
    return F.when(_mentions(message, MEMORY_TEXTS), "oom").when(_mentions(message, POD_TEXTS), "pod_deleted")


def classify_runs(events: DataFrame, **also: Column) -> DataFrame:
    """``(run_id, failure_class)``: the first telling event of a run decides, else ``other``.

    ``also`` adds aggregates of the run's events, such as ``attempt=F.max("attempt")``, in
    the same pass.  Of the messages only two smallest sequence numbers are kept per run, in
    a hash aggregate that combines before the shuffle, so a run with very many events costs
    no more.
    """
    found = events.withColumn("found", failure_class(F.col("message")))
    firsts = found.groupBy("run_id").agg(
        F.min(F.when(F.col("found") == "oom", F.col("seq"))).alias("oom"),
        F.min(F.when(F.col("found") == "pod_deleted", F.col("seq"))).alias("pod_deleted"),
        *[value.alias(name) for name, value in also.items()],
    )
    memory, pod = F.col("oom"), F.col("pod_deleted")
    return firsts.select(
        "run_id",
        F.when(memory.isNotNull() & (pod.isNull() | (memory <= pod)), "oom")
        .when(pod.isNotNull(), "pod_deleted")
        .otherwise("other")
        .alias("failure_class"),
        *also,
    )


def retry_plan(
    runs: DataFrame,
    *,
    max_attempts: int = 3,
    base_delay: str | float = 60,
    factor: float = 2.0,
    max_delay: str | float = 3600,
    scale_memory: bool = True,
    memory_factor: float = 2.0,
) -> DataFrame:
    """What to do about failed runs ``(run_id, failure_class, attempt)``.

    Adds ``retry``, ``next_attempt``, ``delay_seconds`` and ``memory_factor``.  A run at or
    past ``max_attempts`` is not retried and has NULL there; a missing attempt counts as 0.  Delays may be text such as
    ``1h``.
    """
    attempt = F.coalesce("attempt", F.lit(0))
    again = attempt < max_attempts
    delay = F.least(
        duration_seconds(F.lit(base_delay)) * F.pow(F.lit(float(factor)), attempt), duration_seconds(F.lit(max_delay))
    )
    more_memory = F.lit(scale_memory) & (F.col("failure_class") == "oom")
    return runs.select(
        "*",
        again.alias("retry"),
        F.when(again, attempt + 1).alias("next_attempt"),
        F.when(again, delay).alias("delay_seconds"),
        F.when(again, F.when(more_memory, float(memory_factor)).otherwise(1.0)).alias("memory_factor"),
    )


def latest_per_table(events: DataFrame, status: str | None = None) -> DataFrame:
    """``(table_name, ts, run_id)`` of the latest event per table, optionally of one status."""
    chosen = events if status is None else events.where(F.col("status") == status)
    latest = F.max(F.struct("ts", "run_id"))
    return chosen.groupBy("table_name").agg(latest.alias("latest")).select("table_name", "latest.ts", "latest.run_id")


def last_built(events: DataFrame, status: str | None = None) -> DataFrame:
    """``(table_name, ts)`` of the latest event per table; a hash aggregate, unlike the above."""
    chosen = events if status is None else events.where(F.col("status") == status)
    return chosen.groupBy("table_name").agg(F.max("ts").alias("ts"))


def newer_than(latest: DataFrame, moment: Column) -> DataFrame:
    """The tables built after a moment."""
    return latest.where(F.col("ts") > moment)


def stale_tables(edges: DataFrame, latest: DataFrame) -> DataFrame:
    """``(table_name, ts, newest_upstream_ts)`` of tables to rebuild.

    ``edges`` is ``(table_name, depends_on)``, where ``depends_on`` names one upstream table
    or holds an array of them.  A table is stale if an upstream is newer, or if it was
    never built.  An upstream on which any share of the tables depends does not gather
    in one task, and edges are reduced to one row per table before the second join.
    """
    if edges.schema["depends_on"].dataType.typeName() == "array":
        edges = edges.select("table_name", F.explode_outer("depends_on").alias("depends_on"))
    built = latest.select("table_name", "ts")
    upstream = built.select(F.col("table_name").alias("depends_on"), F.col("ts").alias("upstream_ts"))
    newest = (
        look_up(edges, upstream, ["depends_on"])
        .groupBy("table_name")
        .agg(F.max("upstream_ts").alias("newest_upstream_ts"))
    )
    return (
        newest.join(built, "table_name", "left")
        .where(F.col("ts").isNull() | (F.col("newest_upstream_ts") > F.col("ts")))
        .select("table_name", "ts", "newest_upstream_ts")
    )


def stale_downstream(edges: DataFrame, latest: DataFrame) -> DataFrame:
    """``(table_name, steps)`` of all tables to rebuild: those of :func:`stale_tables`, which are 0 steps away, and
    whatever depends on them, over any number of steps.

    ``steps`` is the length of the shortest way from a stale table.  Each round looks at the tables found in the last one
    alone and adds what depends on them and was not found before, so cycles end and there are as many rounds as
    the longest such way has steps.  Rounds are stored, so none is computed twice.  A table that never occurs as
    ``table_name`` in ``edges`` has no upstream and is not stale.
    """
    if edges.schema["depends_on"].dataType.typeName() == "array":
        edges = edges.select("table_name", F.explode_outer("depends_on").alias("depends_on"))
    spark = edges.sparkSession
    arcs = spark.table(store(edges.select("table_name", "depends_on").dropna().distinct(), "arcs"))
    found = stale_tables(edges, latest).select("table_name", F.lit(0).alias("steps"))
    table, steps = store(found, "stale"), 0
    frontier = spark.table(table)
    while not frontier.isEmpty():
        steps += 1
        reached = look_up(arcs, frontier.select(F.col("table_name").alias("depends_on"), F.lit(True).alias("_stale")), ["depends_on"])
        following = reached.where("_stale").select("table_name").distinct()
        new = following.join(spark.table(table), "table_name", "left_anti").select("table_name", F.lit(steps).alias("steps"))
        frontier = spark.table(store(new, "stale_step"))
        frontier.write.format("parquet").mode("append").saveAsTable(table)
    return spark.table(table)


def min_rows_check(datasets: Mapping[str, DataFrame], at_least: int) -> DataFrame:
    """``(dataset, n_rows, passed)``, one row per dataset."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", (F.col("n_rows") >= at_least).alias("passed")
        )
        for name, df in datasets.items()
    ]
    checks = counted[0]
    for one in counted[1:]:
        checks = checks.unionByName(one)
    return checks


def require_min_rows(datasets: Mapping[str, DataFrame], at_least: int) -> None:
    """Fail if a dataset has fewer rows than it should."""
    short = min_rows_check(datasets, at_least).where("NOT passed").collect()
    if short:
        raise ValueError("; ".join(f"{row['dataset']} has {row['n_rows']} rows, needs {at_least}" for row in short))
