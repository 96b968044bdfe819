"""Write one result to several targets."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from tablemill.operators.staging import Stages

Result = TypeVar("Result")


def write_targets(df: DataFrame, sinks: Mapping[str, Callable[[DataFrame], Result]]) -> dict[str, Result]:
    """Compute a frame once and hand it to every sink in parallel.

    The frame is stored first and all sinks read that copy, so they receive the same rows
    even if executors are lost or the source changes in between.  The copy is dropped
    once every sink has ended; the first failure is raised then.
    """
    spark = df.sparkSession
    with Stages(spark) as stages:
        shared = stages.put(df, "shared")
        with ThreadPoolExecutor(max_workers=max(1, len(sinks))) as pool:
            running = {
                name: pool.submit(inheritable_thread_target(spark)(sink), shared) for name, sink in sinks.items()
            }
        return {name: job.result() for name, job in running.items()}
