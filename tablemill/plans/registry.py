"""Queries by name, each with the SQL that gives the same rows where there is such SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under a name, its own unless given."""
    def register(function: Query) -> Query:
        known_as = name or function.__name__
        if known_as in QUERIES:
            raise ValueError(f"query {known_as} is registered twice")
        QUERIES[known_as] = function
        if oracle is not None:
            ORACLES[known_as] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
