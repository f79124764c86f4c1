"""The subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a function of (session, read), where ``read(name)`` gives a table, and SQL that must
    give the same rows."""

    def add(fn: Callable):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add
