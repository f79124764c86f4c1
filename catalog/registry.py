"""Where queries and their SQL are registered under one key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.standins import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None):
    """Register a function from the inputs to a DataFrame, and the SQL that must give the same."""

    def add(fn: Callable[[Inputs], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add
