"""Session settings the library relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    # timestamps without a zone are read as UTC, so day bounds never move
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # re-running one report period replaces that period only
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def apply_settings(spark: SparkSession) -> None:
    """Put the settings on a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def local_session(cores: int | str | None = None, app: str = "opsgauge") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # no call-site capture: it doubles the time to build a plan of many expressions
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
