"""Build the whole report and store it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from opsgauge.operators.periods import Period
from opsgauge.plans.report import Deployment, report, report_parts
from opsgauge.session import apply_settings
from opsgauge.sources.report_table import read_report, write_report
from opsgauge.sources.tables import Source


LOSSES = "run int, input string, column string, lost long"


def run_report(
    spark: SparkSession,
    source: Source,
    periods: Sequence[Period],
    deployment: Deployment,
    as_of: str,
    path: str,
    fmt: str = "parquet",
    count_losses: bool = False,
) -> DataFrame:
    """Compute every measure for every period, store the rows as a new run, and return the report.

    Periods stored before and not computed now stay as they are; earlier runs can still be read.
    With `count_losses`, times that cannot be read and count as missing are counted in the same scans
    and stored beside the report, in `path` with "_losses" (run, input, column, lost); inputs with such
    times are then read whole.
    """
    apply_settings(spark)
    losses: dict[str, Observation] | None = {} if count_losses else None
    run = write_report(report(report_parts(source, periods, deployment, as_of, losses)), path, fmt)
    if losses:
        rows = [(run, name, column, lost) for name, seen in losses.items() for column, lost in seen.get.items()]
        lost = spark.createDataFrame(rows, LOSSES).coalesce(1)
        lost.write.mode("append").option("header", "true").format(fmt).save(f"{path}_losses")
    return read_report(spark, path, fmt)
