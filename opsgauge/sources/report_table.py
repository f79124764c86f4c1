"""The report table: one row per run, measure and period, stored by run and period.

A run adds its rows and changes none, so the report can be read as it stood after any run: what a later
run of the same period has replaced is still there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

REPORT_SCHEMA = (
    "row int, kpi_id string, area string, region string, value double, unit string, note string, "
    "run int, period string"
)


def _stored(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    reader = spark.read.schema(REPORT_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def last_run(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """The number of the newest run, 0 before the first one. Read from the names of the folders."""
    if not _exists(spark, path):
        return 0
    return _stored(spark, path, fmt).agg(F.max("run")).first()[0] or 0


def write_report(kpis: DataFrame, path: str, fmt: str = "parquet", run: int | None = None) -> int:
    """Add a run and return its number: the next one unless given. A run that fails adds nothing, as
    files appear only when all are written. The report has one row per measure and period, so each
    period is one small file."""
    spark = kpis.sparkSession
    before = last_run(spark, path, fmt)
    run = before + 1 if run is None else run
    if run <= before:
        raise ValueError(f"run {run} is there, or a later one: {before} is the newest")
    if "note" not in kpis.columns:
        kpis = kpis.withColumn("note", F.lit(None).cast("string"))
    names = [f.split()[0] for f in REPORT_SCHEMA.split(", ")]
    writer = kpis.withColumn("run", F.lit(run)).select(*names).coalesce(1).write.mode("append")
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.partitionBy("run", "period").format(fmt).save(path)
    return run


def newest(rows: DataFrame, until_run: int | None = None) -> DataFrame:
    """Of each period the rows of its newest run, or of the newest one up to ``until_run``."""
    if until_run is not None:
        rows = rows.filter(F.col("run") <= until_run)
    # one number a period, then an equi-join; the runs of a period never meet in one task
    last = rows.groupBy("period").agg(F.max("run").alias("run"))
    return rows.join(last, ["period", "run"], "left_semi").select(*rows.columns)


def read_report(spark: SparkSession, path: str, fmt: str = "parquet", until_run: int | None = None) -> DataFrame:
    """The report as it stands, or as it stood after a run: a bad run is undone by reading up to the
    one before it, and for good by another run of its periods."""
    return newest(_stored(spark, path, fmt), until_run)
