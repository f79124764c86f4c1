"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing a Parquet table and reading it back, so a lost executor costs at most
the stage it was in. The folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; where the session names none (tests), a new temporary one is set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="opsgauge-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Rows that a Python worker gets at once, at most. Texts are long: ten thousand of them, Spark's usual
#: number, take several times as much memory as the work on them.
BATCH_ROWS = 2000
BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package where they may not have it. Spark hands the file out. Also
    bounds the batches that they get."""
    if not 0 < int(spark.conf.get(BATCHES)) <= BATCH_ROWS:
        spark.conf.set(BATCHES, BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "_opsgauge_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="opsgauge-code-")
    shutil.copytree(package, f"{folder}/lib/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/{os.path.basename(folder)}", "zip", f"{folder}/lib"))
    context._opsgauge_shipped = True


class Workspace:
    """A new folder for one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write the rows and read them back."""
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's address, and the path in it; plain paths are local ones."""
    if "://" not in path:
        path = "file://" + os.path.abspath(path)
    return pafs.FileSystem.from_uri(path)


def fresh(columns: list[str], name: str) -> str:
    """A name that none of the columns has; Spark compares names without case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
