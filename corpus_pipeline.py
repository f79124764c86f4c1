"""The document pipeline: stages over the documents table, each one of the operators in opsgauge.llm.

Every stage works on all documents that the one before has kept. All but the last return the columns
of documents; the last adds the token ids and the text decoded from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgauge.llm import bpe, jaccard, lines, quality, tiling
from opsgauge.llm.workspace import Workspace, fresh

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    scored = quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 1").select(*docs.columns)


def drop_line_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many different documents of their source. Copies
    count as one, so that a text with many copies keeps its lines."""
    out = lines.drop_boilerplate(docs, Workspace(spark, "lines"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the document with the smallest doc_id. Rows without doc_id stay; of equal rows
    with a kept doc_id, one stays, and so does each of its different texts."""
    found = jaccard.components(spark, docs)
    own = fresh(docs.columns, "kept_id")
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(own)).distinct()
    kept = Workspace(spark, "kept").table(kept, "ids")
    once = docs.join(kept, docs["doc_id"] == kept[own], "left_semi").dropDuplicates(["doc_id", "text"])
    return once.select(*docs.columns).union(docs.where("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage. Rows are judged one by one: by a hash of doc_id and text,
    as doc_ids may be missing or repeated."""
    own = fresh(docs.columns, "row_key")
    rows = docs.withColumn(own, F.xxhash64("doc_id", "text"))
    keyed = rows.select(F.col(own).alias("doc_id"), "text")
    found = tiling.contaminated_ids(spark, keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.join(found, rows[own] == found["id"], "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids and the text decoded from these."""
    return bpe.encode_column(docs, VOCABULARY)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_line_boilerplate),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]

#: None: SQL cannot express the stages; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read back."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return docs
