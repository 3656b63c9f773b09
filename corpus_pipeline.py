"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, packing.

Defined results: null, empty and short texts are rejected by the first stage, so
no later one sees them; rows without ``doc_id`` are no near-duplicates of others;
rows that share a ``doc_id`` are judged one by one, and leave together as
near-duplicates or leaks; an empty table gives no pieces; other columns, whatever
their names, travel along to the last stage.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from seqprep.llm import decontaminate, line_rules, near_dedup, packing, secret_scan  # noqa: E402
from seqprep.session import tune, write_shared  # noqa: E402


#: Documents that travel to a Python worker at a time, so that whole texts of a batch stay a few megabytes.
ROWS_PER_BATCH = 1024


def settled(spark: SparkSession) -> SparkSession:
    """The session with the recommended settings and small Arrow batches."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    settled(spark)
    return line_rules.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    settled(spark)
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    settled(spark)
    return decontaminate.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    settled(spark)
    return secret_scan.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    settled(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secrets),
    ("packing", pack),
]

#: SQL can't express the sketches, windows and packing; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
