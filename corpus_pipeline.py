"""Corpus pipeline: quality rules, near-duplicate removal, secret redaction, source mixing, packing."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from scorelake.llm import mixing, near_duplicates, packing, repetition, secrets
from scorelake.llm.common import delete, exists, shared_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word, line and repetition rules."""
    return repetition.keep_sound(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 of five-word shingles."""
    return near_duplicates.deduplicate(docs, percent=80, width=5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with live-looking secrets replaced; copied examples stay."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as a mix of sources by weights 5, 2, 1 takes them."""
    return mixing.repeat(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("source_mix", source_mix), ("packing", packed)]

#: The method's components, redaction and token ids have no SQL form; a brute-force version tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, run_id: str | None = None) -> DataFrame:
    """Apply all stages to the documents; each result is written to the shared folder and read again by the next.

    A run that is started again with its run_id goes on behind the last stage that
    is complete. A stage's folder is deleted once the next one is complete, so that
    only the result stays.
    """
    folder = os.path.join(shared_folder(spark), f"pipeline-{run_id or uuid.uuid4().hex}")
    paths = [os.path.join(folder, name) for name, _ in STAGES]
    done = next((k + 1 for k in reversed(range(len(paths))) if exists(spark, os.path.join(paths[k], "_SUCCESS"))), 0)
    docs = spark.read.parquet(paths[done - 1]) if done else table(spark, sf_dir, "documents")
    for k in range(done, len(paths)):
        STAGES[k][1](spark, docs, sf_dir).write.mode("overwrite").parquet(paths[k])
        docs = spark.read.parquet(paths[k])
        if k:
            delete(spark, paths[k - 1])
    return docs
