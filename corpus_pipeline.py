"""A training corpus from raw documents: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs; all but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strikelake.llm import bagminhash, decontaminate, mixing, quality, secrets
from strikelake.llm.shipping import shipped
from strikelake.sources.storage import as_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts, fitted on the labelled documents of the stage's input."""
    return quality.accepted(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return bagminhash.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secrets.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", shipped(quality_classifier)),
    ("MinHash near-dedup", shipped(near_duplicates)),
    ("benchmark decontamination", shipped(benchmark_decontamination)),
    ("secret scans", shipped(secret_scan)),
    ("mixing sources to target weights", shipped(source_mix)),
]

#: A trained classifier and MinHash are not SQL; tests/llm compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = as_table(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
