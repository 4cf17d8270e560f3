"""The corpus pipeline: five stages from raw documents to a training order.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and
read again as the next one's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import decontaminate, lines, mixing, quality, simhash
from tallyworks.llm.store import save


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for good."""
    return quality.filter_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of repeated runs of lines; ``n_chars`` follows the text."""
    kept = lines.deduplicate_lines(docs, counts=False)
    changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return kept.withColumn("n_chars", changed) if "n_chars" in docs.columns else kept


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose fingerprints of three-word shingles link at two bits."""
    return simhash.deduplicate(docs, width=3, radius=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken into the mix and at which places its copies stand, in training order."""
    return mixing.in_order(mixing.plan(docs, mixing.cycling_schedule))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_sources", mixing_sources),
]

#: The classifier is fitted, not declared: SQL can't express the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on everything its predecessor kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
