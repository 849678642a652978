"""The training-text pipeline: documents in, token digests out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import bpe, decontaminate, jaccard_join, quality_rules, secret_scan
from tidepool.llm.queries import VOCABULARY
from tidepool.session import stage_table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list rejects go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    return jaccard_join.keep_one(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; all documents stay."""
    clean = secret_scan.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each remaining document."""
    return bpe.round_trip(docs, VOCABULARY)


STAGES = [
    ("quality rules", rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", leaks),
    ("secret scans", secrets),
    ("byte-level BPE", tokens),
]

#: Learned rules, randomised joins and token merges have no SQL form; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
