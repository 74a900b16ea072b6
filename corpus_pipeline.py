"""From raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as Parquet
under the shared checkpoint folder and rereads it as the next stage's ``docs``.  All but the last
return the columns of ``documents``.  Rows with NULL values pass through every stage by its
operator's rules; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import bpe, decontaminate, minmax, quality, secrets
from starmill.llm.common import importable, stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    return quality.select(docs, quality.graded(table(spark, sf_dir, "labels")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five words, similarity 0.8."""
    return minmax.deduplicate(docs, shingle=5, num=80, den=100)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; documents stay."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding gives its text back."""
    done = bpe.round_trip(docs.select("doc_id", "text"))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("restored"))


STAGES = [
    ("quality_classifier", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("secret_scan", mask_secrets),
    ("bpe_tokens", tokens),
]
# Fitted weights, hashing and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
