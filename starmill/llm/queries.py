"""Registered queries of this subpackage; each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmill.llm import alignment, bpe, decontaminate, divergence, extract, minmax, mtree, packing, quality, rans, secrets, surrogates, urls
from starmill.llm.common import table


def op1_url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op2_spaced_seed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, with the benchmark item and the overlap."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("mark")


def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents to keep, with expected grade and probability of the top grade."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, quality.graded(table(spark, sf_dir, "labels")))
    return quality.scored(docs.select("doc_id", "text"), model).where(f"tail_probability >= {quality.KEEP}").drop("text")


def op4_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages"))


def op5_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.round_trip(table(spark, sf_dir, "documents"))


def op6_min_max_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.groups(table(spark, sf_dir, "documents"))


def op7_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text after replacement, and the number of mentions."""
    return surrogates.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), count="n_replaced")


def op9_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op10_m_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"))


def op12_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_words": op1_url_words,
    "op2_spaced_seed_leaks": op2_spaced_seed_leaks,
    "op3_ordinal_quality": op3_ordinal_quality,
    "op4_crf_main_text": op4_crf_main_text,
    "op5_rans_token_files": op5_rans_token_files,
    "op6_min_max_groups": op6_min_max_groups,
    "op7_linked_secrets": op7_linked_secrets,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_backtracking_bpe": op9_backtracking_bpe,
    "op10_m_tree_top_k": op10_m_tree_top_k,
    "op11_token_alignment": op11_token_alignment,
    "op12_complement_packing": op12_complement_packing,
    "op13_source_divergence": op13_source_divergence,
}
ORACLES: dict[str, str] = {"op13_source_divergence": divergence.AUDIT_SQL}
