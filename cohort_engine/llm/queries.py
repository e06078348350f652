"""The operators as queries over the whole test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohort_engine.llm import (
    automaton_dedup,
    bpe,
    exact_dedup,
    jaccard,
    lexical_search,
    mixing,
    periodic_runs,
    pii,
    quality_model,
    quality_rules,
    secrets,
    suffix_dedup,
    vector_forest,
)
from cohort_engine.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

RANKS = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, symbols, repeated lines and words of all documents, and the verdict."""
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, plain and in encoded layers."""
    return secrets.secrets_digest(secrets.scan_secrets(_table(spark, sf_dir, "documents")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without bytes that start earlier."""
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of all documents."""
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each document by a model of the labels not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = quality_model.train(docs, _table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of similar documents."""
    return jaccard.similar_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "n_links"
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal identifiers of all documents, plain and disguised."""
    return pii.identifiers_digest(pii.scan_identifiers(_table(spark, sf_dir, "documents")))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without repeated windows."""
    return automaton_dedup.remove_passages(_table(spark, sf_dir, "documents")).drop("spans")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of all documents."""
    return bpe.encode_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path(RANKS),
        public_tokenizers.PATTERN,
        with_ids=False,
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    return lexical_search.search(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, of which every tenth is made periodic first."""
    docs = periodic_runs.with_periods(_table(spark, sf_dir, "documents"))
    return periodic_runs.runs_digest(periodic_runs.find_runs(docs))


def op13_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return vector_forest.near_vectors(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_secret_scans,
        op3_mixing,
        op4_suffix_array_dedup,
        op5_exact_dedup,
        op6_quality_classifier,
        op7_ngram_jaccard,
        op8_pii,
        op9_substring_dedup,
        op10_bpe,
        op11_lexical_search,
        op12_periodic_runs,
        op13_embedding_forest,
    )
}
