"""From raw documents to token ids, stage by stage.

Each stage takes all documents that the one before kept, and returns the columns of
documents; the last returns token ids. Between stages the documents are written as
Parquet and read again. Columns may have any names, ids may be null or repeated, and an
empty table stays empty through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohort_engine.llm import bpe, exact_dedup, jaccard, mixing, quality_model
from cohort_engine.llm.common import stored

# The stages include a trained model and byte pair encoding, which SQL can't express.
ORACLE_SQL = None

RANKS = "byte_bpe_multi_50k.tiktoken"


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject.

    It is trained on documents of this stage with a label that is not held out, at most
    ``quality_model.MAX_TRAINING`` of them. Null texts are judged like empty ones, repeated
    rows each by their text; without labels all documents score one half and stay.
    """
    model = quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.accepted(docs, model)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id; null ids last, of equal ids one row.

    A null text equals an empty one.
    """
    return exact_dedup.without_duplicates(docs)


def dedup_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the row with the smallest id, null ids last.

    Documents without words are similar to none and stay.
    """
    return jaccard.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those without words are not taken.

    A null source is a source of its own.
    """
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document; none for a null or empty text."""
    return bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", classify),
    ("exact_dedup", dedup_exact),
    ("ngram_jaccard_join", dedup_similar),
    ("mixing", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; runs the jobs of all but the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
