"""Exact duplicates of texts, with frequent texts settled before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm.common import numbered, rows_in, stored, text_of

# Counters of the frequent-items sketch, and the most digests it may report. A digest
# with over 3.5 / TRACKED of all rows is always among them; there are fewer than REPORTED
# such digests, so that the broadcast table has REPORTED short rows at most.
TRACKED = 16_384
REPORTED = 8_192
# Groups of tasks whose counters are added up first.
GROUPS = 256


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Group equal texts; of each group the row with the largest id stays.

    Misra-Gries counters (Spark's ``approx_top_k``) name the digests that may be
    frequent. Their exact counts and winners are then computed, and those winners are
    broadcast: rows of frequent texts are settled where they are read. Only the other
    digests are shuffled, in groups that are small by the bound of the sketch.

    Texts count as equal if their SHA-256 is. A null text counts as empty, and empty
    texts are equal. A null id is smaller than any other; of rows with the same id and
    text one stays. An empty table gives an empty result. Other columns are ignored.
    Runs a job that stores ids and digests.

    Result, a row for each input row: id, keep_id, group_size, kept, text_sha256.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.monotonically_increasing_id().alias("row"),
            _digest(text_col),
        ),
        "digests",
    )
    return grouped(rows).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256"
    )


def without_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay by ``exact_duplicates``, with all their columns.

    Runs a job that stores the documents with row numbers.
    """
    documents = numbered(docs, "documents", F.col(id_col).alias("id"), _digest(text_col))
    rows = grouped(documents.select("id", "row", "digest"))
    return rows_in(documents, rows.filter("kept").select("row"))


def _digest(text_col: str) -> Column:
    return F.sha2(text_of(text_col).cast("binary"), 256).alias("digest")


def grouped(rows: DataFrame) -> DataFrame:
    """Groups of equal digests of the stored rows (id, row, digest)."""
    # Counters of each task, added up in groups of tasks first: no task merges them all.
    frequent = (
        rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("group"))
        .agg(F.expr(f"approx_top_k_accumulate(digest, {TRACKED})").alias("counters"))
        .groupBy(F.lit("all"))  # an empty table has no group then, which the estimate needs
        .agg(F.expr(f"approx_top_k_combine(counters, {TRACKED})").alias("counters"))
        .select(F.explode(F.expr(f"approx_top_k_estimate(counters, {REPORTED})")).alias("found"))
        .select(F.col("found.item").alias("digest"))
    )
    winner = F.max(F.struct("id", "row")).alias("winner")
    size = F.count(F.lit(1)).alias("size")
    verified = (
        rows.join(F.broadcast(frequent), "digest", "left_semi")
        .groupBy("digest")
        .agg(winner, size)
        .filter("size > 1")
    )
    settled = rows.join(F.broadcast(verified), "digest")
    rest = rows.join(F.broadcast(verified), "digest", "left_anti")
    small = rest.join(rest.groupBy("digest").agg(winner, size), "digest")
    return settled.unionByName(small).select(
        "id",
        "row",
        F.col("winner.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
