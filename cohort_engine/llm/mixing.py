"""Mix the documents of sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort_engine.llm.common import WORD, numbered, stored, text_of

# Passes over one source at most.
MAX_PASSES = 3


def rotating_weight(rank: Column) -> Column:
    """Weights 1, 2, 3, 1, ... of the sources by rank from 0."""
    return (rank % 3 + 1).cast("double")


def targets(sizes: DataFrame, share: float, max_passes: int, weight) -> DataFrame:
    """Target of each source, given a row (source, source_size) for each.

    All sources get ``level * weight`` tokens, but no more than ``max_passes`` times
    their size; the level is such that the targets add up to ``share`` of all tokens.
    Sources are ordered by the level at which they are full, so that the full ones come
    first: the level left for the others follows from sums over that order. This is one
    task over one short row for each source; documents are not touched.
    """
    ranked = sizes.withColumn(
        "w", weight(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ).withColumn("cap", F.lit(float(max_passes)) * F.col("source_size"))
    full_at = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = full_at.rowsBetween(Window.unboundedPreceding, -1)
    rest = full_at.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = share * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    # The first source that its level does not fill has the level of all that follow.
    leveled = ranked.withColumns({"level": level, "place": F.row_number().over(full_at)})
    open_ = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("place", "level"))
    return leveled.withColumn("final", F.min(open_).over(everything)["level"]).select(
        "source",
        "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("w"), F.col("cap"))).alias(
            "target"
        ),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.0,
    max_passes: int = MAX_PASSES,
    weight=rotating_weight,
    seed: str = "mix",
    row_col: str | None = None,
) -> DataFrame:
    """How often a mix takes each document, so that sources come near their targets.

    The size of a document is its number of words. Each source is shuffled by hash and
    gone through up to ``max_passes`` times. A document's virtual finish time is the sum
    of the sizes of its source so far, divided by the source's target. In order of that
    time, documents are taken until the budget, the sum of all targets, is reached.

    Both running sums are taken in two steps, within buckets of the order and over the
    buckets, with about as many buckets as documents in a bucket: no task sees a whole
    source. Neither a source nor a place in the order can fill a bucket, since buckets
    cut the hash range and the time, in which each source runs evenly.

    A null text has size 0; null sources are one source; the order depends on hashes of
    id, size and pass only, so that reruns agree; equal rows may swap places, which does
    not show. Documents of size 0 are taken 0 words. An empty table gives an empty
    result. Other columns are ignored. Runs jobs that store ids and sizes.

    Result, a row for each input row: id, size, source_size, target, taken (words,
    repeats counted), passes (how often it is taken), and row, which is ``row_col`` if
    the caller has numbered the rows.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.struct(F.col(source_col).alias("source")).alias("key"),
            (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
            F.size(F.regexp_extract_all(text_of(text_col), F.lit(WORD), 0))
            .cast("long")
            .alias("size"),
        ),
        "sizes",
    )
    n = rows.count()
    buckets = max(1, math.isqrt(n))
    sources = (
        rows.groupBy("key")
        .agg(F.sum("size").alias("source_size"))
        .select("key", F.col("key.source").alias("source"), "source_size")
    )
    goals = targets(sources.select("source", "source_size"), share, max_passes, weight)
    goals = stored(goals.select(F.struct("source").alias("key"), "source_size", "target"), "goals")

    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    hashed = (
        rows.withColumn("order", order)
        .withColumn(
            "bucket",
            F.floor(
                F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * buckets / (1 << 32)
            ),
        )
    )
    start = _starts(hashed.groupBy("key", "bucket").agg(F.sum("size").alias("sum")), ["key"])
    within = (
        Window.partitionBy("key", "bucket")
        .orderBy("order", "id", "size", "row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    passes = F.sequence(F.lit(0), F.lit(max_passes - 1))
    finish = (F.col("pass") * F.col("source_size") + F.col("start") + F.col("inner")) / F.col(
        "target"
    )
    queued = stored(
        hashed.withColumn("inner", F.sum("size").over(within))
        .join(start, ["key", "bucket"])
        .join(goals, "key")
        .filter("size > 0 AND target > 0")
        .withColumn("pass", F.explode(passes))
        .select("row", "size", "order", "pass", finish.alias("finish")),
        "queue",
    )
    # Sources meet their targets at about time 1. What is left of a source with a low
    # target may stretch far beyond; later slots are wider, in proportion to the time.
    time = F.col("finish")
    slots = queued.withColumn(
        "slot",
        F.floor(F.when(time < 2, time).otherwise(F.log2(time) + 1) * buckets).cast("long"),
    )
    before = _starts(slots.groupBy("slot").agg(F.sum("size").alias("sum")), [], "slot")
    in_slot = (
        Window.partitionBy("slot")
        .orderBy("finish", "order", "pass", "row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    budget = goals.agg(F.sum("target")).scalar()
    taken = (
        # A slot that begins beyond the budget has nothing to take.
        slots.join(before.filter(F.col("start") < budget), "slot")
        .withColumn("used", F.col("start") + F.sum("size").over(in_slot))
        .filter(F.col("used") <= budget)
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("passes"))
    )
    return (
        rows.join(goals, "key")
        .join(taken, "row", "left")
        .withColumn("passes", F.coalesce("passes", F.lit(0)))
        .select(
            F.col("id").alias(id_col),
            "size",
            "source_size",
            "target",
            (F.col("size") * F.col("passes")).alias("taken"),
            "passes",
            "row",
        )
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them, with all their columns.

    Repeated rows are rows of their own; documents without words (null, empty or blank text)
    have size 0 and are not taken. A null source is a source of its own, ids may be null. An
    empty table gives an empty result. Columns may have any names.

    Runs jobs, one of which stores the documents with row numbers.
    """
    documents = numbered(docs, "documents")
    fields = [F.col("doc")[c].alias(c) for c in (id_col, text_col, source_col)]
    found = mix(documents.select("row", *fields), id_col, text_col, source_col, row_col="row")
    times = found.filter("passes > 0").select("row", "passes")
    return (
        documents.join(times, "row")
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("passes").cast("int"))))
        .select("doc.*")
    )


def _starts(sums: DataFrame, by: list[str], place: str = "bucket") -> DataFrame:
    """The sum of all earlier places, for each place; a short row for each place."""
    before = (
        Window.partitionBy(*by).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    )
    return sums.select(*by, place, F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("start"))
