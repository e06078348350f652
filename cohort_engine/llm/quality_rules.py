"""Rules on words and lines of a document, and on lines shared by a host's documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm.common import let, stored, text_of, words_of

MIN_WORDS = 50
# A line in more documents of a host than this is taken as boilerplate of the host.
MAX_DOCS = 100
# A document that keeps less than this share of its characters is depleted.
MIN_SHARE = 0.5


def repeated_words(words: Column) -> Column:
    """Number of words in three-word windows that the array has twice or more.

    Windows are compared by a 64-bit hash. Sorted by hash and place, equal windows are
    neighbours; the covered words are then summed in order of place.
    """

    def places(keys: Column) -> Column:
        def repeated(key: Column, i: Column) -> Column:
            before, after = F.get(keys, i - 1)["h"], F.get(keys, i + 1)["h"]
            return before.eqNullSafe(key["h"]) | after.eqNullSafe(key["h"])

        return F.sort_array(F.transform(F.filter(keys, repeated), lambda k: k["p"]))

    def covered(keys: Column) -> Column:
        total = F.aggregate(
            let(F.sort_array(keys), places),
            F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total")),
            lambda acc, p: F.struct(
                p.alias("last"), (acc["total"] + F.least(F.lit(3), p - acc["last"])).alias("total")
            ),
            lambda acc: acc["total"],
        )
        hashes = F.transform(keys, lambda k: k["h"])
        return F.when(F.size(F.array_distinct(hashes)) == F.size(keys), 0).otherwise(total)

    def windows(w: Column) -> Column:
        return F.transform(
            F.slice(w, F.lit(1), F.size(w) - 2),
            lambda first, i: F.struct(
                F.xxhash64(first, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")
            ),
        )

    return F.when(F.size(words) < 4, 0).otherwise(let(windows(words), covered)).cast("long")


def _base(text: Column) -> Column:
    """Struct of the counts that one text gives."""

    def counts(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))
            .cast("long")
            .alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
        )

    worded = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(words_of(text), lambda words: let(worded, lambda lines: counts(words, lines)))


def _normalised(line: Column) -> Column:
    """Lower case, white space as one space, each digit as 0."""
    spaced = F.btrim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))
    return F.regexp_replace(spaced, "[0-9]", "0")


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = MAX_DOCS,
    min_share: float = MIN_SHARE,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Counts, base rules, and the verdict on lines that many documents share.

    Each line with a word is hashed in normal form. The documents of each host that have
    the line are counted; lines in more than ``max_docs`` of them are removed. A document
    left with less than ``min_share`` of the characters of its lines is depleted and not
    kept, nor is one that fails the base rules.

    A null text has no words and fails; null hosts count as one host. Repeated rows count
    as documents of their own. An empty table gives an empty result. Other columns are
    ignored. Runs a job that stores counts and line hashes; texts are read once.

    Result, a row for each input row: id, the counts, base_failed, kept, removed_lines
    (numbers from 0 of the lines to remove) and kept_share.
    """
    text = text_of(text_col)
    lines = F.transform(
        F.split(text, "\n"),
        lambda x, i: F.struct(
            F.xxhash64(_normalised(x)).alias("h"),
            F.char_length(x).alias("chars"),
            i.alias("i"),
            x.rlike(r"[^\x20\x09-\x0D]").alias("worded"),
        ),
    )
    base = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(host_col).alias("host"),
            F.monotonically_increasing_id().alias("row"),
            _base(text).alias("base"),
            F.filter(lines, lambda x: x["worded"]).alias("lines"),
        ).select("id", "host", "row", "base.*", "lines"),
        "line-hashes",
    )
    of_host = F.struct("host", "h").alias("key")
    frequent = (
        base.select("host", F.explode(F.array_distinct("lines.h")).alias("h"))
        .groupBy(of_host)
        .agg(F.count(F.lit(1)).alias("docs"))
        .filter(F.col("docs") > max_docs)
        .select("key")
    )
    removed = (
        base.select("host", "row", F.explode("lines").alias("line"))
        .select(
            F.struct("host", F.col("line.h").alias("h")).alias("key"),
            "row",
            F.col("line.chars").alias("chars"),
            F.col("line.i").alias("i"),
        )
        .join(frequent, "key", "left_semi")
        .groupBy("row")
        .agg(F.sum("chars").alias("gone"), F.sort_array(F.collect_list("i")).alias("numbers"))
    )
    total = F.aggregate("lines", F.lit(0), lambda a, x: a + x["chars"])
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    share = F.when(total == 0, 1.0).otherwise(1 - F.coalesce("gone", F.lit(0)) / total)
    return (
        base.join(removed, "row", "left")
        .withColumns({"share": share, "failed": failed})
        .select(
            F.col("id").alias(id_col),
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            F.col("failed").alias("base_failed"),
            (~F.col("failed") & (F.col("share") >= min_share)).alias("kept"),
            F.coalesce("numbers", F.array().cast("array<int>")).alias("removed_lines"),
            F.col("share").alias("kept_share"),
        )
    )


def without_lines(text: Column, numbers: Column) -> Column:
    """The text without the lines of these numbers."""
    return F.array_join(
        F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(numbers, i)), "\n"
    )
