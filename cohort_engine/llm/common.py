"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_engine.session import scratch_dir

# The characters between words: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty without words."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return let(
        trimmed,
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(
            F.split(t, r"[\x20\x09-\x0D]+")
        ),
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder all executors share, and read again.

    Runs a job. Later steps start from the files, so that a lost executor costs the
    running step only, and row ids given before stay as they are.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str, *more: Column) -> DataFrame:
    """(row, doc, more): ``docs`` stored with a number for each row.

    All columns stand in the struct ``doc``, so that none can clash with another's name.
    """
    return stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
            *more,
        ),
        name,
    )


def rows_in(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents of a ``numbered`` table whose row is in ``rows``, as they came."""
    return documents.join(rows, "row", "left_semi").select("doc.*")


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 20, rows: int = 1 << 19
) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes of text, or of one row, and at most ``rows`` rows,
    to bound memory."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        start, held = 0, 0
        for row, size in enumerate(sizes.to_pylist()):
            if (held and held + size > limit) or row - start == rows:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)
