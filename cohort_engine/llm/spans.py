"""Run a span finder over all texts, and digests of what it finds."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm.common import chunks, text_of

# kind, start, end (code points of the source text, end exclusive), and how the span was
# found: empty for a match in the text as it stands.
Span = tuple[str, int, int, str]

_SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("via", pa.string())]
)


def ascii_class(characters: str) -> np.ndarray:
    """Which of the 256 byte values are one of these ASCII characters."""
    table = np.zeros(256, bool)
    table[np.frombuffer(characters.encode("ascii"), np.uint8)] = True
    return table


def longest_run(data: np.ndarray, of: np.ndarray) -> int:
    """Length of the longest run of bytes of the class ``of``."""
    outside = np.flatnonzero(~of[data])
    if not len(outside):
        return len(data)
    inner = int(np.diff(outside).max()) - 1 if len(outside) > 1 else 0
    return max(int(outside[0]), inner, len(data) - 1 - int(outside[-1]))


def find_spans(
    docs: DataFrame, finder: Callable[[str], Iterable[Span]], id_col: str, text_col: str
) -> DataFrame:
    """(id, spans) for each row of ``docs``; no shuffle, bounded batches."""
    source = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def found(batches):
        for batch in chunks(batches, "text"):
            spans = [
                [dict(zip(("kind", "start", "end", "via"), s, strict=True)) for s in finder(text)]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "spans": pa.array(spans, pa.list_(_SPAN))}
            )

    kind = source.schema["id"].dataType.simpleString()
    fields = "spans array<struct<kind: string, start: bigint, end: bigint, via: string>>"
    return source.mapInArrow(found, f"id {kind}, {fields}").withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str, kinds: Iterable[str]) -> DataFrame:
    """Counts by kind and hash of the plain matches, and all spans as one string."""
    plain = F.filter("spans", lambda s: s["via"] == "")

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def number(kind: str) -> Column:
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        id_col,
        *[number(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(joined(plain).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
