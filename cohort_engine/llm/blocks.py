"""Texts packed into blocks, and exchanges between blocks and buckets of keys.

Operators that compare all places of all texts work on a few numbers for each place.
A row for each of them would cost more than the work itself, so that tasks pack them:
a block holds some MB of texts as one row, and what a block sends to a bucket of keys
is one row of arrays. Spark deals blocks and buckets to tasks and shuffles these rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm.common import chunks, stored, text_of

BLOCK_BYTES = 2 << 20
# Text whose keys are one bucket. Keys of a bucket are in memory at once.
BUCKET_BYTES = 64 << 20
# A row key is block << ROW_BITS | number in the block, which has fewer rows than that.
ROW_BITS = 20

_SCHEMA = (
    "block long, ids array<bigint>, sizes array<bigint>, counts array<bigint>,"
    " marks array<binary>, payload binary"
)


@dataclass
class Block:
    """Some whole texts: ``data[starts[i]:starts[i] + sizes[i]]`` is text ``i``."""

    number: int
    ids: np.ndarray
    sizes: np.ndarray
    counts: np.ndarray
    data: bytes

    def __post_init__(self):
        self.starts = np.cumsum(self.sizes) - self.sizes

    @property
    def keys(self) -> np.ndarray:
        """Row keys of the texts."""
        return (np.int64(self.number) << ROW_BITS) + np.arange(len(self.ids))

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.sizes[i]]


# Ids stand for themselves; a null id is smaller than any other.
NULL_ID = -(1 << 63)


def digest_marks(texts: list[bytes]) -> tuple[list[bytes], list[int]]:
    """SHA-256 and bytes of each text."""
    return [hashlib.sha256(t).digest() for t in texts], [len(t) for t in texts]


def build(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    name: str,
    marks: Callable[[list[bytes]], tuple[list[bytes], list[int]]] = digest_marks,
) -> DataFrame:
    """Pack ``docs`` into a stored table of blocks; a null text counts as empty.

    ``marks`` gives a mark (texts with the same one are taken as equal) and a count for
    each text. Ids must be integers. Runs a job.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))

    def packed(batches):
        first = TaskContext.get().partitionId() << 20
        tool = zstandard.ZstdCompressor(level=5)
        for number, batch in enumerate(
            chunks(batches, "text", BLOCK_BYTES, (1 << ROW_BITS) - 1), first
        ):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            found, counts = marks(texts)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([number], pa.int64()),
                    "ids": [batch.column("id").fill_null(NULL_ID).to_pylist()],
                    "sizes": [[len(t) for t in texts]],
                    "counts": [counts],
                    "marks": pa.array([found], pa.list_(pa.binary())),
                    "payload": pa.array([tool.compress(b"".join(texts))], pa.binary()),
                }
            )

    return stored(source.mapInArrow(packed, _SCHEMA), name)


def unpack(batch: pa.RecordBatch) -> Iterator[tuple[Block, dict]]:
    """The blocks of a batch, each with its other columns."""
    tool = zstandard.ZstdDecompressor()
    rest = [n for n in batch.schema.names if n not in ("ids", "sizes", "counts", "payload")]
    for i in range(batch.num_rows):
        arrays = [
            np.asarray(batch.column(n)[i].values.to_numpy(zero_copy_only=False), np.int64)
            for n in ("ids", "sizes", "counts")
        ]
        data = tool.decompress(batch.column("payload")[i].as_buffer())
        block = Block(batch.column("block")[i].as_py(), *arrays, data)
        yield block, {n: batch.column(n)[i].as_py() for n in rest}


def rows(blocks: DataFrame) -> DataFrame:
    """(key, id, count, mark) for each text; the payload is not read."""
    return blocks.select(
        "block", F.posexplode(F.arrays_zip("ids", "counts", "marks")).alias("i", "row")
    ).select(
        F.shiftleft("block", ROW_BITS).bitwiseOR(F.col("i").cast("long")).alias("key"),
        F.when(F.col("row.ids") != NULL_ID, F.col("row.ids")).alias("id"),
        F.col("row.counts").alias("count"),
        F.col("row.marks").alias("mark"),
    )


def first_of_equals(texts: DataFrame) -> DataFrame:
    """(mark, owner, copies): the row with the smallest id, then key, and the group's size.

    The group of a mark is only counted and its smallest row taken, so that the size of a
    group of copies does not matter.
    """
    return texts.groupBy("mark").agg(
        F.min(F.struct(F.coalesce("id", F.lit(NULL_ID)).alias("id"), "key")).alias("owner"),
        F.count(F.lit(1)).alias("copies"),
    )


def to_blocks(df: DataFrame, name: str) -> DataFrame:
    """One row for each block with all rows of ``df`` for it as an array ``name``.

    A block gets at most what was asked about its own texts.
    """
    others = [c for c in df.columns if c != "block"]
    return df.groupBy("block").agg(F.collect_list(F.struct(*others)).alias(name))


def of_block(key):
    """The block of a row key."""
    return F.shiftright(key, ROW_BITS)


def split(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts keys by bucket, then value, and where each bucket begins."""
    bucket = (keys >> np.uint64(40)) % np.uint64(buckets)
    order = np.lexsort((keys, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


def partitions_of(spark) -> int:
    """As many as any shuffle has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_of(blocks: DataFrame) -> int:
    """Buckets of keys for the texts of ``blocks``: one for BUCKET_BYTES, at least as many as
    any shuffle has partitions. Runs a job over the sizes."""
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    total = blocks.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return max(partitions_of(blocks.sparkSession), -(-total // BUCKET_BYTES))


def each_bucket(
    batches: Iterator[pa.RecordBatch], task: Callable[[list[dict]], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """What ``task`` makes of the rows of one bucket after the other; they come in this order.

    Only one bucket is in memory, however many a task has, and only ``task`` holds it.
    """
    # The last list is the bucket that is not complete.
    lists: list[list[dict]] = [[]]
    for batch in batches:
        rows = batch.to_pylist()
        del batch
        for row in rows:
            if lists[-1] and lists[-1][-1]["bucket"] != row["bucket"]:
                lists.append([])
            lists[-1].append(row)
            del row
        del rows
        while len(lists) > 1:
            yield from task(lists.pop(0))
    if lists[-1]:
        yield from task(lists.pop())
