"""Byte-level BPE encoding and decoding of whole texts."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm.common import SPACES, chunks, text_of

# Characters of a chunk, and of the stretch that it shares with the next one.
CHUNK = 1 << 16
OVERLAP = 1 << 10
# Chunks of a text beyond which they are encoded by different tasks.
PARALLEL = 4

SCHEMA = "n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"


def parse_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    pairs = (line.split() for line in lines.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Codec:
    """Encoder and decoder of one vocabulary; ``pattern`` splits text before merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(pattern)

    def boundaries(self, text: str, start: int, end: int) -> set[int]:
        """Where pre-tokens begin when the split starts at ``start``."""
        return {m.start() for m in self.pattern.finditer(text, start, end)}

    def cut(self, text: str, near: int, overlap: int, reach: int | None = None) -> int | None:
        """A place after ``near`` where the text can be split, or its end.

        With ``reach`` None is returned where no place is found so far behind ``near``; the
        answer then depends on the text from ``overlap`` before to ``reach`` behind only.

        The split that comes from the left and the one that starts at ``near`` are
        compared over the shared stretch. They have resynchronised where both begin a
        pre-token at white space that follows other text: there every split begins one,
        wherever it started. Without such a place the stretch is carried on.
        """
        last = len(text) if reach is None else min(len(text), near + reach)
        while near < last:
            end = min(last, near + overlap)
            both = self.boundaries(text, max(0, near - overlap), end) & self.boundaries(
                text, near, end
            )
            for place in sorted(both):
                if place > near and text[place] in SPACES and not text[place - 1].isspace():
                    return place
            near = end
        return len(text) if reach is None else None

    def encode(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[int]]:
        """Ids of the chunks of a text, in order."""
        start = 0
        while start < len(text):
            end = len(text)
            if end - start > chunk:
                end = self.cut(text, start + chunk, overlap)
            yield self.encoding.encode_ordinary(text[start:end])
            start = end

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def _codec(lines: bytes, pattern: str) -> Codec:
    return Codec(parse_ranks(lines), pattern)


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    with_ids: bool = True,
) -> DataFrame:
    """Encode each text by the ranks, and decode the ids again.

    Texts are cut into overlapping chunks, stitched where pre-token boundaries
    resynchronise, and the pieces between are encoded; the result is that of one pass
    over the whole text. Piece by piece, ids and decoded bytes go into running hashes.

    Chunks of texts of over ``PARALLEL`` chunks are rows of their own, which tasks
    pre-tokenise and encode at the same time: each chunk comes with the overlaps on both
    sides, and finds there the cuts that its neighbours find. Where a whole chunk has no
    cut, its text is encoded with the next one's when the ids of a text are put together,
    in one task for each text. Of equal long texts one is encoded. Shorter texts are not
    shuffled.

    The rank file (some hundred kB, its size does not depend on the documents) is read
    by the driver and sent to the tasks. Each batch of texts is bounded.
    A null text is encoded as an empty one: 0 tokens and the hashes of nothing. Repeated
    rows are encoded each; an empty table gives an empty result. Other columns are
    ignored.

    Result, a row for each input row: id, n_tokens, ids (if ``with_ids``), ids_sha256
    (of decimal ids joined by commas), decoded_sha256 (of the decoded bytes).
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as file:
        lines = spark.sparkContext.broadcast(file.read())
    source = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    fields = SCHEMA if with_ids else SCHEMA.replace("ids array<int>, ", "")

    def encoded(batches):
        codec = _codec(lines.value, pattern)
        for batch in chunks(batches, "text"):
            found = [_Result(with_ids) for _ in range(batch.num_rows)]
            for result, text in zip(found, batch.column("text").to_pylist(), strict=True):
                for ids in codec.encode(text, chunk, overlap):
                    result.add(codec, ids)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), **_columns(found)})

    def exploded(batches):
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
                whole = text.as_py()
                for number, first in enumerate(range(0, len(whole), chunk)):
                    begin, end = max(0, first - overlap), first + 2 * chunk
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": [key.as_py()],
                            "number": [number],
                            "at": [first - begin],
                            "last": [first + chunk >= len(whole)],
                            "text": [whole[begin:end]],
                        }
                    )

    def encoded_chunks(batches):
        codec = _codec(lines.value, pattern)
        for batch in batches:
            for row in batch.to_pylist():
                text, at = row["text"], row["at"]
                # Both neighbours of a boundary find the same cut, from the same characters.
                start = codec.cut(text[: at + chunk], at, overlap, chunk) if row["number"] else 0
                end = len(text) if row["last"] else codec.cut(text, at + chunk, overlap, chunk)
                closed = start is not None and end is not None
                start = at if start is None else start
                stop = at + chunk if end is None else end
                piece = text[start:stop]
                ids = codec.encoding.encode_ordinary(piece) if closed else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["key"]], pa.binary()),
                        pa.array([row["number"]], pa.int64()),
                        pa.array([ids], pa.list_(pa.int32())),
                        # Without a cut what is to be encoded goes on in the next chunk.
                        pa.array([None if closed else piece], pa.string()),
                        pa.array([end is None], pa.bool_()),
                    ],
                    ["key", "number", "ids", "text", "goes_on"],
                )

    def assembled(table):
        codec, result, held = _codec(lines.value, pattern), _Result(with_ids), []
        for row in table.sort_by("number").to_pylist():
            if row["text"] is None:
                result.add(codec, row["ids"])
                continue
            held.append(row["text"])
            if not row["goes_on"]:
                result.add(codec, codec.encoding.encode_ordinary("".join(held)))
                held = []
        return pa.table({"key": table.column("key")[:1], **_columns([result])})

    long = F.length("text") > PARALLEL * chunk
    short = source.filter(~long).mapInArrow(encoded, f"id {kind}, {fields}")
    keyed = source.filter(long).withColumn("key", F.unhex(F.sha2("text", 256)))
    parts = (
        keyed.groupBy("key")
        .agg(F.first("text").alias("text"))
        .mapInArrow(exploded, "key binary, number long, at long, last boolean, text string")
        .repartition("key", "number")
        .mapInArrow(
            encoded_chunks, "key binary, number long, ids array<int>, text string, goes_on boolean"
        )
    )
    whole = parts.groupBy("key").applyInArrow(assembled, f"key binary, {fields}")
    joined = keyed.select("id", "key").join(whole, "key").drop("key")
    return short.unionByName(joined).withColumnRenamed("id", id_col)


class _Result:
    """Ids and hashes of one text, as its pieces come in."""

    def __init__(self, with_ids: bool):
        self.kept = [] if with_ids else None
        self.count, self.of_ids, self.of_bytes = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, codec: Codec, ids: list[int]) -> None:
        if not ids:
            return
        self.of_ids.update((("," if self.count else "") + ",".join(map(str, ids))).encode())
        self.of_bytes.update(codec.decode(ids))
        self.count += len(ids)
        if self.kept is not None:
            self.kept.extend(ids)


def _columns(found: list[_Result]) -> dict[str, pa.Array]:
    columns = {"n_tokens": pa.array([r.count for r in found], pa.int64())}
    if found and found[0].kept is not None:
        columns["ids"] = pa.array([r.kept for r in found], pa.list_(pa.int32()))
    columns["ids_sha256"] = pa.array([r.of_ids.hexdigest() for r in found])
    columns["decoded_sha256"] = pa.array([r.of_bytes.hexdigest() for r in found])
    return columns
