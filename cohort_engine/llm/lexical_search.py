"""Ranked lexical search: the documents with the largest inner products with each query.

A document is a sparse vector of integer impacts, a query one of integer weights. Impact
vectors are ordered by length and cut into buckets of similar length (LEMP). With the
query's k-th best score so far as threshold, the Cauchy-Schwarz inequality drops whole
buckets, bounds over the query's strongest coordinates drop vectors in the others, and the
survivors are scored exactly in integers.

Only coordinates that some query has take part: the others add nothing to any score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_engine.llm.common import chunks, stored, text_of

TOP = 20
# Queries that one pass over the documents answers: so many rows, and characters of text
# (or one row). Their texts come to the driver.
QUERY_BLOCK = 4096
QUERY_CHARACTERS = 8 << 20
# Vectors of a bucket.
BUCKET = 4096
# Vectors of the first buckets, whose best scores are the thresholds that all tasks start with.
FIRST = 4 * BUCKET
# Bounds are computed in doubles; scores are below this share of a bound for sure.
_SLACK = 1 + 1e-9

# A-Z lower-cased; digits, letters and all bytes above 127 kept; the rest are separators.
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
_VECTORS = "id long, n long, terms array<int>, counts array<int>"
_HITS = "item long, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, with repeats."""
    return text.encode().translate(_TERMS).split()


@dataclass
class Queries:
    """Queries of a block: of each, its term numbers and how often it has them."""

    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]
    counts: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str | None]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        terms, counts = [], []
        for text in texts:
            found = [vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text or "")]
            numbers, times = np.unique(np.array(found, np.int64), return_counts=True)
            terms.append(numbers)
            counts.append(times)
        return cls(vocabulary, terms, counts)


def _vectors(vocabulary):
    """Counts of the queries' terms in each text, and n, the number of all its terms."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            for piece in chunks([batch], "text"):
                sizes, terms, counts = [], [], []
                for text in piece.column("text").to_pylist():
                    found = terms_of(text)
                    sizes.append(len(found))
                    known = [x for x in map(number, found) if x is not None]
                    numbers, times = np.unique(np.array(known, np.int32), return_counts=True)
                    terms.append(numbers)
                    counts.append(times.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(terms, pa.list_(pa.int32())),
                        pa.array(counts, pa.list_(pa.int32())),
                    ],
                    ["id", "n", "terms", "counts"],
                )

    return counted


@dataclass
class Bucket:
    """Impact vectors of similar length, by vector and by coordinate."""

    ids: np.ndarray
    known: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray

    def __post_init__(self):
        self.order = np.argsort(self.terms, kind="stable")
        self.sorted = self.terms[self.order]
        self.owner = np.repeat(np.arange(len(self.ids)), np.diff(self.starts))
        self.longest = float(self.lengths.max(initial=0))

    def column(self, term: int) -> np.ndarray:
        """Places of a coordinate's values."""
        low, high = np.searchsorted(self.sorted, (term, term + 1))
        return self.order[low:high]

    def candidates(self, terms, weights, least: int) -> np.ndarray:
        """Vectors whose inner product with the query may reach ``least``.

        The query's coordinates are taken from the heaviest, until what is left of it is so
        short that a vector with none of those taken can't reach ``least`` (Cauchy-Schwarz
        with the bucket's longest vector). Of the others, the product over the coordinates
        taken plus the bound for the rest, with the vector's own length, decides.
        """
        heavy = np.argsort(-weights, kind="stable")
        squares = np.cumsum((weights[heavy].astype(float) ** 2)[::-1])[::-1]
        rest = np.sqrt(np.append(squares, 0.0))
        if rest[0] * self.longest * _SLACK < least:
            return np.zeros(0, np.int64)
        taken = int(np.argmax(rest * self.longest * _SLACK < max(least, 1)))
        part = np.zeros(len(self.ids))
        for i in heavy[:taken]:
            places = self.column(terms[i])
            part[self.owner[places]] += float(weights[i]) * self.impacts[places]
        fits = (part + rest[taken] * self.lengths) * _SLACK >= max(least, 1)
        return np.flatnonzero(fits & (part > 0))

    def scores(self, rows: np.ndarray, terms, weights) -> np.ndarray:
        """Exact inner products of some vectors with the query."""
        if len(rows) * 8 > len(self.ids):
            out = np.zeros(len(self.ids), np.int64)
            for term, weight in zip(terms, weights, strict=True):
                places = self.column(term)
                out[self.owner[places]] += weight * self.impacts[places]
            return out[rows]
        out = np.zeros(len(rows), np.int64)
        for i, row in enumerate(rows.tolist()):
            place = slice(self.starts[row], self.starts[row + 1])
            at = np.searchsorted(terms, self.terms[place])
            at[at == len(terms)] = 0
            hit = terms[at] == self.terms[place]
            out[i] = (weights[at[hit]] * self.impacts[place][hit]).sum()
        return out


@dataclass
class _Best:
    """The best documents of one query in a task: by score, then id, null ids last."""

    score: np.ndarray
    known: np.ndarray
    ids: np.ndarray

    def add(self, score: np.ndarray, known: np.ndarray, ids: np.ndarray, top: int) -> None:
        score = np.concatenate([self.score, score])
        known = np.concatenate([self.known, known])
        ids = np.concatenate([self.ids, ids])
        best = np.lexsort((ids, ~known, -score))[:top]
        self.score, self.known, self.ids = score[best], known[best], ids[best]


def _impacts(counts, n, documents: int, total: int):
    """(1000000000 * tf) div (1000 * tf + 12 * m), m = 75 + (25 * n * N) div L."""
    tf = counts.astype(np.int64)
    m = 75 + (25 * n.astype(np.int64) * documents) // total
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _search(queries, documents: int, total: int, least, top: int):
    """Task: the best ``top`` of its vectors, which come by falling length, for each query."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = queries.value
        none = np.zeros(0, np.int64)
        best = [_Best(none, none.astype(bool), none) for _ in asked.terms]
        low = least.value.copy()
        for bucket in _buckets(batches, documents, total):
            for i, (terms, weight) in enumerate(zip(asked.terms, weights, strict=True)):
                if not len(terms):
                    continue
                rows = bucket.candidates(terms, weight, low[i])
                if not len(rows):
                    continue
                scores = bucket.scores(rows, terms, weight)
                good = scores >= max(low[i], 1)
                rows, scores = rows[good], scores[good]
                best[i].add(scores, bucket.known[rows], bucket.ids[rows], top)
                if len(best[i].score) == top:
                    low[i] = max(low[i], best[i].score[-1])
        items = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        if len(items):
            ids = np.concatenate([b.ids for b in best])
            known = np.concatenate([b.known for b in best])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(items, pa.int64()),
                    pa.array(ids, pa.int64(), mask=~known),
                    pa.array(np.concatenate([b.score for b in best]), pa.int64()),
                ],
                ["item", "doc_id", "score"],
            )

    return searched


def _buckets(batches: Iterator[pa.RecordBatch], documents: int, total: int) -> Iterator[Bucket]:
    for batch in batches:
        for first in range(0, batch.num_rows, BUCKET):
            part = batch.slice(first, BUCKET)
            lists = part.column("terms")
            sizes = np.asarray(lists.value_lengths())
            terms = lists.flatten().to_numpy().astype(np.int64)
            counts = part.column("counts").flatten().to_numpy()
            n = np.repeat(part.column("n").to_numpy(), sizes)
            impacts = _impacts(counts, n, documents, total)
            starts = np.append(0, np.cumsum(sizes))
            ids = part.column("id")
            yield Bucket(
                ids.fill_null(0).to_numpy(),
                ids.is_valid().to_numpy(zero_copy_only=False),
                part.column("length").to_numpy(),
                starts,
                terms,
                impacts,
            )


def _best_of_all(hits: DataFrame, top: int) -> DataFrame:
    """(item, rank, doc_id, score) of the hits; tasks send at most ``top`` for each item."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top)


def _block_results(docs: DataFrame, texts: list[str | None], top: int) -> DataFrame | None:
    """Results of one block of queries over all documents; item is the place in ``texts``."""
    spark = docs.sparkSession
    context = spark.sparkContext
    asked = Queries.of(texts)
    vocabulary = context.broadcast(asked.vocabulary)
    vectors = stored(docs.mapInArrow(_vectors(vocabulary), _VECTORS), "vectors")
    documents, total = vectors.agg(
        F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    if not documents:
        return None
    # One row for each term of the queries.
    holding = dict(
        vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    )
    weight = np.array(
        [
            math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(t, 0) + 1)))
            for t in range(len(asked.vocabulary))
        ],
        np.int64,
    )
    weights = [
        weight[terms] * counts for terms, counts in zip(asked.terms, asked.counts, strict=True)
    ]
    queries = context.broadcast((Queries({}, asked.terms, asked.counts), weights))

    m = 75 + F.expr(f"(25 * n * {documents}L) div {total}L")
    impact = F.transform(
        "counts", lambda c: (F.lit(1e9) * c / (1000.0 * c + 12.0 * m.cast("double")))
    )
    length = F.sqrt(F.aggregate(impact, F.lit(0.0), lambda a, x: a + x * x))
    # Equal vectors have equal lengths; the second key keeps them from one range.
    spread = F.xxhash64("id", F.monotonically_increasing_id())
    measured = vectors.filter(F.size("terms") > 0).select(
        "*", length.alias("length"), spread.alias("spread")
    )
    ordered = measured.repartitionByRange(F.desc("length"), "spread").sortWithinPartitions(
        F.desc("length"), "spread"
    )
    ordered = stored(ordered, "by-length")

    # First the longest vectors, from whose scores all tasks start.
    nothing = context.broadcast(np.zeros(len(texts), np.int64))
    share = 1 - min(1.0, FIRST / documents)
    cut = ordered.agg(F.percentile_approx("length", share)).first()[0]
    first = ordered.filter(F.col("length") >= F.lit(0.0 if cut is None else cut))
    seen = _best_of_all(first.mapInArrow(_search(queries, documents, total, nothing, top), _HITS), top)
    least = np.zeros(len(texts), np.int64)
    for item, score in seen.filter(F.col("rank") == top).select("item", "score").collect():
        least[item] = score
    start = context.broadcast(least)
    hits = ordered.mapInArrow(_search(queries, documents, total, start, top), _HITS)
    return _best_of_all(hits, top)


def search(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    query_col: str = "text",
    top: int = TOP,
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each row of ``queries``.

    Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, only A-Z
    lower-cased. A null or empty text has no terms: such a document is not counted and never
    found, such a query finds nothing. Only scores above 0 count; equal ones are ordered by
    document id, null ids last. Repeated rows of either table are ranked each on their own.
    Without documents or queries the result is empty. Other columns are not read.

    Queries go in blocks of ``block`` rows, whose texts come to the driver and are broadcast;
    documents are read once for each block. Runs jobs.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), text_of(f"`{text_col}`").alias("text")
    )
    schema = "item_id long, rank int, doc_id long, score long"
    asked = queries.select(
        F.col(f"`{item_col}`").cast("long").alias("item_id"), F.col(f"`{query_col}`").alias("text")
    )
    result = spark.createDataFrame([], schema)
    for rows in _in_blocks(asked, block):
        found = _block_results(source, [r["text"] for r in rows], top)
        if found is None:
            break
        names = spark.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(rows)], "item long, item_id long"
        )
        named = found.join(names, "item").select("item_id", "rank", "doc_id", "score")
        result = result.unionByName(named)
    return result


def _in_blocks(rows: DataFrame, block: int):
    """The rows, at most ``block`` and QUERY_CHARACTERS at a time."""
    held, size = [], 0
    for row in rows.toLocalIterator():
        more = len(row["text"] or "")
        if held and (len(held) == block or size + more > QUERY_CHARACTERS):
            yield held
            held, size = [], 0
        held.append(row)
        size += more
    if held:
        yield held
