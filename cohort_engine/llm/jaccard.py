"""Documents whose sets of word n-grams are similar."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm import blocks as B
from cohort_engine.llm.anchors import mixed
from cohort_engine.llm.common import numbered, rows_in, stored
from cohort_engine.llm.components import components
from cohort_engine.llm.repeats import together
from cohort_engine.llm.words import word_hashes, word_spans

WORDS = 5
PERCENT = 80
# Sets of a family that are compared in one task; larger families are cut into parts of about
# this size, of which those with sets of similar sizes are compared.
TOGETHER = 500


def shingles(data: bytes, starts: np.ndarray, sizes: np.ndarray, words: int) -> list[np.ndarray]:
    """The set of each text: ascending hashes of its word n-grams, A-Z taken as a-z.

    A text with fewer words has its whole sequence as the one n-gram; without words its
    set is empty.
    """
    first, end, number = word_spans(data, starts, sizes)
    hashes = word_hashes(data, first, end, True)
    keys = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(keys)]
    keys = mixed(keys)
    sets, at = [], 0
    for n in number.tolist():
        if n >= words:
            found = np.sort(keys[at : at + n - words + 1])
            sets.append(found[np.append(True, found[1:] != found[:-1])])
        elif n:
            key = np.array([n], np.uint64)
            for h in hashes[at : at + n]:
                key = mixed(key + h)
            sets.append(key)
        else:
            sets.append(np.zeros(0, np.uint64))
        at += n
    return sets


def needed(n: np.ndarray | int, percent: int):
    """The least number of members that a set of ``n`` shares with any similar one."""
    return -(-n * percent // 100)


def similar_sets(
    sets: list[np.ndarray], sizes: np.ndarray, part: np.ndarray, across: bool, percent: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others): each set with the similar ones before it, so that a pair comes once.

    If ``across``, only pairs of sets in different parts count. Sets without others are
    left out. Pairs are not gathered: the memory follows the members of the sets.

    ``sets`` hold the members that other sets may have too, ``sizes`` count all members.

    Sets are taken by size. Those before a set that are large enough for it stand side by
    side in each index list, so that the rest of a list is skipped by position. The
    overlaps of a set with all others are derived from those of the set before it if the
    two have much in common: only the lists of members that one of them lacks are read.
    """
    order = np.lexsort(([int(s[0]) if len(s) else 0 for s in sets], sizes))
    n = len(order)
    sizes, part = sizes[order], part[order]
    lengths = np.array([len(sets[i]) for i in order], np.int64)
    members = np.concatenate([sets[i] for i in order]) if n else np.zeros(0, np.uint64)
    _, token = np.unique(members, return_inverse=True)
    token = token.astype(np.int64)
    owner = np.repeat(np.arange(n, dtype=np.int64), lengths)
    index = np.sort(token * n + owner)
    listed = index % max(n, 1)
    ends = np.cumsum(lengths)
    own = [token[e - k : e] for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]

    def overlaps(tokens: np.ndarray, low: int, high: int) -> np.ndarray:
        """How many of the tokens each set from ``low`` to ``high`` has."""
        a = np.searchsorted(index, tokens * n + low)
        b = np.searchsorted(index, tokens * n + high)
        count = b - a
        total = int(count.sum())
        if not total:
            return np.zeros(high - low, np.int64)
        shift = np.repeat(a - (np.cumsum(count) - count), count)
        return np.bincount(listed[np.arange(total) + shift] - low, minlength=high - low)

    previous = None
    for i in range(n):
        low = int(np.searchsorted(sizes, needed(int(sizes[i]), percent)))
        if low >= i:
            previous = None
            continue
        derived = False
        if previous is not None:
            old, old_low, old_counts = previous
            common = np.intersect1d(own[i], own[old], assume_unique=True)
            if 2 * len(common) > len(own[old]):
                more = np.setdiff1d(own[i], common, assume_unique=True)
                less = np.setdiff1d(own[old], common, assume_unique=True)
                counts = np.empty(i - low, np.int64)
                counts[:-1] = (
                    old_counts[low - old_low :]
                    + overlaps(more, low, old)
                    - overlaps(less, low, old)
                )
                counts[-1] = len(common)
                derived = True
        if not derived:
            counts = overlaps(own[i], low, i)
        previous = (i, low, counts)
        union = sizes[i] + sizes[low:i] - counts
        found = np.flatnonzero(100 * counts >= percent * union)
        if across:
            found = found[part[found + low] != part[i]]
        if len(found):
            yield order[i], order[found + low]


class Forest:
    """Union-find over numbers from 0."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)


def _frequencies(blocks: DataFrame, words: int, buckets: int) -> DataFrame:
    """(block, answers): for each n-gram of a block, how many texts of the corpus have it.

    Answers are a byte each, 0 for one text, then the rounded logarithm. Only 40 bits of
    a hash and its bucket are compared; that two n-grams may be taken as one changes the
    order in which they are used, not the result.
    """

    def sent(batches):
        for batch in batches:
            for block, rest in B.unpack(batch):
                tokens, counts = block_tokens(block, rest["marks"], words)
                order, cuts = B.split(tokens, buckets)
                for bucket in np.flatnonzero(np.diff(cuts)):
                    part = order[cuts[bucket] : cuts[bucket + 1]]
                    low = tokens[part]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array([bucket], pa.int32()),
                            "block": pa.array([block.number], pa.int64()),
                            "low": [low.astype(np.uint32).tobytes()],
                            "high": [(low >> np.uint64(32)).astype(np.uint8).tobytes()],
                            "counts": [counts[part].tobytes()],
                        }
                    )

    def answered(batches):
        return B.each_bucket(batches, of_bucket)

    def of_bucket(parts):
        low = np.frombuffer(b"".join(p["low"] for p in parts), np.uint32)
        high = np.frombuffer(b"".join(p["high"] for p in parts), np.uint8)
        counts = np.frombuffer(b"".join(p["counts"] for p in parts), np.uint16)
        keys = high.astype(np.uint64) << np.uint64(32) | low
        order = np.argsort(keys)
        begin = np.flatnonzero(np.append(True, keys[order[1:]] != keys[order[:-1]]))
        total = np.add.reduceat(counts[order].astype(np.int64), begin)
        code = np.minimum(255, np.ceil(8 * np.log2(total))).astype(np.uint8)
        answer = np.empty(len(keys), np.uint8)
        answer[order] = np.repeat(code, np.diff(np.append(begin, len(keys))))
        at = 0
        for part in parts:
            n = len(part["high"])
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([part["block"]], pa.int64()),
                    "bucket": pa.array([part["bucket"]], pa.int32()),
                    "codes": [answer[at : at + n].tobytes()],
                }
            )
            at += n

    asked = blocks.mapInArrow(
        sent, "bucket int, block long, low binary, high binary, counts binary"
    )
    answers = together(asked, buckets).mapInArrow(
        answered, "block long, bucket int, codes binary"
    )
    return B.to_blocks(answers, "answers")


def block_tokens(block: B.Block, marks: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a block, and how many different sets of it have each."""
    sets = dict(zip(marks, shingles(block.data, block.starts, block.sizes, words), strict=True))
    tokens, counts = np.unique(np.concatenate(list(sets.values())), return_counts=True)
    return tokens, np.minimum(counts, 65_535).astype(np.uint16)


def _candidates(
    blocks: DataFrame, answers: DataFrame, chosen: DataFrame, words: int, percent: int, buckets: int
) -> DataFrame:
    """(key, n, copies, prefix, members) of the sets that may be similar to another.

    n-grams are ordered by frequency, then hash. Two similar sets of which one has n
    members share one of the first n - needed(n) + 1 of each. N-grams of one text are
    left out, and sets that have none left in their prefix.
    """

    def found(batches):
        for batch in batches:
            for block, rest in B.unpack(batch):
                tokens, _ = block_tokens(block, rest["marks"], words)
                order, _ = B.split(tokens, buckets)
                codes = np.zeros(len(tokens), np.uint8)
                replies = sorted(rest["answers"] or [], key=lambda a: a["bucket"])
                codes[order] = np.frombuffer(b"".join(a["codes"] for a in replies), np.uint8)
                sets = shingles(block.data, block.starts, block.sizes, words)
                out = {name: [] for name in ("key", "n", "copies", "prefix", "members")}
                for owner in rest["owners"] or []:
                    members = sets[owner["row"]]
                    n = len(members)
                    code = codes[np.searchsorted(tokens, members)]
                    first = np.lexsort((members, code))[: n - needed(n, percent) + 1]
                    prefix = members[first[code[first] > 0]]
                    if len(prefix):
                        out["key"].append(int(block.keys[owner["row"]]))
                        out["n"].append(n)
                        out["copies"].append(owner["copies"])
                        out["prefix"].append(prefix.tobytes())
                        out["members"].append(members[code > 0].tobytes())
                yield pa.RecordBatch.from_pydict(out, schema=_CANDIDATE)

    return stored(
        blocks.join(answers, "block")
        .join(chosen, "block")
        .mapInArrow(found, "key long, n long, copies long, prefix binary, members binary"),
        "candidates",
    )


_CANDIDATE = pa.schema(
    [
        ("key", pa.int64()),
        ("n", pa.int64()),
        ("copies", pa.int64()),
        ("prefix", pa.binary()),
        ("members", pa.binary()),
    ]
)


def _families(candidates: DataFrame, percent: int, buckets: int) -> DataFrame:
    """(key, family): sets that share n-grams of their prefixes, directly or by others.

    An index list joins neighbours in order of size if their sizes allow similarity. A
    bucket joins the lists of its n-grams and gives one edge for each set at most.
    """

    def sent(batches):
        for batch in batches:
            rows = batch.to_pylist()
            if not rows:
                continue
            sizes = [len(r["prefix"]) // 8 for r in rows]
            tokens = np.frombuffer(b"".join(r["prefix"] for r in rows), np.uint64)
            keys = np.repeat(np.array([r["key"] for r in rows], np.int64), sizes)
            n = np.repeat(np.array([r["n"] for r in rows], np.int64), sizes)
            order, cuts = B.split(tokens, buckets)
            for bucket in np.flatnonzero(np.diff(cuts)):
                part = order[cuts[bucket] : cuts[bucket + 1]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([bucket], pa.int32()),
                        "tokens": [tokens[part].tobytes()],
                        "keys": [keys[part].tobytes()],
                        "n": [n[part].tobytes()],
                    }
                )

    def joined(batches):
        return B.each_bucket(batches, of_bucket)

    def of_bucket(parts):
        tokens = np.frombuffer(b"".join(p["tokens"] for p in parts), np.uint64)
        keys = np.frombuffer(b"".join(p["keys"] for p in parts), np.int64)
        n = np.frombuffer(b"".join(p["n"] for p in parts), np.int64)
        order = np.lexsort((keys, n, tokens))
        tokens, keys, n = tokens[order], keys[order], n[order]
        near = (tokens[1:] == tokens[:-1]) & (n[:-1] >= needed(n[1:], percent))
        names, number = np.unique(keys, return_inverse=True)
        forest = Forest(len(names))
        at = np.flatnonzero(near)
        pairs = np.unique(np.stack((number[at], number[at + 1]), 1), axis=0)
        for i, j in pairs.tolist():
            forest.join(i, j)
        roots = np.array([forest.root(i) for i in range(len(names))], np.int64)
        moved = roots != np.arange(len(names))
        yield pa.RecordBatch.from_pydict({"a": names[moved], "b": names[roots[moved]]})

    asked = candidates.select("key", "n", "prefix").mapInArrow(
        sent, "bucket int, tokens binary, keys binary, n binary"
    )
    edges = together(asked, buckets).mapInArrow(joined, "a long, b long")
    return components(edges).select(F.col("node").alias("key"), F.col("root").alias("family"))


def _links(
    candidates: DataFrame, families: DataFrame, percent: int, limit: int
) -> DataFrame:
    """(a, b, links): edges that join the similar sets, and links to count for a.

    A family of up to ``limit`` sets is compared in one task. Larger ones are divided into
    bands of sizes, each as wide as similar sets may differ, and these by hash into parts of
    about ``limit`` sets. There is a task for every two parts of a band, and of neighbouring
    bands; sets of bands further apart can't be similar and never meet.
    """
    # A row for each large family, and for each of its bands: short tables, stored so that
    # Spark knows their size and the sets of a family need not meet to be divided.
    sets = families.groupBy("family").agg(F.count(F.lit(1)).alias("sets"))
    large = stored(sets.filter(F.col("sets") > limit), "large-families")
    marked = families.join(large, "family", "left")
    # A little wider, so that rounding can't part sets of just allowed sizes.
    width = math.log(100 / percent * (1 + 1e-6))
    sized = (
        marked.filter(F.col("sets").isNotNull())
        .join(candidates.select("key", "n"), "key")
        .select("key", "family", F.floor(F.log("n") / width).cast("long").alias("band"))
    )
    parts = F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("parts")
    bands = sized.groupBy("family", "band").agg(parts)
    # The parts of a band itself and of the two beside it.
    near = stored(
        bands.select(
            "family",
            F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
            F.struct(F.col("band").alias("of"), "parts").alias("beside"),
        )
        .groupBy("family", "band")
        .agg(F.collect_list("beside").alias("beside"))
        .join(bands, ["family", "band"]),
        "bands",
    )
    divided = sized.join(near, ["family", "band"]).withColumn(
        "part", F.pmod(F.xxhash64("key"), "parts") + F.col("band") * (1 << 32)
    )
    others = F.flatten(
        F.transform(
            "beside",
            lambda b: F.transform(
                F.sequence(F.lit(0).cast("long"), b["parts"].cast("long") - 1),
                lambda p: F.struct(
                    F.least("part", p + b["of"] * (1 << 32)).alias("i"),
                    F.greatest("part", p + b["of"] * (1 << 32)).alias("j"),
                ),
            ),
        )
    )
    divided = divided.withColumn("task", F.explode(others)).select(
        "key", "part", "family", "task.i", "task.j"
    )
    none = F.lit(0).cast("long")
    placed = (
        marked.filter(F.col("sets").isNull())
        .select("key", none.alias("part"), "family", none.alias("i"), none.alias("j"))
        .unionByName(divided)
    )

    def compared(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        rows = table.to_pydict()
        sets = [np.frombuffer(m, np.uint64) for m in rows["members"]]
        keys, copies = np.array(rows["key"], np.int64), np.array(rows["copies"], np.int64)
        part = np.array(rows["part"], np.int64)
        # Pairs inside a part belong to the task of that part alone.
        across = rows["i"][0] != rows["j"][0]
        links, label = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for i, others in similar_sets(sets, np.array(rows["n"], np.int64), part, across, percent):
            links[i] += copies[others].sum()
            links[others] += copies[i]
            joined = np.unique(np.append(label[others], label[i]))
            for old in joined[1:]:
                label[label == old] = joined[0]
        linked = np.flatnonzero(links)
        return pa.table({"a": keys[linked], "b": keys[label[linked]], "links": links[linked]})

    return (
        candidates.drop("prefix")
        .join(placed, "key")
        .groupBy("family", "i", "j")
        .applyInArrow(compared, "a long, b long, links long")
    )


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    limit: int = TOGETHER,
) -> DataFrame:
    """Link documents whose sets of word n-grams have a Jaccard similarity of ``percent``.

    A document's set are its distinct n-grams of ``words`` words, A-Z taken as a-z; with
    fewer words the whole sequence is the one n-gram. Documents without words are linked
    with nothing; a null text has no words. N-grams are compared by 64-bit hashes.

    1. Texts are packed into blocks, and equal sets into classes: only the first row of
       a class is compared, its copies share what it finds.
    2. n-grams are counted over all documents. Sets are indexed by their rarest n-grams:
       similar ones share one of those, so that a passage in many documents only
       indexes documents that consist of it.
    3. Sets joined by index lists form families; each is compared in full by index
       lists that are skipped by position, with overlaps derived from set to set (see
       ``similar_sets``). Large families are cut into parts.
    4. Links are joined to components.

    Repeated rows are documents of their own. Null ids are not taken as component ids, so
    that a component of them only has a null id. An empty table gives an empty result.
    Other columns are ignored. Ids must be integers. Runs jobs.

    Result, a row for each input row: id, n_shingles, component_id (smallest id that
    links reach), component (the same for null ids too), n_links (other documents that
    are linked directly), first (one row of each component: that with the smallest id,
    null ids last).
    """

    def marks(texts: list[bytes]) -> tuple[list[bytes], list[int]]:
        sizes = np.array([len(t) for t in texts], np.int64)
        sets = shingles(b"".join(texts), np.cumsum(sizes) - sizes, sizes, words)
        return (
            [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
            [len(s) for s in sets],
        )

    blocks = B.build(docs, id_col, text_col, "shingle-blocks", marks)
    buckets = B.buckets_of(blocks)
    texts = stored(B.rows(blocks), "texts")
    worded = texts.filter("count > 0")
    classes = stored(
        worded.groupBy("mark").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("owner"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    chosen = B.to_blocks(
        classes.select(
            B.of_block("owner.key").alias("block"),
            F.col("owner.key").bitwiseAND(F.lit((1 << B.ROW_BITS) - 1)).cast("int").alias("row"),
            "copies",
        ),
        "owners",
    )
    answers = _frequencies(blocks, words, buckets)
    candidates = _candidates(blocks, answers, chosen, words, percent, buckets)
    families = _families(candidates, percent, buckets)
    links = stored(_links(candidates, families, percent, limit), "links")
    roots = components(links.select("a", "b"))
    counted = links.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    owner = classes.select("owner.*", "copies")
    members = roots.select(F.col("node").alias("key"), "root").join(owner, "key")
    least = members.groupBy("root").agg(F.min(F.struct("none", "id", "key")).alias("least"))
    found = (
        members.select("key", "root")
        .join(least, "root")
        .join(counted, "key", "left")
        .select("key", "least", "links")
    )
    of_class = (
        classes.withColumn("key", F.col("owner.key"))
        .join(found, "key", "left")
        .select(
            "mark",
            F.coalesce("least", "owner").alias("least"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    alone = texts.filter("count = 0").select(
        "key",
        "id",
        "count",
        F.col("id").alias("component_id"),
        F.col("key").alias("component"),
        F.lit(0).cast("long").alias("n_links"),
    )
    linked = worded.join(of_class, "mark").select(
        "key",
        "id",
        "count",
        F.col("least.id").alias("component_id"),
        F.col("least.key").alias("component"),
        "n_links",
    )
    kind = docs.schema[id_col].dataType
    return linked.unionByName(alone).select(
        F.col("id").cast(kind).alias(id_col),
        F.col("count").alias("n_shingles"),
        F.col("component_id").cast(kind).alias("component_id"),
        "component",
        "n_links",
        (F.col("key") == F.col("component")).alias("first"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of each component, with all its columns.

    Null ids come last; of equal ids the row that was read first stays. Runs jobs, one of
    which stores the documents with row numbers.
    """
    documents = numbered(docs, "documents")
    texts = documents.select("row", F.col("doc")[text_col].alias("text"))
    found = similar_documents(texts, "row").select("row", "component")
    names = documents.select("row", F.col("doc")[id_col].alias("id"))
    kept = (
        found.join(names, "row")
        .groupBy("component")
        .agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
        .select("first.row")
    )
    return rows_in(documents, kept)
