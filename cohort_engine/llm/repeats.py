"""Which anchors of windows occur more than once, and what blocks ask and answer."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm import blocks as B
from cohort_engine.llm.anchors import Runs, mixed, runs
from cohort_engine.llm.common import stored

# What is known of an anchor: it occurs once; more often, always amid the same symbols;
# more often, amid different ones; or so, in very many places.
SINGLE, SAME, MIXED, HOT = 0, 1, 2, 3

# An anchor in more blocks or places than these is hot. What surrounds it is not gathered
# in one task: its windows are told apart by hashes, and dealt by those.
HOT_BLOCKS = 1_000
HOT_PLACES = 10_000

# symbols (uint64), start and number of symbols of each text of a block
Symbols = Callable[[B.Block], tuple[np.ndarray, np.ndarray, np.ndarray]]


class Windows:
    """Runs of all windows of a block, by the symbols and lengths of an operator."""

    def __init__(self, symbols: Symbols, window: int, gram: int):
        self.symbols, self.window, self.gram = symbols, window, gram

    def of(self, block: B.Block, marks: list[bytes]) -> Runs:
        """Runs of the block's texts, of equal ones those of the first."""
        found = runs(*self.symbols(block), self.window, self.gram)
        seen, first = set(), np.zeros(len(marks), bool)
        for i, mark in enumerate(marks):
            first[i] = mark not in seen
            seen.add(mark)
        return found.take(first[found.text])


def _summary(found: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams in ascending order, the hash of the symbols around, state, places."""
    order = np.lexsort((found.whole, found.gram))
    grams, wholes = found.gram[order], found.whole[order]
    if not len(grams):
        return grams, wholes, np.zeros(0, np.uint8), np.zeros(0, np.int32)
    begin = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    last = np.append(begin[1:], len(grams)) - 1
    state = np.where(wholes[begin] != wholes[last], MIXED, np.where(begin == last, SINGLE, SAME))
    places = (last - begin + 1).astype(np.int32)
    return grams[begin], wholes[begin], state.astype(np.uint8), places


# Longer windows than this don't fit in the stretches that anchors are sought in.
MAX_WINDOW = 1 << 15


def check_lengths(window: int, gram: int) -> None:
    if not 1 <= gram <= window <= MAX_WINDOW:
        raise ValueError(f"1 <= {gram} (gram) <= {window} (window) <= {MAX_WINDOW} does not hold")


def together(df: DataFrame, buckets: int) -> DataFrame:
    """Rows of a bucket in one partition, one bucket after the other."""
    partitions = B.partitions_of(df.sparkSession)
    if buckets <= partitions:
        return df.repartitionById(buckets, F.col("bucket"))
    return df.repartitionById(
        partitions, F.pmod("bucket", F.lit(partitions))
    ).sortWithinPartitions("bucket")


def anchor_states(
    blocks: DataFrame,
    windows: Windows,
    buckets: int,
    hot_blocks: int = HOT_BLOCKS,
    hot_places: int = HOT_PLACES,
) -> DataFrame:
    """(block, bucket, states): a byte for each distinct anchor a block sent to a bucket.

    A block sends each of its distinct anchors once, with the number of its places there.
    An answer thus gathers a few bytes for each block at most.
    """

    def sent(batches):
        for batch in batches:
            for block, rest in B.unpack(batch):
                grams, wholes, states, places = _summary(windows.of(block, rest["marks"]))
                order, cuts = B.split(grams, buckets)
                for bucket in np.flatnonzero(np.diff(cuts)):
                    part = order[cuts[bucket] : cuts[bucket + 1]]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array([bucket], pa.int32()),
                            "block": pa.array([block.number], pa.int64()),
                            "grams": [grams[part].tobytes()],
                            "wholes": [wholes[part].tobytes()],
                            "states": [states[part].tobytes()],
                            "places": [places[part].tobytes()],
                        }
                    )

    def answered(batches):
        return B.each_bucket(batches, of_bucket)

    def of_bucket(parts):
        grams = np.frombuffer(b"".join(p["grams"] for p in parts), np.uint64)
        wholes = np.frombuffer(b"".join(p["wholes"] for p in parts), np.uint64)
        states = np.frombuffer(b"".join(p["states"] for p in parts), np.uint8)
        places = np.frombuffer(b"".join(p["places"] for p in parts), np.int32)
        order = np.argsort(grams)
        sorted_grams = grams[order]
        begin = np.flatnonzero(np.append(True, sorted_grams[1:] != sorted_grams[:-1]))
        sizes = np.diff(np.append(begin, len(grams)))
        differ = np.minimum.reduceat(wholes[order], begin) != np.maximum.reduceat(
            wholes[order], begin
        )
        state = np.maximum.reduceat(states[order], begin)
        state = np.where(differ, MIXED, np.where(sizes > 1, np.maximum(state, SAME), state))
        total = np.add.reduceat(places[order], begin, dtype=np.int64)
        many = (sizes > hot_blocks) | (total > hot_places)
        state = np.where((state == MIXED) & many, HOT, state)
        answer = np.empty(len(grams), np.uint8)
        answer[order] = np.repeat(state, sizes)
        at = 0
        for part in parts:
            n = len(part["states"])
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([part["block"]], pa.int64()),
                    "bucket": pa.array([part["bucket"]], pa.int32()),
                    "states": [answer[at : at + n].tobytes()],
                }
            )
            at += n

    return together(
        blocks.mapInArrow(
            sent,
            "bucket int, block long, grams binary, wholes binary, states binary, places binary",
        ),
        buckets,
    ).mapInArrow(answered, "block long, bucket int, states binary")


def run_states(found: Runs, answers: list[dict], buckets: int) -> np.ndarray:
    """The state of each run's anchor, from the answers to a block."""
    grams, _, _, _ = _summary(found)
    order, _ = B.split(grams, buckets)
    state = np.zeros(len(grams), np.uint8)
    if len(grams):
        sent = b"".join(a["states"] for a in sorted(answers, key=lambda a: a["bucket"]))
        state[order] = np.frombuffer(sent, np.uint8)
    return state[np.searchsorted(grams, found.gram)]


def window_keys(
    symbols: np.ndarray, places: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the windows that start at the places."""
    one = np.zeros(len(places), np.uint64)
    two = np.zeros(len(places), np.uint64)
    for k in range(window):
        symbol = symbols[places + k]
        one = one * np.uint64(0xD1342543DE82EF95) + symbol
        two = two * np.uint64(0xAF251AF3B0F025B5) + mixed(symbol)
    return mixed(one), mixed(two)


@dataclass
class Known:
    """Runs of equal windows, told apart by two hashes, in the order of texts.

    The run of the anchor at ``at`` starts ``before`` to ``after`` symbols before it.
    ``first`` is set for the first of equal runs of the block.
    """

    key: np.ndarray
    other: np.ndarray
    text: np.ndarray
    at: np.ndarray
    before: np.ndarray
    after: np.ndarray
    first: np.ndarray
    alone: np.ndarray


def known_runs(
    block: B.Block, symbols: np.ndarray, found: Runs, state: np.ndarray, window: int
) -> Known:
    """Runs around anchors that are the same everywhere, and all windows of hot anchors."""
    same, hot = found.take(state == SAME), found.take(state == HOT)
    counts = hot.high - hot.low + 1
    places = np.repeat(hot.low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    one, two = window_keys(symbols, places, window)
    none = np.zeros(len(places), np.int64)
    key, other = np.concatenate((same.gram, one)), np.concatenate((same.whole, two))
    text = np.concatenate((same.text, np.repeat(hot.text, counts)))
    at = np.concatenate((same.at, places))
    before = np.concatenate((same.at - same.low, none))
    after = np.concatenate((same.at - same.high, none))
    order = np.lexsort((at, text, block.ids[text], other, key))
    first = np.ones(len(key), bool)
    k, o = key[order], other[order]
    first[order[1:]] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    begins = first[order]
    ends = np.append(begins[1:], True) if len(order) else begins
    alone = np.zeros(len(key), bool)
    alone[order] = begins & ends
    return Known(key, other, text, at, before, after, first, alone)


def owners(blocks: DataFrame) -> DataFrame:
    """For each block the (row, copies, first) of its texts: ``first`` of equal ones.

    The groups are stored, so that the join with them shuffles both sides itself and a
    group with very many rows is split. Runs that job.
    """
    texts = B.rows(blocks)
    groups = stored(B.first_of_equals(texts), "groups")
    return B.to_blocks(
        texts.join(groups, "mark").select(
            B.of_block("key").alias("block"),
            F.col("key").bitwiseAND(F.lit((1 << B.ROW_BITS) - 1)).cast("int").alias("row"),
            "copies",
            (F.col("key") == F.col("owner.key")).alias("first"),
        ),
        "owners",
    )


def owner_arrays(found: list[dict], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, copies) of the texts of a block."""
    first, copies = np.zeros(n, bool), np.ones(n, np.int64)
    for row in found:
        first[row["row"]], copies[row["row"]] = row["first"], row["copies"]
    return first, copies


def intervals_to_blocks(df: DataFrame) -> DataFrame:
    """Rows (block, rows, lows, highs: packed arrays of int64) as one array for a block."""
    return B.to_blocks(df, "removed")


def interval_rows(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row of packed intervals for each block among the row keys."""
    if not len(keys):
        return
    order = np.lexsort((low, keys))
    keys, low, high = keys[order], low[order], high[order]
    number = keys >> B.ROW_BITS
    cuts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    for first, last in zip(cuts, [*cuts[1:], len(keys)], strict=True):
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([int(number[first])], pa.int64()),
                "rows": [(keys[first:last] & ((1 << B.ROW_BITS) - 1)).tobytes()],
                "lows": [low[first:last].tobytes()],
                "highs": [high[first:last].tobytes()],
            }
        )


INTERVALS = "block long, rows binary, lows binary, highs binary"


def intervals_of(answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, lows, highs) of all intervals that a block was sent."""
    joined = [b"".join(a[n] for a in answers) for n in ("rows", "lows", "highs")]
    return tuple(np.frombuffer(j, np.int64) for j in joined)
