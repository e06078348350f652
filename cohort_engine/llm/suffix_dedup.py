"""Remove stretches of bytes that occur earlier in the corpus."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm import blocks as B
from cohort_engine.llm import repeats as R
from cohort_engine.llm.anchors import covered
from cohort_engine.llm.common import stored

LENGTH = 100
GRAM = 32
# Contexts whose suffixes are sorted at once.
AT_ONCE = 20_000

_VALUES = np.random.default_rng(4).integers(1, 1 << 63, 256, dtype=np.uint64)


def _bytes(block: B.Block):
    return _VALUES[np.frombuffer(block.data, np.uint8)], block.starts, block.sizes


def reaches(rank: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor of each suffix reaches a certain length.

    The suffixes are in sorted order, in stretches that share that length; ``first`` marks
    where a stretch begins. The longest prefix that a suffix shares with one of smaller rank
    is shared with the previous or the next place of smaller rank, so that one of these has
    to be in the stretch.

    Previous smaller places are found by pointers that jump over greater ranks, whose own
    pointers skip only greater ones in turn. A place without one is a minimum of all before it
    in the stretch; its next smaller place is the next such minimum.
    """
    place = np.arange(len(rank)) - 1
    place[first] = -1
    going = np.flatnonzero(place >= 0)
    while len(going):
        going = going[rank[place[going]] > rank[going]]
        place[going] = place[place[going]]
        going = going[place[going] >= 0]
    least = np.flatnonzero(place < 0)
    stretch = np.cumsum(first)[least]
    found = place >= 0
    found[least[:-1]] = stretch[1:] == stretch[:-1]
    return found


def earlier(contexts: np.ndarray, rank: np.ndarray, low: np.ndarray, high: np.ndarray,
            length: int) -> np.ndarray:
    """Which windows of the contexts have an equal one of smaller rank.

    Row ``i`` of ``contexts`` has its anchor at the same column as all others. Windows
    start at columns ``low[i]`` to ``high[i]``; the answer is true at [i, column].

    Suffixes are sorted from the last column to the first: the order at a column is the
    order of the next, stably sorted by the byte of the column. In each order neighbours
    that share ``length`` bytes stand in stretches; where the longest previous factor of a
    suffix reaches ``length``, an equal window is earlier.
    """
    n, width = contexts.shape
    found = np.zeros((n, width - length + 1), bool)
    order = np.arange(n)
    for column in range(width - 1, -1, -1):
        order = order[np.argsort(contexts[order, column], kind="stable")]
        if column > width - length:
            continue
        here = order[(low[order] <= column) & (column <= high[order])]
        if len(here) < 2:
            continue
        part = contexts[:, column : column + length]
        equal = np.append(False, (part[here[1:]] == part[here[:-1]]).all(axis=1))
        near = equal | np.append(equal[1:], False)
        here, equal = here[near], equal[near]
        if len(here):
            found[here, column] = reaches(rank[here], ~equal)
    return found


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    hot_blocks: int = R.HOT_BLOCKS,
    hot_places: int = R.HOT_PLACES,
) -> DataFrame:
    """Remove each byte that a string of ``length`` bytes covers which starts earlier too.

    Texts are compared as UTF-8 by whole strings inside one text; earlier means a smaller
    id, then the place in the text. Of rows with equal ids the one that was read first
    is the earlier. A null id is smaller than any other. A null text is empty, and texts
    shorter than ``length`` stay whole. ``gram`` is at most ``length``, which is at most
    MAX_WINDOW. An empty table gives an empty result. Other
    columns are ignored. Ids must be integers.

    1. Texts are packed into blocks. Of equal texts only the first goes on; the others
       are removed whole, if long enough, without being compared.
    2. Blocks send the anchors of their windows (see ``anchors``) to buckets, which answer
       which of them occur more than once, and whether always amid the same bytes.
    3. Blocks send the windows around those to buckets by anchor: all equal windows
       meet. There longest-previous-factor arrays, by the previous and next smaller ranks in
       the order of the suffixes, find the later ones.
    4. Where an anchor is always amid the same bytes, its place is sent without them, and
       only the first of a block. So are the single windows of an anchor that is in more
       than ``hot_blocks`` blocks or ``hot_places`` places, by 128 bits of hashes: no
       anchor, however frequent, gathers the windows around more places in one task.
    5. Blocks are sent what is to be removed from their texts.

    Runs a job that stores blocks, and one for what is to be removed. Result, a row for
    each input row: id, n_bytes, n_removed, n_spans, kept_sha256, and the removed spans
    (bytes, end exclusive).
    """
    R.check_lengths(length, gram)
    blocks = B.build(docs, id_col, text_col, "suffix-blocks")
    buckets = B.buckets_of(blocks)
    owned = stored(R.owners(blocks), "owners")
    windows = R.Windows(_bytes, length, gram)
    answers = stored(
        B.to_blocks(
            R.anchor_states(blocks, windows, buckets, hot_blocks, hot_places), "answers"
        ),
        "anchor-states",
    )
    reach = length - gram
    width = length + reach

    def analysed(block, rest):
        """Runs with different surroundings, and the known ones, of texts that go on."""
        runs = windows.of(block, rest["marks"])
        state = R.run_states(runs, rest["answers"] or [], buckets)
        first, _ = R.owner_arrays(rest["owners"] or [], len(block.ids))
        own = first[runs.text]
        runs, state = runs.take(own), state[own]
        known = R.known_runs(block, _bytes(block)[0], runs, state, length)
        return runs.take(state == R.MIXED), known, first

    def asked(batches):
        for batch in batches:
            for block, rest in B.unpack(batch):
                runs, known, _ = analysed(block, rest)
                sent = np.flatnonzero(known.first)
                keys = np.concatenate((known.key[sent], runs.gram))
                other = np.concatenate((known.other[sent], np.zeros_like(runs.gram)))
                text = np.concatenate((known.text[sent], runs.text))
                at = np.concatenate((known.at[sent], runs.at))
                before = np.concatenate((known.before[sent], runs.at - runs.low))
                after = np.concatenate((known.after[sent], runs.at - runs.high))
                mixed = np.arange(len(keys)) >= len(sent)
                order, cuts = B.split(keys, buckets)
                data = np.frombuffer(b"\0" * reach + block.data + b"\0" * length, np.uint8)
                around = np.lib.stride_tricks.sliding_window_view(data, width)
                for bucket in np.flatnonzero(np.diff(cuts)):
                    part = order[cuts[bucket] : cuts[bucket + 1]]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array([bucket], pa.int32()),
                            "grams": [keys[part].tobytes()],
                            "other": [other[part].tobytes()],
                            "ids": [block.ids[text[part]].tobytes()],
                            "keys": [block.keys[text[part]].tobytes()],
                            "at": [(at[part] - block.starts[text[part]]).tobytes()],
                            "low": [before[part].astype(np.int32).tobytes()],
                            "high": [after[part].astype(np.int32).tobytes()],
                            "mixed": [mixed[part].tobytes()],
                            "bytes": [around[at[part][mixed[part]]].tobytes()],
                        }
                    )

    kinds = {
        "grams": np.uint64, "other": np.uint64, "ids": np.int64, "keys": np.int64,
        "at": np.int64, "low": np.int32, "high": np.int32, "mixed": bool, "bytes": np.uint8,
    }

    def resolved(batches):
        return B.each_bucket(batches, of_bucket)

    def of_bucket(parts):
        grams, other, ids, keys, at, before, after, mixed, data = (
            np.frombuffer(b"".join(p[n] for p in parts), kind) for n, kind in kinds.items()
        )
        # The windows of a run start ``before`` to ``after`` bytes before the anchor.
        before, after = before.astype(np.int64), after.astype(np.int64)
        del parts
        contexts = data.reshape(-1, width)
        place = np.cumsum(mixed) - 1
        order = np.lexsort((at, keys, ids, other, grams))
        same = order[~mixed[order]]
        later = np.zeros(len(same), bool)
        later[1:] = (grams[same[1:]] == grams[same[:-1]]) & (
            other[same[1:]] == other[same[:-1]]
        )
        gone = same[later]
        yield from R.interval_rows(
            keys[gone], at[gone] - before[gone], at[gone] - after[gone] + length
        )
        differing = order[mixed[order]]
        ends = np.flatnonzero(np.append(grams[differing[1:]] != grams[differing[:-1]], True)) + 1
        start = 0
        while start < len(differing):
            # Whole groups up to the number at once, at least one.
            stop = ends[max(
                np.searchsorted(ends, start + AT_ONCE, "right") - 1,
                np.searchsorted(ends, start, "right"),
            )]
            some = differing[start:stop]
            found = earlier(
                contexts[place[some]],
                np.arange(len(some)),
                reach - before[some],
                reach - after[some],
                length,
            )
            which, column = np.nonzero(found)
            new = np.ones(len(which), bool)
            new[1:] = (which[1:] != which[:-1]) | (np.diff(column) != 1)
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(which))[: len(begin)] - 1
            which, begin, end = some[which[begin]], column[begin], column[end]
            origin = at[which] - reach
            yield from R.interval_rows(keys[which], origin + begin, origin + end + length)
            start = stop

    removed = R.together(
        blocks.join(answers, "block", "left")
        .join(owned, "block")
        .mapInArrow(
            asked,
            "bucket int, grams binary, other binary, ids binary, keys binary, at binary,"
            " low binary, high binary, mixed binary, bytes binary",
        ),
        buckets,
    ).mapInArrow(resolved, R.INTERVALS)
    removed = stored(removed, "removed")

    def cut(batches):
        for batch in batches:
            for block, rest in B.unpack(batch):
                _, known, first = analysed(block, rest)
                rows, lows, highs = R.intervals_of(rest["removed"] or [])
                # Of equal runs of the block only the first was compared with others.
                later = np.flatnonzero(~known.first)
                text = known.text[later]
                at = known.at[later] - block.starts[text]
                rows = np.concatenate((rows, text))
                lows = np.concatenate((lows, at - known.before[later]))
                highs = np.concatenate((highs, at - known.after[later] + length))
                order = np.argsort(rows, kind="stable")
                rows, lows, highs = rows[order], lows[order], highs[order]
                bounds = np.searchsorted(rows, np.arange(len(block.ids) + 1))
                out = {n: [] for n in ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                                       "spans")}
                for i, size in enumerate(block.sizes.tolist()):
                    part = slice(bounds[i], bounds[i + 1])
                    low, high = covered(lows[part], highs[part])
                    if not first[i] and size >= length:
                        low, high = np.array([0]), np.array([size])
                    text, kept, at = block.text(i), hashlib.sha256(), 0
                    for a, b in zip(low.tolist(), high.tolist(), strict=True):
                        kept.update(text[at:a])
                        at = b
                    kept.update(text[at:])
                    out["id"].append(None if block.ids[i] == B.NULL_ID else int(block.ids[i]))
                    out["n_bytes"].append(size)
                    out["n_removed"].append(int((high - low).sum()))
                    out["n_spans"].append(len(low))
                    out["kept_sha256"].append(kept.hexdigest())
                    out["spans"].append(
                        [{"start": a, "end": b} for a, b in zip(low.tolist(), high.tolist())]
                    )
                yield pa.RecordBatch.from_pydict(out, schema=_RESULT)

    return (
        blocks.join(R.intervals_to_blocks(removed), "block", "left")
        .join(answers, "block", "left")
        .join(owned, "block")
        .mapInArrow(
            cut,
            "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
            " spans array<struct<start: bigint, end: bigint>>",
        )
        .withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))
        .withColumnRenamed("id", id_col)
    )


_RESULT = pa.schema(
    [
        ("id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
