"""Remove passages of words that occur anywhere else."""

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
from cohort_engine.llm.words import word_hashes, word_spans

LENGTH = 35
GRAM = 12
# Passages in one reference shard; bounds the size of an automaton.
SHARD = 1_000


class Automaton:
    """Suffix automaton of the passages of a reference shard."""

    def __init__(self):
        self.next, self.link, self.length, self.count = [{}], [-1], [0], [0]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, at: int, symbol: int, target: int) -> int:
        """The state of just the strings that reach ``target`` from ``at``."""
        if self.length[target] == self.length[at] + 1:
            return target
        clone = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while at >= 0 and self.next[at].get(symbol) == target:
            self.next[at][symbol] = clone
            at = self.link[at]
        return clone

    def add(self, passage: list[int], times: int) -> None:
        """Add a passage that occurs ``times`` times."""
        last = 0
        for symbol in passage:
            known = self.next[last].get(symbol)
            if known is not None:
                last = self._split(last, symbol, known)
            else:
                new, at = self._state(self.length[last] + 1, 0, {}), last
                while at >= 0 and symbol not in self.next[at]:
                    self.next[at][symbol] = new
                    at = self.link[at]
                if at >= 0:
                    self.link[new] = self._split(at, symbol, self.next[at][symbol])
                last = new
            self.count[last] += times

    def finish(self) -> None:
        """Let each state count all places its strings end at."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def occurrences(self, passage: list[int], length: int) -> list[int]:
        """How often the last ``length`` symbols occur, at each end of a whole window.

        The matching statistic at a place is the longest string that ends there and
        occurs in the shard; it is followed up to ``length`` symbols.
        """
        state = matched = 0
        out = []
        for i, symbol in enumerate(passage, 1):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                matched += 1
            while state and self.length[self.link[state]] >= length:
                state = self.link[state]
                matched = min(matched, self.length[state])
            if i >= length:
                out.append(self.count[state] if matched >= length else 0)
        return out


def repeated_windows(passages: list[bytes], length: int, shard: int = SHARD) -> list[np.ndarray]:
    """For each passage (bytes of 64-bit symbols) whether its windows occur twice or more.

    The passages are cut into reference shards. All passages are streamed through the
    automaton of each shard, and the numbers of occurrences added up.
    """
    times: dict[bytes, int] = {}
    for passage in passages:
        times[passage] = times.get(passage, 0) + 1
    distinct = list(times)
    symbols = [np.frombuffer(p, np.uint64).tolist() for p in distinct]
    totals = [np.zeros(max(0, len(s) - length + 1), np.int64) for s in symbols]
    for start in range(0, len(symbols), shard):
        automaton = Automaton()
        for i in range(start, min(start + shard, len(symbols))):
            automaton.add(symbols[i], times[distinct[i]])
        automaton.finish()
        for total, passage in zip(totals, symbols, strict=True):
            total += np.array(automaton.occurrences(passage, length), np.int64)
    found = {p: total > 1 for p, total in zip(distinct, totals, strict=True)}
    return [found[p] for p in passages]


def _words(block: B.Block):
    first, end, number = word_spans(block.data, block.starts, block.sizes)
    return word_hashes(block.data, first, end, False), np.cumsum(number) - number, number


def remove_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    shard: int = SHARD,
    hot_blocks: int = R.HOT_BLOCKS,
    hot_places: int = R.HOT_PLACES,
) -> DataFrame:
    """Remove each word in a run of ``length`` words that also starts anywhere else.

    Words are what stands between white space, unchanged; runs stay inside one text. All
    occurrences go, the first as well. Words are compared by 64-bit hashes. Rows with the
    same id are different documents. A null text has no words; texts with fewer words
    stay whole. An empty table gives an empty result. Other columns are ignored. Ids must
    be integers.

    1. Texts are packed into blocks. A text that occurs in several rows repeats all its
       words; of those rows the first goes on, to be compared with other texts.
    2. Blocks send the anchors of their windows (see ``anchors``) to buckets, which answer
       which occur more than once, and whether always amid the same words. If so, all
       windows around them repeat, which needs no further look.
    3. The passages around the others are sent to buckets by anchor: all equal windows
       meet. They are cut into reference shards of ``shard`` passages. The suffix
       automaton of each is built, all passages of the anchor are streamed through it,
       and windows that occur twice or more are reported.
    4. The windows of an anchor in more than ``hot_blocks`` blocks or ``hot_places`` places
       are told apart by 128 bits of hashes instead, and dealt by those, the first of each
       block: no anchor, however frequent, gathers more than ``hot_places`` passages in
       one task.

    The automata are not broadcast to all tasks: their number grows with the corpus, and
    each document would have to be streamed through each. A passage meets those only that
    can hold its anchor.

    Runs a job that stores blocks, and one for what is to be removed. Result, a row for
    each input row: id, n_words, n_removed, kept_sha256, and removed spans (words from 0,
    end exclusive).
    """
    R.check_lengths(length, gram)
    blocks = B.build(docs, id_col, text_col, "passage-blocks")
    buckets = B.buckets_of(blocks)
    owned = stored(R.owners(blocks), "owners")
    windows = R.Windows(_words, length, gram)
    answers = stored(
        B.to_blocks(
            R.anchor_states(blocks, windows, buckets, hot_blocks, hot_places), "answers"
        ),
        "anchor-states",
    )

    def analysed(block, rest):
        """Runs and their states, and the windows of hot anchors, of texts that go on."""
        runs = windows.of(block, rest["marks"])
        state = R.run_states(runs, rest["answers"] or [], buckets)
        first, copies = R.owner_arrays(rest["owners"] or [], len(block.ids))
        own = first[runs.text]
        runs, state = runs.take(own), state[own]
        symbols, starts, _ = _words(block)
        hot = state == R.HOT
        known = R.known_runs(block, symbols, runs.take(hot), state[hot], length)
        return runs, state, known, symbols, starts, copies

    def asked(batches):
        for batch in batches:
            for block, rest in B.unpack(batch):
                runs, state, known, symbols, starts, _ = analysed(block, rest)
                runs = runs.take(state == R.MIXED)
                sent = np.flatnonzero(known.first)
                keys = np.concatenate((known.key[sent], runs.gram))
                other = np.concatenate((known.other[sent], np.zeros_like(runs.gram)))
                text = np.concatenate((known.text[sent], runs.text))
                low = np.concatenate((known.at[sent], runs.low))
                size = np.concatenate(
                    (np.zeros(len(sent), np.int64), runs.high + length - runs.low)
                )
                order, cuts = B.split(keys, buckets)
                for bucket in np.flatnonzero(np.diff(cuts)):
                    part = order[cuts[bucket] : cuts[bucket + 1]]
                    passages = zip(low[part].tolist(), size[part].tolist(), strict=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array([bucket], pa.int32()),
                            "grams": [keys[part].tobytes()],
                            "other": [other[part].tobytes()],
                            "keys": [block.keys[text[part]].tobytes()],
                            "low": [(low[part] - starts[text[part]]).tobytes()],
                            "size": [size[part].tobytes()],
                            "symbols": [
                                b"".join(symbols[a : a + n].tobytes() for a, n in passages)
                            ],
                        }
                    )

    def resolved(batches):
        return B.each_bucket(batches, of_bucket)

    def of_bucket(parts):
        grams, other = (
            np.frombuffer(b"".join(p[n] for p in parts), np.uint64) for n in ("grams", "other")
        )
        keys, low, size = (
            np.frombuffer(b"".join(p[n] for p in parts), np.int64) for n in ("keys", "low", "size")
        )
        symbols = b"".join(p["symbols"] for p in parts)
        del parts
        end = 8 * np.cumsum(size)
        begin = end - 8 * size
        which, lows, highs = [], [], []
        order = np.lexsort((other, grams))
        hot = order[size[order] == 0]
        if len(hot):
            same = (grams[hot[1:]] == grams[hot[:-1]]) & (other[hot[1:]] == other[hot[:-1]])
            found = hot[np.append(False, same) | np.append(same, False)]
            which, lows = found.tolist(), low[found].tolist()
            highs = (low[found] + length).tolist()
        order = order[size[order] > 0]
        cuts = np.flatnonzero(np.append(True, grams[order[1:]] != grams[order[:-1]]))
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
            if b - a < 2:
                continue
            group = order[a:b].tolist()
            passages = [symbols[begin[i] : end[i]] for i in group]
            for i, found in zip(group, repeated_windows(passages, length, shard), strict=True):
                at = np.flatnonzero(found)
                if len(at):
                    new = np.flatnonzero(np.append(True, np.diff(at) != 1))
                    which += [i] * len(new)
                    lows += (at[new] + low[i]).tolist()
                    highs += (at[np.append(new[1:], len(at)) - 1] + low[i] + length).tolist()
        if which:
            yield from R.interval_rows(keys[which], np.array(lows), np.array(highs))

    removed = R.together(
        blocks.join(answers, "block", "left")
        .join(owned, "block")
        .mapInArrow(
            asked,
            "bucket int, grams binary, other binary, keys binary, low binary, size binary,"
            " symbols binary",
        ),
        buckets,
    ).mapInArrow(resolved, R.INTERVALS)
    removed = stored(removed, "removed")

    def cut(batches):
        for batch in batches:
            for block, rest in B.unpack(batch):
                runs, state, known, _, _, copies = analysed(block, rest)
                runs = runs.take(state == R.SAME)
                # Equal windows of hot anchors that are in the block twice.
                twice = np.flatnonzero(~known.alone)
                first, end, number = word_spans(block.data, block.starts, block.sizes)
                begins = np.cumsum(number) - number
                rows, lows, highs = R.intervals_of(rest["removed"] or [])
                text = np.concatenate((runs.text, known.text[twice]))
                low = np.concatenate((runs.low, known.at[twice]))
                high = np.concatenate((runs.high, known.at[twice]))
                rows = np.concatenate((rows, text))
                lows = np.concatenate((lows, low - begins[text]))
                highs = np.concatenate((highs, high - begins[text] + length))
                order = np.argsort(rows, kind="stable")
                rows, lows, highs = rows[order], lows[order], highs[order]
                bounds = np.searchsorted(rows, np.arange(len(block.ids) + 1))
                out = {n: [] for n in ("id", "n_words", "n_removed", "kept_sha256", "spans")}
                for i, words in enumerate(number.tolist()):
                    part = slice(bounds[i], bounds[i + 1])
                    low, high = covered(lows[part], highs[part])
                    if copies[i] > 1 and words >= length:
                        low, high = np.array([0]), np.array([words])
                    kept, at = [], 0
                    for a, b in [*zip(low.tolist(), high.tolist(), strict=True), (words, words)]:
                        if at < a:
                            stretch = slice(first[begins[i] + at], end[begins[i] + a - 1])
                            kept += block.data[stretch].split()
                        at = b
                    out["id"].append(None if block.ids[i] == B.NULL_ID else int(block.ids[i]))
                    out["n_words"].append(words)
                    out["n_removed"].append(words - len(kept))
                    out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
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
            "id long, n_words long, n_removed long, kept_sha256 string,"
            " spans array<struct<start: bigint, end: bigint>>",
        )
        .withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))
        .withColumnRenamed("id", id_col)
    )


_RESULT = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
