"""Stretches of words that repeat with a period, found in tiles of each period octave.

A run is a stretch of words with smallest period q (words q apart are equal) and at least
``max(MIN_LENGTH, 2 * q)`` words that no neighbouring word extends. Texts of less than
8 * ``TILE`` characters are one tile. Longer ones become rows of overlapping tiles, those of an
octave of periods from P to 2P - 1 being a few P long; tasks solve tiles on their own, a
shuffle by text and period joins the fragments of a run that crosses tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_engine.llm.common import chunks, let, text_of, words_of

MIN_LENGTH = 12
# Words of a tile at least.
TILE = 4096
# A tile has the length of this many smallest periods of its octave; neighbours share half.
PERIODS = 8

_FIELDS = ("start", "length", "period")
RUNS = T.ArrayType(T.StructType([T.StructField(f, T.LongType()) for f in _FIELDS]))
_FRAGMENTS = "key binary, period long, start long, stop long"
_TILES = "key binary, n_words long, first long, low long, high long, codes binary"


# ---------------------------------------------------------------- within a tile


def _gram_names(words: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Of each level k and place, a name of the 2^k words from there.

    Two places within a tile have the same name if and only if these words are equal. Grams
    that occur once in their tile get negative names and are not looked at again, so that
    the levels over plain prose cost next to nothing. ``ends`` is the tile's end at each place.
    """
    n = len(words)
    alone = -np.arange(1, n + 1, dtype=np.int32)
    names: list[np.ndarray] = []
    places = np.arange(n)
    key = ends * np.int64(int(words.max(initial=0)) + 1) + words
    while len(places):
        _, named, counts = np.unique(key, return_inverse=True, return_counts=True)
        again = counts[named] > 1
        level = alone.copy()
        level[places[again]] = named[again]
        names.append(level)
        half = 1 << (len(names) - 1)
        places = places[again]
        places = places[places + 2 * half <= ends[places]]
        places = places[level[places + half] >= 0]
        key = level[places].astype(np.int64) * n + level[places + half]
    return names


def _boundary_z(
    names: list[np.ndarray], at: np.ndarray, other: np.ndarray, starts, ends
) -> tuple[np.ndarray, np.ndarray]:
    """Z-functions at boundaries: how many words agree onwards, and backwards.

    Onwards from ``at`` and ``other`` (the later one), within the tile, and backwards from
    the words before them. Each level of names is tried once, from the longest.
    """
    last = len(starts) - 1
    onwards, backwards = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    low, high = starts[at], ends[at]
    for level in range(len(names) - 1, -1, -1):
        size, name = 1 << level, names[level]
        equal = name[np.minimum(at + onwards, last)] == name[np.minimum(other + onwards, last)]
        onwards += size * (equal & (other + onwards + size <= high))
        left = at - backwards - size
        equal = name[np.maximum(left, 0)] == name[np.maximum(other - backwards - size, 0)]
        backwards += size * (equal & (left >= low))
    return onwards, backwards


def _distinct(columns: np.ndarray) -> np.ndarray:
    """The columns sorted, each once."""
    columns = columns[:, np.lexsort(columns[::-1])]
    new = np.ones(columns.shape[1], bool)
    new[1:] = (columns[:, 1:] != columns[:, :-1]).any(axis=0)
    return columns[:, new]


def tile_fragments(
    words: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: int, high: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, start, stop) of stretches where words a period in [low, high) apart agree.

    ``words`` holds tiles end to end; ``starts`` and ``ends`` give each place's tile. A run
    is the stretch and the period that follows it. It agrees over at least
    max(MIN_LENGTH - q, q) places, so that one of the evenly spaced boundaries lies in it
    with all of a gram to its right; from there the Z-functions give its ends. Multiples of
    a period are among the results.
    """
    names = _gram_names(words, ends)
    found = [np.zeros((3, 0), np.int64)]
    octave, longest = 1, int((ends - starts).max(initial=0))
    while octave < high and octave <= longest:
        small = octave < 8
        periods = np.arange(max(low, octave), min(high, 8 if small else 2 * octave))
        octave = 8 if small else 2 * octave
        gram = 4 if small else octave // 4
        # A boundary in each stretch that leaves room for a gram.
        spacing = 3 if small else gram + 1
        level = gram.bit_length() - 1
        if not len(periods):
            continue
        if level >= len(names):
            break
        name = names[level]
        at = np.arange(0, len(words), spacing)
        at = at[name[at] >= 0]
        # In slices, so that pairs of a boundary and a period are bounded.
        step = max(1, (1 << 20) // len(periods))
        for first in range(0, len(at), step):
            here = np.repeat(at[first : first + step], len(periods))
            there = here + np.tile(periods, len(at[first : first + step]))
            fits = there + gram <= ends[here]
            here, there = here[fits], there[fits]
            same = name[here] == name[there]
            here, there = here[same], there[same]
            if not len(here):
                continue
            onwards, backwards = _boundary_z(names, here, there, starts, ends)
            found.append(_distinct(np.stack([there - here, here - backwards, here + onwards])))
    return tuple(_distinct(np.concatenate(found, axis=1)))


def _whole_runs(words: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(start, length, period) of all runs of tiles that are whole texts, by start."""
    period, start, stop = tile_fragments(words, starts, ends, 1, len(words) + 1)
    length = stop + period - start
    long = length >= np.maximum(MIN_LENGTH, 2 * period)
    period, start, length = period[long], start[long], length[long]
    order = np.lexsort((period, length, start))
    period, start, length = period[order], start[order], length[order]
    # A stretch has its smallest period, not multiples of it.
    least = np.ones(len(order), bool)
    least[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, period = start[least], length[least], period[least]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _coded(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by a space, of each run only its first period."""
    if not runs:
        return b" ".join(words).decode()
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    return b" ".join([words[i] for i in kept]).decode()


# ---------------------------------------------------------------- texts of one tile


def _solve_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in chunks([batch], "text"):
            texts = [t.encode().split() for t in piece.column("text").to_pylist()]
            sizes = np.array([len(t) for t in texts])
            firsts = np.cumsum(sizes) - sizes
            starts, ends = np.repeat(firsts, sizes), np.repeat(firsts + sizes, sizes)
            codes = _coded([w for t in texts for w in t])
            start, length, period = _whole_runs(codes, starts, ends)
            text = np.searchsorted(firsts + sizes, start, side="right")
            runs: list[list] = [[] for _ in texts]
            for i, *run in zip(
                text.tolist(),
                (start - firsts[text]).tolist(),
                length.tolist(),
                period.tolist(),
                strict=True,
            ):
                runs[i].append(tuple(run))
            yield _solved(piece.column("id"), texts, runs)


def _solved(ids, texts: list[list[bytes]], runs: list[list[tuple]]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in _FIELDS]))
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([[dict(zip(_FIELDS, r, strict=True)) for r in rs] for rs in runs], kind),
            pa.array([collapsed(t, r) for t, r in zip(texts, runs, strict=True)], pa.string()),
        ],
        ["id", "n_words", "runs", "collapsed"],
    )


# ---------------------------------------------------------------- texts of many tiles


def tiles_of(n_words: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int]]:
    """(low, high, first, end): tiles over a text for periods in [low, high).

    The lowest octaves share the shortest tiles, and those share one whole text that would
    need tiles as long as it. Neighbours overlap by twice the longest period, so that each
    stretch as long as its period shows whole or crosses an overlap it fills.
    """
    low, high = 1, max(2, 2 * tile // PERIODS)
    length = tile
    while low <= n_words // 2:
        if length >= n_words:
            yield low, n_words // 2 + 1, 0, n_words
            return
        for first in range(0, n_words, length // 2):
            yield low, high, first, min(first + length, n_words)
            if first + length >= n_words:
                break
        low, high, length = high, 2 * high, PERIODS * high


def _explode(tile: int):
    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
                codes = _coded(text.as_py().encode().split()).astype(np.int32)
                for low, high, first, end in tiles_of(len(codes), tile):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": [key.as_py()],
                            "n_words": [len(codes)],
                            "first": [first],
                            "low": [low],
                            "high": [high],
                            "codes": [codes[first:end].tobytes()],
                        }
                    )

    return exploded


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            codes = np.frombuffer(row["codes"], np.int32).astype(np.int64)
            n, first = len(codes), row["first"]
            period, start, stop = tile_fragments(
                codes, np.zeros(n, np.int64), np.full(n, n), row["low"], row["high"]
            )
            # Inside the tile a stretch is whole, so that it counts or does not.
            cut = ((start == 0) & (first > 0)) | (
                (stop + period == n) & (first + n < row["n_words"])
            )
            good = cut | (stop + period - start >= np.maximum(MIN_LENGTH, 2 * period))
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array([row["key"]] * int(good.sum()), pa.binary()),
                    "period": period[good],
                    "start": start[good] + first,
                    "stop": stop[good] + first,
                }
            )


def stitched(fragments: DataFrame) -> DataFrame:
    """(key, runs) from fragments (key, period, start, stop) of one text's tiles.

    Fragments of a text and period that overlap or touch belong to one stretch.
    """
    by_period = Window.partitionBy("key", "period").orderBy("start", "stop")
    reached = F.max("stop").over(by_period.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("start") <= reached, 0).otherwise(1)
    stretches = (
        fragments.withColumn("begins", begins)
        .withColumn("part", F.sum("begins").over(by_period))
        .groupBy("key", "period", "part")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    )
    length = F.col("stop") + F.col("period") - F.col("start")
    return (
        stretches.filter(length >= F.greatest(F.lit(MIN_LENGTH), 2 * F.col("period")))
        .groupBy("key", "start", length.alias("length"))
        .agg(F.min("period").alias("period"))
        .groupBy("key")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("found")
        )
        .select(
            "key",
            F.transform(
                "found",
                lambda r: F.struct(*[r[f].alias(f) for f in _FIELDS]),
            ).alias("runs"),
        )
    )


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            words = row.column("text")[0].as_py().encode().split()
            found = row.column("runs")[0].as_py() or []
            runs = [(r["start"], r["length"], r["period"]) for r in found]
            yield _solved(row.column("id"), [words], [runs])


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE
) -> DataFrame:
    """(id, n_words, runs, collapsed) for each row of ``docs``.

    ``runs`` are all runs (start, length, period), by start, then period. ``collapsed`` holds
    the words joined by one space, without those that any run contains after its first
    period. A null or empty text has no words and no runs. Every row is answered, repeated
    ones each; the id, of any type and maybe null, only passes through. An empty table gives
    an empty result. Other columns are not read.

    Texts of less than 8 * ``tile`` characters are one tile and never shuffled. Of longer
    ones the tiles are, as word numbers, and twice the text; their key is the SHA-256 of the
    text, so that copies of a long text are solved once. Lazy: runs no job.
    """
    if tile < 32:
        raise ValueError("a tile needs 32 words at least")
    sized = docs.select(
        F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("text")
    )
    long = F.length("text") >= 8 * tile
    schema = T.StructType(
        [
            sized.schema["id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", RUNS),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    short = sized.filter(~long).mapInArrow(_solve_whole, schema)

    keyed = sized.filter(long).withColumn("key", F.unhex(F.sha2("text", 256)))
    tiles = (
        keyed.select("key", "text")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
        .mapInArrow(_explode(tile), _TILES)
        .repartition("key", "first", "low")
    )
    runs = stitched(tiles.mapInArrow(_solve_tiles, _FRAGMENTS))
    solved = keyed.join(runs, "key", "left").select("id", "text", "runs")
    return (
        short.unionByName(solved.mapInArrow(_finish, schema))
        .withColumnRenamed("id", id_col)
    )


def with_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the last words of every tenth text, by its id's CRC-32, made periodic.

    With h the CRC-32 of the decimal id, g = h div 10 and n words, texts with h % 10 = 0 get
    word a + (i - a) % p in place of each word i >= a, where a = g % n and
    p = 1 + (n - a) div (3 + g % 8). Texts without words or id stay as they are.
    """
    h = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    g = F.floor(h / 10)
    text = text_of(f"`{text_col}`")
    made = _periodic(text, g)
    return docs.withColumn(
        text_col, F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), made).otherwise(text)
    )


def _periodic(text: Column, g: Column) -> Column:
    def remade(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        return let(
            F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p")),
            lambda s: F.array_join(
                F.transform(
                    words,
                    lambda w, i: F.when(i < s["a"], w).otherwise(
                        F.get(words, (s["a"] + (i - s["a"]) % s["p"]).cast("int"))
                    ),
                ),
                " ",
            ),
        )

    return let(words_of(text), remade)


def runs_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each document: number of runs, the longest one, and two digests."""
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"),
                (-r["start"]).alias("before"),
                (-r["period"]).alias("shorter"),
            ),
        )
    )
    lines = F.transform(
        "runs",
        lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]),
    )
    joined = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(joined, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.shorter")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.shorter")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
