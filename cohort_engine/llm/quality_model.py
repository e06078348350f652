"""Quality classifier on averaged vectors of hashed words and character n-grams."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_engine.llm.common import chunks, text_of

# Hash slots of the vectors, their length, and the lengths of the character n-grams.
SLOTS = 1 << 18
WIDTH = 8
NGRAMS = (2, 3, 4)
# Labelled documents to train on at most: those with the smallest hash of their id.
MAX_TRAINING = 5_000
# Characters of their texts at most.
MAX_CHARACTERS = 64 << 20
EPOCHS = 4
RATE = 2.0
THRESHOLD = 0.3
SEED = 7

# Characters of a piece of a long text.
PIECE = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACES = re.compile(r"[\x20\x09-\x0D]+")


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def _slots(keys: np.ndarray, kind: int) -> np.ndarray:
    mixed = (keys ^ np.uint64(kind)) * _MIX
    mixed ^= mixed >> np.uint64(32)
    return ((mixed * _MIX) >> np.uint64(40)).astype(np.uint32) & np.uint32(SLOTS - 1)


def pieces(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The texts cut into pieces of about PIECE characters, and the text each is of.

    Cuts are at white space only, so that all pieces together have the features of the text.
    """
    out, owner = [], []
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > PIECE and (m := _SPACES.search(text, at + PIECE)):
            out.append(text[at : m.start()])
            owner.append(i)
            at = m.end()
        out.append(text[at:])
        owner.append(i)
    return out, np.array(owner, np.int64)


def features(texts: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Slots of all words of the texts and of the character n-grams in them.

    A word has a mark before and after it, which count as characters of its n-grams; there
    are none over word borders. Returns where each text starts, and for every kind of feature
    a pair (places in ascending order, slots).
    """
    data = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le"), np.uint32).copy()
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = 1 + np.cumsum(sizes) - sizes
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    data[blank] = 32
    wide, found = data.astype(np.uint64), []
    for n in NGRAMS:
        if len(data) < n:
            continue
        last = len(data) - n + 1
        keys, inner = wide[:last].copy(), np.ones(last, bool)
        for i in range(1, n):
            keys = keys * np.uint64(_BASE) + wide[i : last + i]
            if i < n - 1:
                inner &= ~blank[i : last + i]
        if n == 2:
            inner &= ~(blank[:-1] & blank[1:])
        places = np.flatnonzero(inner)
        # By its second character, since the first may be the mark.
        found.append((places + 1, _slots(keys[places], n)))
    edges = np.flatnonzero(np.diff(np.concatenate(([1], blank.view(np.int8), [1]))))
    first, end = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((wide + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:])
    keys = (sums[end] - sums[first]) * _powers(_BASE_INVERSE, len(data))[first]
    found.append((first, _slots(keys, 1)))
    return starts, found


@dataclass
class Model:
    """``gain[slot]`` is what a feature adds to the log-odds before averaging."""

    gain: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 of each text; of empty texts that of the bias."""
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        parts, owner = pieces(texts)
        # Some pieces at once, so that a long text takes no more memory than they do.
        sizes = np.cumsum([len(p) for p in parts])
        cuts = np.flatnonzero(np.diff(sizes // (2 * PIECE), prepend=-1)) if parts else []
        for low, high in zip(cuts, [*cuts[1:], len(parts)], strict=True):
            starts, found = features(parts[low:high])
            for places, slots in found:
                sums = np.concatenate(([0.0], np.cumsum(self.gain[slots], dtype=np.float64)))
                bounds = np.searchsorted(places, np.append(starts, np.iinfo(np.int64).max))
                np.add.at(total, owner[low:high], np.diff(sums[bounds]))
                np.add.at(count, owner[low:high], np.diff(bounds))
        return 1 / (1 + np.exp(-(self.bias + total / np.maximum(count, 1))))


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Train slot vectors and a softmax layer by stochastic gradient descent.

    A document is the mean of the vectors of its features. Documents come in a new order
    in each epoch; the rate falls to zero. With one label only, or none, the score is
    the share of label 1, or one half.
    """
    share = sum(labels) / len(labels) if labels else 0.5
    bias = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6))))
    if not 0 < share < 1:
        return Model(np.zeros(SLOTS, np.float32), bias)
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (SLOTS, WIDTH)).astype(np.float32)
    layer = np.zeros((2, WIDTH), np.float32)
    offset = np.array([-bias / 2, bias / 2], np.float32)
    rows = []
    for text in texts:
        slots = np.concatenate([s for p in pieces([text])[0] for _, s in features([p])[1]])
        slots, counts = np.unique(slots, return_counts=True)
        rows.append((slots, (counts / max(counts.sum(), 1)).astype(np.float32)))
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for row in rng.permutation(len(rows)):
            pace = np.float32(rate * (1 - step / steps))
            step += 1
            slots, parts = rows[row]
            hidden = parts @ vectors[slots]
            logits = layer @ hidden + offset
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[row]] -= 1
            back = error @ layer
            layer -= pace * np.outer(error, hidden)
            offset -= pace * error * np.float32(0.1)
            vectors[slots] -= pace * np.outer(parts, back)
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(offset[1] - offset[0]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_training: int = MAX_TRAINING,
    max_characters: int = MAX_CHARACTERS,
) -> Model:
    """Fit on whole texts of labelled documents that are not held out.

    At most ``max_training`` documents are used, those whose ids have the smallest
    hashes, and of these the first ones whose texts have ``max_characters`` characters in all
    (the first one in any case). All tasks look for them; one task gets them, no other rows,
    and trains. The bounds are parameters and do not follow the input, nor does the model.
    Rows without id or label are left out; of several labels or texts of an id the smallest
    counts. Without any, the model gives every text a score of a half. Runs a job.
    """
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.md5(F.col("id").cast("string")), "id")
        .limit(max_training)
    )
    order = [F.md5(F.col("id").cast("string")), F.col("id")]
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # Few rows move: those of the chosen documents, one for each.
    sample = (
        docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id", "label")
        .agg(F.min("text").alias("text"))
        .withColumn("upto", F.sum(F.length("text")).over(upto))
        .withColumn("place", F.row_number().over(Window.orderBy(*order)))
        .filter((F.col("upto") <= max_characters) | (F.col("place") == 1))
        .select("id", "label", "text")
    )

    def fitted(frames):
        rows = pd.concat(list(frames) or [pd.DataFrame({"id": [], "text": [], "label": []})])
        rows = rows.sort_values(["id", "text"], kind="stable")
        model = fit(rows["text"].tolist(), rows["label"].astype(int).tolist())
        yield pd.DataFrame({"gain": [model.gain.tobytes()], "bias": [model.bias]})

    row = sample.repartition(1).mapInPandas(fitted, "gain binary, bias double").first()
    if row is None:
        return fit([], [])
    return Model(np.frombuffer(row["gain"], np.float32), row["bias"])


def held_out(doc_id):
    """Whether a document's label may not be learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def score(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Score each whole text; only the text goes into a score.

    The model (1 MB for any corpus) is sent to the tasks; no shuffle. A null text scores
    like an empty one. A null id counts as not held out. Repeated rows are scored each;
    an empty table gives an empty result. Result, a row for each input row: id,
    held_out, score, predicted, and with ``keep`` a struct ``kept`` of the columns named
    there as kept_0, kept_1 and so on, so that no names can clash.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(
        F.col(id_col).alias("id"),
        F.struct(
            F.lit(0).alias("none"),
            *[F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep)],
        ).alias("kept"),
        text_of(text_col).alias("text"),
    )

    def scored(batches):
        for batch in chunks(batches, "text"):
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("kept"), pa.array(sent.value.scores(texts))],
                ["id", "kept", "score"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    out = source.mapInArrow(scored, f"id {kinds['id']}, kept {kinds['kept']}, score double")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *(["kept"] if keep else []),
    )


def accepted(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that the model predicts label 1 for, with all their columns.

    A null text is judged like an empty one. Repeated rows are judged each, by their text
    alone, so that they stay or go together; ids may be null. An empty table gives an empty
    result. Columns may have any names.
    """
    found = score(docs, model, id_col, text_col, threshold, tuple(docs.columns))
    return found.filter("predicted = 1").select(
        *[F.col(f"kept.kept_{i}").alias(c) for i, c in enumerate(docs.columns)]
    )
