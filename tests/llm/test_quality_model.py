"""The classifier against a plain version of the same model."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from cohort_engine.llm import quality_model as quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FULL = 1 << 64


def mix(key, kind):
    mixed = (key ^ kind) * int(quality._MIX) % FULL
    mixed ^= mixed >> 32
    return (mixed * int(quality._MIX) % FULL >> 40) & (quality.SLOTS - 1)


def plain_features(text):
    """Slots by going through words and their n-grams one by one."""
    out = Counter()
    for word in WORD.findall(text):
        power, total = 1, 0
        for c in word:
            total = (total + (ord(c) + 1) * power) % FULL
            power = power * quality._BASE % FULL
        out[mix(total, 1)] += 1
        marked = f" {word} "
        for n in quality.NGRAMS:
            for i in range(len(marked) - n + 1):
                key = 0
                for c in marked[i : i + n]:
                    key = (key * quality._BASE + ord(c)) % FULL
                out[mix(key, n)] += 1
    return out


TEXTS = ["", " ", "a", "né ü\n", "one  two\tthree", "𝐦𝐚𝐭𝐡 wörd, wörd", "x" * 50 + " y"]


def slots_of(text):
    return Counter(np.concatenate([s for _, s in quality.features([text])[1]]).tolist())


@pytest.mark.parametrize("text", TEXTS)
def test_features(text):
    assert slots_of(text) == plain_features(text)


def test_score_is_the_mean_of_the_features_gains():
    rng = np.random.default_rng(3)
    model = quality.Model(rng.standard_normal(quality.SLOTS).astype(np.float32), 0.25)
    got = model.scores(TEXTS)
    for text, score in zip(TEXTS, got, strict=True):
        found = slots_of(text)
        mean = sum(float(model.gain[s]) * n for s, n in found.items()) / max(1, sum(found.values()))
        assert abs(score - 1 / (1 + np.exp(-(0.25 + mean)))) < 1e-9


def test_long_texts_go_in_pieces(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(500)}é" for _ in range(n)) for n in (3, 900, 0, 4000)]
    texts += ["z" * 5000 + " end", "\n \n".join(["ab", "c" * 300] * 40)]
    model = quality.Model(
        np.random.default_rng(3).standard_normal(quality.SLOTS).astype(np.float32), 0.0
    )
    whole = model.scores(texts)
    monkeypatch.setattr(quality, "PIECE", 100)
    assert len(quality.pieces(texts)[0]) > 100
    assert np.allclose(model.scores(texts), whole)
    first = quality.fit(texts, [0, 1, 0, 1, 0, 1])
    monkeypatch.undo()
    assert np.allclose(first.gain, quality.fit(texts, [0, 1, 0, 1, 0, 1]).gain, atol=1e-5)


def test_training_bounds(documents, spark):
    rows = [(i, f"word{i % 7} and {i}" * (i % 5), "s") for i in range(60)]
    rows += [(11, "zzz another text", "s"), (11, "aaa first text", "s")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    docs = documents(rows)
    whole = quality.train(docs, labels)
    again = quality.train(docs.repartition(7), labels)
    assert np.array_equal(whole.gain, again.gain)
    few = quality.train(docs, labels, max_training=10)
    short = quality.train(docs, labels, max_characters=40)
    one = quality.train(docs, labels, max_characters=0)
    gains = [whole.gain, few.gain, short.gain]
    assert not any(np.array_equal(a, b) for i, a in enumerate(gains) for b in gains[:i])
    assert not one.gain.any()  # one document has one label


def test_one_task_gets_the_sample_only(documents, spark):
    """The scan is not in the stage of one task: the exchange before it has the sample."""
    docs = documents([(i, "some words here", "s") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    frame = type(docs)
    before = frame.repartition

    def watched(self, n, *columns):
        if n == 1:
            seen.append(self)
        return before(self, n, *columns)

    frame.repartition = watched
    try:
        quality.train(docs, labels, max_training=12)
    finally:
        frame.repartition = before
    assert len(seen) == 1 and seen[0].count() == 12


def test_clashing_names(documents, spark):
    docs = documents([(1, "a b c", "s"), (2, "d e f", "s")])
    for name in ("__none", "none", "kept_0", "score"):
        out = quality.accepted(docs.withColumn(name, docs["n_words"]), quality.Model(
            np.zeros(quality.SLOTS, np.float32), 1.0))
        assert out.columns == [*docs.columns, name] and out.count() == 2
