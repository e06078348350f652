import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from tests.llm.conftest import words

from cohort_engine.llm import lexical_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    """(item number, rank, doc_id, score) by scoring every document."""
    found = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in found)
    total = sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, (_, text) in enumerate(items):
        scored = []
        for doc_id, counts in found:
            n, score = sum(counts.values()), 0
            for t in terms(text):
                if tf := counts.get(t, 0):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 75 + (25 * n * n_docs) // total
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if none else doc_id, -score))
    return out


@pytest.mark.parametrize("bucket,top,block", [(4096, 20, 100), (16, 5, 4)])
def test_equals_brute_force(spark, documents, mess, monkeypatch, bucket, top, block):
    monkeypatch.setattr(search, "BUCKET", bucket)
    monkeypatch.setattr(search, "FIRST", bucket)
    rng = random.Random(2)
    docs = [(i, t) for i, t, _ in mess]
    texts = [t for _, t in docs if t and len(t) < 2000]
    items = [(i, " ".join(rng.choice(texts).split()[:40])) for i in range(8)]
    items += [(8, None), (9, ""), (10, "unknown_only!"), (11, "A-a a"), (3, "w1 w1 w2"), (None, "w5")]
    items += [(12, words(rng, 30, 5_000))]
    queries = spark.createDataFrame(
        [(i, t, "z", 1) for i, t in items], "item_id long, text string, doc_id string, rank int"
    ).coalesce(1)
    got = search.search(documents(mess), queries, top=top, block=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    expected = [(items[i][0], r, d, s) for i, r, d, s in brute(docs, items, top)]
    key = lambda row: tuple((x is None, x or 0) for x in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)
    assert expected


def test_bounds_keep_all_that_reach():
    rng = np.random.default_rng(1)
    for _ in range(50):
        sizes = rng.integers(0, 9, 40)
        lists = [np.sort(rng.choice(30, s, replace=False)) for s in sizes]
        values = rng.integers(1, 10**6, sizes.sum())
        starts = np.append(0, np.cumsum(sizes))
        lengths = np.array(
            [np.sqrt((values[a:b].astype(float) ** 2).sum()) for a, b in zip(starts, starts[1:])]
        )
        bucket = search.Bucket(
            np.arange(40), np.ones(40, bool), lengths, starts, np.concatenate(lists), values
        )
        asked = np.sort(rng.choice(30, 6, replace=False))
        weights = rng.integers(0, 9000, 6)
        exact = bucket.scores(np.arange(40), asked, weights)
        some = np.array([1, 5])
        assert (bucket.scores(some, asked, weights) == exact[some]).all()
        for least in (0, 1, int(np.median(exact)), int(exact.max()), int(exact.max()) + 1):
            kept = bucket.candidates(asked, weights, least)
            assert set(np.flatnonzero((exact >= max(least, 1)))) <= set(kept.tolist())


def test_empty_tables(spark, documents):
    docs = documents([(1, "a b", "s"), (2, None, "s")])
    queries = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert len(search.search(docs, queries).collect()) == 1
    assert search.search(docs.filter("doc_id = 2"), queries).collect() == []
    assert search.search(docs.filter("doc_id = 3"), queries).collect() == []
    assert search.search(docs, queries.filter("item_id = 2")).collect() == []
