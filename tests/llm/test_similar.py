import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohort_engine.llm import jaccard
from cohort_engine.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingle_set(t) for _, t, _ in rows]
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            common = len(sets[i] & sets[j])
            union = len(sets[i] | sets[j])
            if union and 100 * common >= 80 * union:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (name, _, _) in enumerate(rows):
        least.setdefault(root(i), []).append(name)
    ids = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted(
        (str(rows[i][0]), len(sets[i]), str(ids[root(i)]), links[i]) for i in range(n)
    ), len(least)


@pytest.mark.parametrize("limit", [2_000, 3])
def test_components_and_links(documents, mess, limit):
    got = jaccard.similar_documents(documents(mess), limit=limit).collect()
    expected, groups = brute(mess)
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in got)
    assert found == expected
    assert sum(r.first for r in got) == groups == len({r.component for r in got})


def test_one_of_each(documents, mess):
    docs = documents(mess)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == brute(mess)[1]


def test_similar_documents_of_nothing(documents):
    assert jaccard.similar_documents(documents([])).count() == 0
    got = jaccard.similar_documents(documents([(1, None, "s"), (2, "", "s"), (3, "a", "s")]))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == [
        (1, 0, 1),
        (2, 0, 2),
        (3, 1, 3),
    ]


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.sets(st.integers(0, 14), min_size=1, max_size=12), min_size=1, max_size=9),
    st.booleans(),
    st.integers(0, 99),
)
def test_pairs_by_index_lists(sets, across, seed):
    rng = random.Random(seed)
    extra = [rng.randrange(3) for _ in sets]  # members that no other set has
    part = np.array([rng.randrange(2) for _ in sets])
    pairs = jaccard.similar_sets(
        [np.array(sorted(s), np.uint64) for s in sets],
        np.array([len(s) + e for s, e in zip(sets, extra)]),
        part,
        across,
        80,
    )
    listed = [tuple(sorted((int(i), int(j)))) for i, others in pairs for j in others]
    found = set(listed)
    assert len(found) == len(listed)
    expected = set()
    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            union = len(sets[i] | sets[j]) + extra[i] + extra[j]
            if 100 * common >= 80 * union and not (across and part[i] == part[j]):
                expected.add((j, i))
    assert found == expected


def test_graph_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 100 + k) for k in range(1, 40)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {n for a, b in edges if a != b for n in (a, b)}
    got = {
        r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()
    }
    assert got == {n: root(n) for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("limit, percent", [(4, 80), (4, 60), (1, 100)])
def test_large_families_of_many_sizes(documents, limit, percent):
    """A family from a chain of texts that grow: bands of sizes lose no link."""
    rng = random.Random(limit + percent)
    line = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(70):
        size = 10 + int(10 * 1.05**i)
        words = line[: min(size, 400)] + [f"e{rng.randrange(10**6)}" for _ in range(i % 3)]
        rows.append((i, " ".join(words), "s"))
    sets = [
        {tuple(t.split()[p : p + 5]) for p in range(len(t.split()) - 4)} for _, t, _ in rows
    ]
    got = {
        r.doc_id: r.n_links
        for r in jaccard.similar_documents(documents(rows), limit=limit, percent=percent).collect()
    }
    for i, a in enumerate(sets):
        expected = sum(
            100 * len(a & b) >= percent * len(a | b) for j, b in enumerate(sets) if i != j
        )
        assert got[i] == expected
    assert percent == 100 or sum(got.values()) > 70
