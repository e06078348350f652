import re
from collections import defaultdict

import pytest

from cohort_engine.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def wanted(sizes, most=3):
    """Targets by handing out the excess again and again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        goal = {
            s: most * sizes[s] if s in full else left * weight[s] / free for s in order
        }
        above = {s for s in order if s not in full and goal[s] > most * sizes[s]}
        if not above:
            return goal
        full |= above


@pytest.mark.parametrize("skew", [False, True])
def test_sources_come_near_their_targets(documents, mess, skew):
    rows = [(1_000 + i, "tiny source", "a") for i in range(3)]
    rows += [(2_000 + i, f"other source {i}", "b") for i in range(40)]
    rows += mess if skew else []
    docs = documents(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    by_id = defaultdict(list)
    for i, text, source in rows:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
        by_id[str(i), n].append(source)
    goals = wanted(sizes)
    for r in got:
        sources = by_id[str(r.doc_id), r.size]
        source = next(s for s in sources if sizes[s] == r.source_size)
        assert r.target == pytest.approx(goals[source])
        assert r.taken == r.size * r.passes and 0 <= r.passes <= 3
        taken[source] += r.taken
    budget = sum(sizes.values())
    assert sum(taken.values()) <= budget + 1e-6
    # One document ends the mix, so that no source is further off than the largest ones.
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= max(largest.values()) + largest[source]
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, ((r.doc_id, r.taken) for r in got))) == sorted(
        map(str, ((r.doc_id, r.taken) for r in again))
    )


def test_mixed_documents(documents, mess):
    docs = documents(mess)
    times = {}
    for r in mixing.mix(docs).collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + r.passes
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    found = defaultdict(int)
    for r in out.collect():
        found[r.doc_id] += 1
    assert dict(found) == {i: n for i, n in times.items() if n}


def test_mix_of_nothing(documents):
    assert mixing.mix(documents([])).count() == 0
    assert [r.taken for r in mixing.mix(documents([(1, None, "s"), (2, "", None)])).collect()] == [
        0,
        0,
    ]
