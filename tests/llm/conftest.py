import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
# Python workers of the test session find the repository as well.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

SCHEMA = "doc_id long, text string, source string, n_words string, row string, kept int"


@pytest.fixture
def documents(spark):
    """documents([(doc_id, text, source), ...]): with more columns of clashing names."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, s, "x", "y", 7) for i, t, s in rows], SCHEMA
        ).repartition(3, "doc_id")

    return make


def words(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def mess():
    """Rows with nulls, ties, copies, shared passages, edits and a very long text."""
    rng = random.Random(5)
    passage = words(rng, 60, 10_000)
    base = words(rng, 120, 10_000)
    rows = [(i, words(rng, rng.randrange(1, 150), 5_000), f"s{i % 3}") for i in range(25)]
    rows += [(100 + i, base, "s0") for i in range(6)]  # copies
    for i in range(12):  # near copies
        edited = base.split(" ")
        for _ in range(i % 5):
            edited[rng.randrange(len(edited))] = f"e{rng.randrange(10_000)}"
        rows.append((200 + i, " ".join(edited).upper() if i == 3 else " ".join(edited), "s1"))
    for i in range(5):  # a passage amid other words
        rows.append((300 + i, f"{words(rng, 30, 9_000)}\n{passage} {words(rng, 20, 9_000)}", None))
    rows += [
        (400, None, "s0"),
        (401, "", "s0"),
        (402, " \n\t ", None),
        (403, "one two three", "s1"),
        (404, "One two THREE", "s1"),
        (405, "naïve ünïcödé ＷＩＤＥ 𝐦𝐚𝐭𝐡   wörd " * 20, "s2"),
        (406, "a " * 400, "s2"),
        (407, "ab" * 300, "s2"),
        (408, words(rng, 30_000, 20_000), "s2"),
        (None, words(rng, 80, 9_000), "s1"),
        (None, base, "s1"),
        (7, base, "s1"),  # an id twice
        (100, base, "s0"),  # a row twice
    ]
    return rows
