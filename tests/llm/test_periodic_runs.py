import hashlib
import random
import re
import zlib

import pytest

from cohort_engine.llm import periodic_runs as runs


def brute(words):
    """All runs of a list by trying each period at each place."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((start, q, length) for (start, length), q in out.items())


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def made(rng):
    n, kinds = rng.randrange(0, 260), rng.choice([1, 2, 2, 3, 5, 50])
    words = [f"ü{rng.randrange(kinds)}" for _ in range(n)]
    if n and rng.random() < 0.7:
        a = rng.randrange(n)
        p = 1 + rng.randrange((n - a) // 2 + 1)
        for i in range(a, n):
            words[i] = words[a + (i - a) % p]
    if n and rng.random() < 0.3:
        words[rng.randrange(n)] = "x"
    return words


@pytest.mark.parametrize("tile", [32, 64, runs.TILE])
def test_equals_brute_force(documents, mess, tile):
    rng = random.Random(tile)
    texts = {1000 + i: made(rng) for i in range(150)}
    rows = [(i, " ".join(w), "s0") for i, w in texts.items()]
    rows += [(i, t, s) for i, t, s in mess if len(t or "") < 5000]
    rows = [r for r in rows if r[0] not in (7, None)]
    texts_by_id = {i: [t for j, t, _ in rows if i == j] for i, _, _ in rows}
    found = runs.find_runs(documents(rows), tile=tile)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = {}
    for row in found.collect():
        text = texts_by_id[row["doc_id"]].pop()
        words = split(text)
        assert row["n_words"] == len(words)
        listed = [(r["start"], r["period"], r["length"]) for r in row["runs"]]
        assert listed == brute(words)
        gone = {i for s, q, n in listed for i in range(s + q, s + n)}
        assert row["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
        got[row["doc_id"]] = listed
    assert set(got) == {r[0] for r in rows} and any(got.values())
    assert found.count() == len(rows)


def test_query_columns(spark, documents, mess):
    frame = documents(mess)
    found = runs.runs_digest(runs.find_runs(runs.with_periods(frame)))
    digest = {r["doc_id"]: r for r in found.collect()}
    for doc_id, text, _ in mess:
        words = split(text)
        if doc_id in (7, 100, None) or len(words) > 5000:
            continue
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        listed = brute(words)
        row = digest[doc_id]
        lines = "".join(f"{s},{length},{q}\n" for s, q, length in listed)
        assert row["n_runs"] == len(listed)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        if listed:
            s, q, length = min(listed, key=lambda r: (-r[2], r[0], r[1]))
            assert (row["start"], row["length"], row["period"]) == (s, length, q)
            assert row["exponent_milli"] == 1000 * length // q
        else:
            assert row["start"] is row["length"] is row["exponent_milli"] is None


def test_long_texts_cross_tiles(documents):
    rng = random.Random(4)
    block = [f"w{rng.randrange(900)}" for _ in range(7000)]
    plain = [f"v{rng.randrange(10**6)}" for _ in range(3000)]
    rows = [
        (1, " ".join(plain + block + block + block[:100] + plain), "s0"),
        (2, "a " * 30_000, "s0"),
        (3, "a " * 30_000, "s0"),
        (4, " ".join(plain * 2), "s1"),
        (None, " ".join(plain * 2), "s1"),
    ]
    got = {
        r["doc_id"]: [tuple(x) for x in r["runs"]]
        for r in runs.find_runs(documents(rows), tile=2048).collect()
    }
    assert got[1] == [(3000, 14_100, 7000)]
    assert got[2] == got[3] == [(0, 30_000, 1)]
    assert got[4] == got[None] == [(0, 6000, 3000)]


def test_empty_table(documents, spark):
    empty = documents([(1, "a", "s")]).filter("doc_id < 0")
    assert runs.runs_digest(runs.find_runs(empty)).collect() == []
    with pytest.raises(ValueError):
        runs.find_runs(empty, tile=8)
