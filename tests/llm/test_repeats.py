import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohort_engine.llm import anchors, automaton_dedup, suffix_dedup
from cohort_engine.llm import blocks as B
from cohort_engine.llm import repeats as R
from cohort_engine.llm.words import word_hashes, word_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def order(rows):
    """Rows in the order of ids, null first."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0]))


def brute_bytes(texts, length):
    seen, out = set(), []
    for data in texts:
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        out.append(gone)
    return out


def summary(data, gone):
    spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
    kept = bytes(c for c, g in zip(data, gone) if not g)
    return len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("length, gram, hot", [(100, 32, 1_000), (20, 8, 1), (20, 8, 0)])
def test_bytes_that_start_earlier(documents, mess, length, gram, hot):
    # Ids of different texts that occur twice would leave their order open.
    rows, seen = [], set()
    for i, text, source in order(mess):
        if (i, text) in seen or i not in {a for a, _ in seen}:
            rows.append((i, text, source))
            seen.add((i, text))
    texts = [(t or "").encode() for _, t, _ in rows]
    expected = sorted(
        (str(i), *summary(data, gone))
        for (i, _, _), data, gone in zip(rows, texts, brute_bytes(texts, length))
    )
    docs = documents(rows)
    got = suffix_dedup.remove_repeats(docs, length=length, gram=gram, hot_blocks=hot).collect()
    found = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    assert sorted(found) == expected
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


def test_bytes_of_nothing(documents):
    assert suffix_dedup.remove_repeats(documents([])).count() == 0
    (row,) = suffix_dedup.remove_repeats(documents([(None, None, None)])).collect()
    assert (row.doc_id, row.n_bytes, row.n_removed) == (None, 0, 0)


@pytest.mark.parametrize("hot", [1_000, 1, 0])
def test_repeated_words(documents, mess, hot):
    words = [WORD.findall(t or "") for _, t, _ in mess]
    count = Counter(tuple(w[p : p + 35]) for w in words for p in range(len(w) - 34))
    expected = []
    for (i, _, _), w in zip(mess, words):
        gone = [False] * len(w)
        for p in range(len(w) - 34):
            if count[tuple(w[p : p + 35])] > 1:
                gone[p : p + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        expected.append((str(i), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = automaton_dedup.remove_passages(documents(mess), shard=3, hot_blocks=hot).collect()
    found = [(str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got]
    assert sorted(found) == sorted(expected)
    assert any(r.n_removed and r.n_removed < r.n_words for r in got)
    assert automaton_dedup.remove_passages(documents([])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), max_size=6), st.integers(1, 4))
def test_automata_count_windows(passages, shard):
    length = 3
    count = Counter(
        tuple(p[i : i + length]) for p in passages for i in range(len(p) - length + 1)
    )
    data = [np.array(p, np.uint64).tobytes() for p in passages]
    for p, found in zip(passages, automaton_dedup.repeated_windows(data, length, shard)):
        assert list(found) == [
            count[tuple(p[i : i + length])] > 1 for i in range(len(p) - length + 1)
        ]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=12, max_size=12).map(lambda b: bytes(x % 3 for x in b)),
                min_size=1, max_size=8))
def test_earlier_windows_by_suffix_order(rows):
    contexts = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 12)
    n = len(rows)
    found = suffix_dedup.earlier(
        contexts, np.arange(n), np.zeros(n, np.int64), np.full(n, 7, np.int64), 5
    )
    for i in range(n):
        for c in range(8):
            same = any(rows[j][c : c + 5] == rows[i][c : c + 5] for j in range(i))
            assert found[i, c] == same


def test_anchors_depend_on_the_window_only(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.randrange(3) for _ in range(n)) for n in (0, 5, 40, 300, 17, 900)]
    texts += [texts[3][50:200], b"\0" * 120]
    values = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)

    def windows(stretch):
        monkeypatch.setattr(anchors, "_STRETCH", stretch)
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        found = anchors.runs(values[data], starts, sizes, 20, 6)
        out = {}
        for k in range(len(found.at)):
            for p in range(found.low[k], found.high[k] + 1):
                text = found.text[k]
                assert starts[text] <= p and p + 20 <= starts[text] + sizes[text]
                out[p] = (bytes(data[p : p + 20]), found.at[k] - p, found.gram[k])
        return out

    found = windows(1 << 15)
    assert len(found) == sum(max(0, len(t) - 19) for t in texts)
    by_window = {}
    for window, offset, gram in found.values():
        assert by_window.setdefault(window, (offset, gram)) == (offset, gram)
    assert windows(37) == found


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té", max_size=12), max_size=5))
def test_words_of_texts_end_to_end(texts):
    encoded = [t.encode() for t in texts]
    sizes = np.array([len(t) for t in encoded], np.int64)
    data = b"".join(encoded)
    first, end, number = word_spans(data, np.cumsum(sizes) - sizes, sizes)
    words = [WORD.findall(t) for t in texts]
    assert list(number) == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert [data[a:b].decode() for a, b in zip(first, end)] == flat
    hashes = word_hashes(data, first, end, True).tolist()
    lower = [w.replace("B", "b") for w in flat]
    assert all(
        (x == y) == (a == b) for x, a in zip(lower, hashes) for y, b in zip(lower, hashes)
    )


def test_anchors_of_many_places_are_hot(spark, documents):
    # A template in one block, each time amid other words, and a passage that repeats.
    template = " ".join(f"t{i}" for i in range(30))
    lines = [
        " ".join([*(f"a{n}x{i}" for i in range(20)), template, *(f"b{n}x{i}" for i in range(20))])
        for n in range(30)
    ]
    docs = documents([(1, "\n".join(lines), "s"), (2, "before " + lines[4] + " after", "s")])
    blocks = B.build(docs, "doc_id", "text", "hot-test")
    windows = R.Windows(automaton_dedup._words, 35, 12)
    for places, hot in ((1_000, False), (5, True)):
        states = R.anchor_states(blocks, windows, 3, hot_places=places).collect()
        assert any(R.HOT in r.states for r in states) == hot
    results = [
        sorted(
            (r.doc_id, r.n_removed, r.kept_sha256)
            for r in automaton_dedup.remove_passages(docs, hot_places=places).collect()
        )
        for places in (1_000, 5)
    ]
    assert results[0] == results[1] and [r[1] for r in results[0]] == [70, 70]
    results = [
        sorted(
            (r.doc_id, r.n_removed, r.kept_sha256)
            for r in suffix_dedup.remove_repeats(docs, hot_places=places).collect()
        )
        for places in (1_000, 5)
    ]
    assert results[0] == results[1] and results[0][1][1] > 0


@pytest.mark.parametrize("length, gram", [(100, 32), (287, 32), (288, 32), (600, 32), (600, 600)])
def test_long_windows(documents, length, gram):
    """Windows whose anchors may be over 255 bytes from their ends."""
    rng = random.Random(length)

    def noise(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    shared = [noise(rng.randrange(length - 20, length + 150)) for _ in range(6)]
    texts = [
        noise(rng.randrange(300)) + rng.choice(shared) + noise(rng.randrange(200)) for _ in range(50)
    ]
    expected = [summary(t.encode(), g) for t, g in zip(
        texts, brute_bytes([t.encode() for t in texts], length))]
    got = suffix_dedup.remove_repeats(
        documents([(i, t, "s") for i, t in enumerate(texts)]), length=length, gram=gram
    )
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()}
    assert [found[i] for i in range(50)] == expected
    assert any(e[1] for e in expected)


def test_lengths_are_checked(documents):
    docs = documents([(1, "a", "s")])
    for length, gram in ((10, 11), (1 << 16, 32), (5, 0)):
        with pytest.raises(ValueError):
            suffix_dedup.remove_repeats(docs, length=length, gram=gram)
        with pytest.raises(ValueError):
            automaton_dedup.remove_passages(docs, length=length, gram=gram)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 4), st.randoms())
def test_longest_previous_factors(text, length, rng):
    """By previous and next smaller places in suffix order, against all pairs."""
    n = len(text)
    rank_of = list(range(n))
    rng.shuffle(rank_of)
    order = sorted(range(n), key=lambda i: text[i:])

    def common(i, j):
        k = 0
        while max(i, j) + k < n and text[i + k] == text[j + k]:
            k += 1
        return k

    first = np.array([True] + [common(a, b) < length for a, b in zip(order, order[1:])])
    got = suffix_dedup.reaches(np.array([rank_of[i] for i in order]), first)
    for place, i in enumerate(order):
        others = [common(i, j) for j in range(n) if rank_of[j] < rank_of[i]]
        assert got[place] == (max(others, default=0) >= length)


def test_more_buckets_than_partitions(documents, mess, monkeypatch):
    """Buckets follow the bytes of the texts; a task goes through its buckets one by one."""
    expected = sorted(map(str, suffix_dedup.remove_repeats(documents(mess), length=40, gram=9).collect()))
    words = sorted(map(str, automaton_dedup.remove_passages(documents(mess)).collect()))
    monkeypatch.setattr(B, "BUCKET_BYTES", 10_000)
    blocks = B.build(documents(mess), "doc_id", "text", "few")
    assert B.buckets_of(blocks) > 2 * B.partitions_of(blocks.sparkSession)
    seen = suffix_dedup.remove_repeats(documents(mess), length=40, gram=9).collect()
    # Of rows with equal ids the one read first is the earlier: the same in both runs.
    assert sorted(map(str, seen)) == expected
    assert sorted(map(str, automaton_dedup.remove_passages(documents(mess)).collect())) == words


def test_rows_of_a_block_are_bounded():
    from cohort_engine.llm.common import chunks

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": [""] * 25})
    assert [c.num_rows for c in chunks([batch], "text", rows=10)] == [10, 10, 5]
