import hashlib
import re
from collections import Counter, defaultdict

from cohort_engine.llm import exact_dedup, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_exact_duplicates(documents, mess):
    got = exact_dedup.exact_duplicates(documents(mess)).collect()
    groups = defaultdict(list)
    for i, text, _ in mess:
        groups[hashlib.sha256((text or "").encode()).hexdigest()].append(i)
    assert len(got) == len(mess)
    for digest, ids in groups.items():
        rows = [r for r in got if r.text_sha256 == digest]
        largest = max((i for i in ids if i is not None), default=None)
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in rows)
        assert {(r.keep_id, r.group_size) for r in rows} == {(largest, len(ids))}
        assert [r.doc_id for r in rows if r.kept] == [largest]


def test_without_duplicates_keeps_columns(documents, mess):
    docs = documents(mess)
    kept = exact_dedup.without_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({t or "" for _, t, _ in mess})
    assert {r.text or "" for r in rows} == {t or "" for _, t, _ in mess}


def test_exact_duplicates_of_nothing(documents):
    assert exact_dedup.exact_duplicates(documents([])).count() == 0


def test_frequent_texts_are_settled_by_broadcast(documents, monkeypatch):
    monkeypatch.setattr(exact_dedup, "TRACKED", 8)
    monkeypatch.setattr(exact_dedup, "REPORTED", 2)
    rows = [(i, "hot" if i % 2 else f"t{i // 4}", "s") for i in range(80)]
    got = exact_dedup.exact_duplicates(documents(rows)).collect()
    sizes = Counter(t for _, t, _ in rows)
    texts = {i: t for i, t, _ in rows}
    assert all(r.group_size == sizes[texts[r.doc_id]] for r in got) and len(got) == 80
    assert sum(r.kept for r in got) == len(sizes)


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed
    )


def test_quality_counts(documents, mess):
    rows = [(i, (t or "") + "\n# a | b\n# a | b\n" if i == 5 else t, s) for i, t, s in mess]
    got = quality_rules.quality_rules(documents(rows)).collect()
    found = sorted(
        (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
         r.base_failed)
        for r in got
    )
    assert found == sorted((str(i), *counts(t)) for i, t, _ in rows)
    assert not any(r.kept for r in got if r.base_failed)


def test_shared_lines_deplete_a_document(documents):
    own = " ".join(f"own{i}" for i in range(60))
    shared = " ".join(f"menu{i}" for i in range(60))
    rows = [(i, f"{own} x{i}\n  {shared.upper()} ", "h") for i in range(4)]
    rows += [(10 + i, f"{shared}\n{shared}\nshort{i}", "h") for i in range(3)]
    rows += [(20, f"{shared}\nshort", "other"), (21, f"{shared}\nshort", None)]
    got = {
        r.doc_id: r
        for r in quality_rules.quality_rules(documents(rows), max_docs=6, min_share=0.5).collect()
    }
    # 7 documents of host h have the line, upper case and spaces or not.
    assert got[0].removed_lines == [1] and got[10].removed_lines == [0, 1]
    assert got[20].removed_lines == [] and got[20].kept and got[21].kept
    assert not got[11].kept and got[11].kept_share < 0.05
    assert got[0].kept == (got[0].kept_share >= 0.5)


def test_quality_rules_of_nothing(documents):
    assert quality_rules.quality_rules(documents([])).count() == 0


def test_no_python_on_the_main_paths(documents, mess):
    docs = documents(mess)
    for out in (quality_rules.quality_rules(docs), exact_dedup.exact_duplicates(docs)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
