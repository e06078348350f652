import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from test_similar import brute

import corpus_pipeline
from cohort_engine.llm import bpe, exact_dedup, jaccard, mixing, quality_model


def corpus(n=240):
    rng = random.Random(1)
    good = [f"{a}{b}" for a in ("tion", "ment", "able", "over") for b in ("er", "al", "ist", "um")]
    rows, labels = [], []
    for i in range(n):
        text = " ".join(rng.choice(good) for _ in range(80))
        if i % 4 == 0:
            text = "".join(f"{w}### %%% " for w in text.split())
        rows.append((i, text, f"s{i % 2}"))
        labels.append((i, int(i % 4 != 0)))
    return rows, labels


def test_classifier_learns_from_rows_not_held_out(documents, spark):
    rows, labels = corpus()
    docs = documents([*rows, (None, None, "s"), (7, rows[7][1], "s")])
    wrong = [(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, y in labels]
    first = quality_model.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    table = spark.createDataFrame(
        [*wrong, (None, 1), (9_999, 0), (3, None)], "doc_id long, quality int"
    )
    model = quality_model.train(docs, table)
    assert np.array_equal(model.gain, first.gain) and model.bias == first.bias
    got = quality_model.score(docs, model).collect()
    assert len(got) == len(rows) + 2
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert r.predicted == truth[r.doc_id]
    assert quality_model.score(documents([]), model).count() == 0


def test_scores_of_a_batch_are_those_of_each_text():
    rows, labels = corpus(40)
    texts = [t for _, t, _ in rows]
    model = quality_model.fit(texts, [y for _, y in labels])
    texts += ["", "a", "é ü", " "]
    alone = np.concatenate([model.scores([t]) for t in texts])
    assert np.allclose(model.scores(texts), alone)
    assert quality_model.fit([], []).scores(["x"]) == 0.5
    assert quality_model.fit(["x"], [1]).scores(["x"])[0] > 0.99


def test_stages_and_the_whole(spark, documents, tmp_path):
    rng = random.Random(8)
    rows, labels = corpus()
    base = " ".join(rng.choice(rows)[1] for _ in range(2))
    rows += [(500 + i, base, "s1") for i in range(4)]
    rows += [(600 + i, base.replace("tioner", f"x{i}", 1), None) for i in range(4)]
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality_classifier",
        "exact_dedup",
        "ngram_jaccard_join",
        "mixing",
        "bpe",
    ]
    folder = str(tmp_path)

    def plain(df):
        assert df.columns == docs.columns
        return sorted((str(r.doc_id), r.text, r.source) for r in df.collect())

    kept = stages["quality_classifier"](spark, docs, folder)
    model = quality_model.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = {r.doc_id for r in quality_model.score(docs, model).collect() if r.predicted == 1}
    assert plain(kept) == sorted((str(i), t, s) for i, t, s in rows if i in good)
    truth = dict(labels)
    assert all(i in good for i, y in truth.items() if y) and len(good) < len(rows)

    unique = stages["exact_dedup"](spark, docs, folder)
    last = {t: (str(i), t, s) for i, t, s in sorted(rows)}
    assert plain(unique) == sorted(last.values())

    apart = stages["ngram_jaccard_join"](spark, docs, folder)
    assert apart.count() == brute(rows)[1]
    assert apart.filter("doc_id >= 500").count() == 1

    times = {r.doc_id: r.passes for r in mixing.mix(docs).collect()}
    assert plain(stages["mixing"](spark, docs, folder)) == sorted(
        (str(i), t, s) for i, t, s in rows for _ in range(times[i])
    )

    tokens = stages["bpe"](spark, docs, folder)
    with open(public_tokenizers.path(corpus_pipeline.RANKS), "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    tool = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    assert {r.doc_id: r.ids for r in tokens.collect()} == {
        i: tool.encode_ordinary(t) for i, t, _ in rows
    }

    # The whole, from one stage to the next.
    now = quality_model.accepted(docs, model)
    now = jaccard.one_of_each(exact_dedup.without_duplicates(now))
    expected = sorted(
        (r.doc_id, hashlib.sha256(r.text.encode()).hexdigest())
        for r in mixing.mixed_documents(now).collect()
    )
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.decoded_sha256) for r in found) == expected


def test_stages_with_nulls_ties_and_nothing(spark, documents, mess, tmp_path):
    """Each stage on rows with nulls, empty texts, ties and copies, and on an empty table."""
    from pyspark.sql import functions as F

    rows = [r for r in mess if len(r[1] or "") < 5_000]
    docs = documents(rows)
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(30)] + [(None, 1), (3, None)], "doc_id long, quality int"
    )
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    empty = docs.filter("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        kept = out.collect()
        assert stage(spark, empty, str(tmp_path)).count() == 0
        if name == "bpe":
            nothing = [r for r in kept if r.doc_id in (400, 401)]
            assert len(kept) == len(rows) and [r.n_tokens for r in nothing] == [0, 0]
            continue
        assert out.columns == docs.columns
        got = [(r.doc_id, r.text, r.source) for r in kept]
        assert set(got) <= set(rows)
        if name == "exact_dedup":
            texts = [t or "" for _, t, _ in got]
            assert len(set(texts)) == len(texts) and set(texts) == {t or "" for _, t, _ in rows}
        if name == "ngram_jaccard_join":
            # Documents without words are like no other and stay.
            blank = [r for r in rows if not (r[1] or "").strip()]
            assert sorted(map(str, (g for g in got if not (g[1] or "").strip()))) == sorted(map(str, blank))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} <= {r[0] for r in rows}
    empty.write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.filter(F.lit(False)).write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_scans_of_nothing(documents):
    from cohort_engine.llm import pii, secrets

    empty = documents([(1, "a", "s")]).filter("false")
    assert secrets.secrets_digest(secrets.scan_secrets(empty)).collect() == []
    assert pii.identifiers_digest(pii.scan_identifiers(empty)).collect() == []
