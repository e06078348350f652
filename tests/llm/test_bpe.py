import hashlib

import public_tokenizers
import pytest
import tiktoken

from cohort_engine.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return bpe.Codec(bpe.parse_ranks(file.read()), public_tokenizers.PATTERN)


TEXTS = [
    "",
    " ",
    "it's   we'll\n\n  they've  \t x " * 30,
    "a" * 500,
    " " * 300,
    "ünï    cödé\x1c\x1d 123 456!!! <|endoftext|> 𝐦𝐚 " * 20,
    "word\n" * 200 + " \n \n" * 50 + "　" * 9,
]


@pytest.mark.parametrize("chunk, overlap", [(7, 3), (40, 16), (64, 1), (1 << 16, 1 << 10)])
def test_chunks_give_the_ids_of_the_whole(codec, chunk, overlap):
    for text in TEXTS:
        ids = [i for part in codec.encode(text, chunk, overlap) for i in part]
        assert ids == codec.encoding.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_encode_documents(documents, mess):
    ranks = bpe.parse_ranks(open(PATH, "rb").read())
    tool = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    out = bpe.encode_documents(documents(mess), PATH, public_tokenizers.PATTERN, chunk=1_000)
    expected = []
    for i, text, _ in mess:
        ids = tool.encode_ordinary(text or "")
        expected.append(
            (
                str(i),
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(),
            )
        )
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()]
    assert sorted(got) == sorted(expected)
    assert all(len(r.ids) == r.n_tokens for r in out.collect())
    nothing = bpe.encode_documents(documents([]), PATH, public_tokenizers.PATTERN, with_ids=False)
    assert nothing.count() == 0 and "ids" not in nothing.columns


@pytest.mark.parametrize("chunk, overlap", [(16, 4), (40, 16), (64, 40)])
def test_chunks_of_long_texts_are_rows(documents, chunk, overlap):
    """Encoded chunk by chunk by different tasks: the ids of the whole, cuts or not."""
    tool = bpe.Codec(bpe.parse_ranks(open(PATH, "rb").read()), public_tokenizers.PATTERN)
    texts = [*TEXTS, "x" * 1_000, "ab" * 300 + " some words then " + "y" * 500 + " z", "it's " * 200]
    rows = [(i, text, "s") for i, text in enumerate(texts)] + [(0, texts[3], "s"), (None, texts[2], "s")]
    out = bpe.encode_documents(
        documents(rows), PATH, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap
    ).collect()
    got = sorted((str(r.doc_id), list(r.ids), r.ids_sha256, r.decoded_sha256) for r in out)
    expected = []
    for i, text, _ in rows:
        ids = tool.encoding.encode_ordinary(text)
        joined = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((str(i), ids, joined, hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(expected)
    assert sum(len(t) > bpe.PARALLEL * chunk for t in texts) >= 6
