"""Encoding against the tokenizer library, decoding as an exact round trip."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from edge import ROWS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortry.llm import bpe, queries

RANKS = queries.rank_file()
VOCABULARY = bpe.Vocabulary.parse(RANKS)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCABULARY.ids, special_tokens={}
)


def encode(*texts):
    return bpe.Encoder(VOCABULARY, public_tokenizers.PATTERN).encode(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=200), max_size=5))
def test_random_texts(texts):
    assert encode(*texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_pieces_of_all_lengths():
    draw = random.Random(3)
    texts = ["".join(draw.choices("abehinorst", k=n)) for n in [*range(1, 70), 127, 128, 129, 3000]]
    texts += ["a" * 2000, " " * 500 + "x", "!" * 333, "ab" * 700, "文" * 200]
    assert encode(*texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_one_and_many_agree():
    draw = random.Random(5)
    pieces = [bytes(draw.choices(range(256), k=draw.randint(1, bpe.SHORT))) for _ in range(300)]
    many = bpe.merge_many(pieces, VOCABULARY)
    assert [list(ids) for ids in many] == [bpe.merge_one(p, VOCABULARY) for p in pieces]
    assert [VOCABULARY.decode(ids) for ids in many] == pieces


def test_a_full_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(bpe, "_CACHED_PIECES", 2)
    encoder = bpe.Encoder(VOCABULARY, public_tokenizers.PATTERN)
    for text in ("several words here", "and other words there", "several words again"):
        assert encoder.encode([text]) == [LIBRARY.encode_ordinary(text)]


def test_portions_cover_all_rows(monkeypatch):
    monkeypatch.setattr(bpe, "_BYTES_AT_ONCE", 10)
    for sizes in ([], [0], [3, 4, 5, 20, 0, 0, 9, 1], [30, 30]):
        bounds = list(bpe.in_portions([b"x" * n for n in sizes]))
        assert [i for a, b in bounds for i in range(a, b)] == list(range(len(sizes)))


@pytest.mark.parametrize("clashes", [False, True])
def test_documents(spark, clashes):
    df = bpe.encode(documents(spark, clashes=clashes), RANKS, public_tokenizers.PATTERN, decode=True)
    found = sorted(((r["id"], r["ids"], bytes(r["decoded"])) for r in df.collect()), key=repr)
    expected = [(id, LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for id, t in ROWS]
    assert found == sorted(expected, key=repr)
    again = bpe.decode(df, RANKS).collect()
    assert sorted(bytes(r["decoded"]) for r in again) == sorted(x[2] for x in expected)


def test_query_digests(spark):
    found = queries.encoded_documents(documents(spark)).collect()
    expected = []
    for id, text in ROWS:
        ids = LIBRARY.encode_ordinary(text or "")
        digests = (hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode()))
        expected.append((id, len(ids), *digests))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_empty_table(spark):
    assert queries.encoded_documents(documents(spark, [])).collect() == []
