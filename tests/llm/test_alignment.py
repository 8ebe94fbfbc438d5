"""Alignment against token pairs compared one by one."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from edge import ROWS, documents, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortry.llm import alignment, queries

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokens_of(text):
    """Both token sequences as (id, bytes), straight from the libraries."""
    level = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    byte_of = {chr(b): b for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in shown):
        byte_of[chr(256 + n)] = b
    one = level.encode(" " + text, add_special_tokens=False)
    a = [(id, bytes(byte_of[c] for c in name)) for id, name in zip(one.ids, one.tokens)]
    b = []
    for id in pieces.encode(text):
        name = pieces.id_to_piece(id)
        is_byte = len(name) == 6 and name.startswith("<0x") and pieces.is_byte(id)
        b.append((id, bytes([int(name[3:5], 16)]) if is_byte else name.replace("▁", " ").encode()))
    if not text or any(b"".join(x for _, x in t) != (" " + text).encode() for t in (a, b)):
        return [], []
    return a, b


def groups_of(a, b):
    def ends(tokens):
        return np.cumsum([len(x) for _, x in tokens]).tolist()

    shared = sorted(set(ends(a)) & set(ends(b)))
    found = [([], []) for _ in shared]
    for side, tokens in enumerate((a, b)):
        group = 0
        for (id, _), end in zip(tokens, ends(tokens)):
            found[group][side].append(id)
            group += end == shared[group]
    return found


def brute(rows):
    texts = [(id, *tokens_of(text or "")) for id, text in rows]
    groups = [groups_of(a, b) for _, a, b in texts]
    links = [Counter((x, y) for xs, ys in g for x in xs for y in ys) for g in groups]
    counts = Counter(pair for of in links for pair in of)
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    found = []
    for (id, a, b), g, of in zip(texts, groups, links):
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g)
        found.append(
            (
                id, len(a), len(b), len(g), sum(of.values()), sum(n for p, n in of.items() if counts[p] == best[p[0]]),
                sum(n * counts[p] for p, n in of.items()), hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return sorted(found, key=repr)


def found_by(df, work):
    return rows_of(alignment.align(df, work, *queries.tokenizer_files()), "id", *COLUMNS)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    expected = brute([(r["doc_id"], r["text"]) for r in docs])
    found = queries.op13_alignment(spark, "/root/testdata/sf0.001")
    assert rows_of(found, "doc_id", *COLUMNS) == expected
    assert sum(r[3] > 0 for r in expected) > 100


ODD = [
    (20, " leading space"), (21, "trailing space "), (22, "two  spaces"), (23, "x▁y"), (24, "<|endoftext|> and <s> here"),
    (25, "ﬁ ligature"), (26, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"), (27, "=" * 100 + "\n\n\n"),
    (28, "文字文字 кириллица 🙂🙂"), (29, "\n" * 40 + "x"), (30, "<0x0A> 0x41"), (31, "a\x00b"), (32, "it's 1234567"),
]


@pytest.mark.parametrize("clashes", [False, True])
def test_edge_rows(spark, work, clashes):
    rows = [r for r in ROWS if r[0] != 4] + ODD + [(4, ROWS[3][1][:3000])]
    expected = brute(rows)
    assert found_by(documents(spark, rows, clashes=clashes).repartition(3), work) == expected
    assert sum(r[1] > 0 for r in expected) > 15


def test_no_rows(spark, work):
    assert found_by(documents(spark, []), work) == []


def test_quick_and_library_encoders_agree(spark):
    level = alignment.ByteLevel(queries.tokenizer_files()[0])
    texts = [t for _, t in ODD] + [" " * 3000 + "x", "word " * 500, "\n" * 5000]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert level.quick
    found, level.quick = level.encode(texts), None
    assert found == level.encode(texts)


ends = st.lists(st.integers(1, 6), min_size=1, max_size=30)


@settings(max_examples=300, deadline=None)
@given(ends, ends)
def test_terminals_are_the_components(first, second):
    a, b = np.cumsum(first), np.cumsum(second)
    last = max(a[-1], b[-1])
    a, b = (np.append(x, last) if x[-1] < last else x for x in (a, b))
    label = alignment.terminals(alignment.successors(a, b))
    shared = np.intersect1d(a, b)
    of_end = np.searchsorted(shared, np.concatenate([a, b]), "left")
    assert label.tolist() == (len(a) + np.searchsorted(b, shared))[of_end].tolist()


def test_a_large_group_makes_few_pairs():
    """Repeated ids are counted before they are paired."""
    sizes = np.array([0, 3, 5])
    a, b = (alignment.Tokens.of([[id] * n], sizes) for id, n in ((1, 4999), (2, 3000)))
    b = alignment.Tokens(np.append(b.ids[:-1], 2), np.append(b.ends[:-3] + 1, a.ends[-1]), b.texts[:2998])
    found = alignment.Aligned.of(a, alignment.Tokens(b.ids[: len(b.ends)], b.ends, b.texts))
    text, pair, times = found.links()
    assert len(set(zip(text.tolist(), pair.tolist()))) == len(pair) == 1 and times[0] >= 4999
