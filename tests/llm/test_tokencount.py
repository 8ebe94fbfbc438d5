"""Attribution against a token-by-token count."""

from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from edge import ROWS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortry.llm import bpe, queries, tokencount

RANKS = queries.rank_file()
ENCODER = bpe.Encoder.of(RANKS, public_tokenizers.PATTERN)


def brute(text, spans, rule):
    """Each token looked at on its own."""
    data, at, tokens = text.encode(), 0, []
    for id in ENCODER.encode([text])[0]:
        tokens.append((at, at + len(ENCODER.vocabulary.tokens[id])))
        at = tokens[-1][1]
    assert at == len(data)
    counts = []
    for _, start, end in spans:
        start, end = (0, 0) if start is None or end is None or end < start else (start, end)
        lo, hi = (len(text[: max(0, x)].encode()) for x in (start, end))
        held = crossing = Fraction(0)
        for a, b in tokens:
            share = max(0, min(b, hi) - max(a, lo))
            crossing += lo < hi and (a < lo < b or a < hi < b)
            held += {"first": lo <= a < hi, "last": lo < b <= hi, "split": Fraction(share, b - a)}[rule]
        counts.append((float(held), int(crossing)))
    return counts, len(tokens)


def lines(text):
    """Spans of lines with their line feeds, cut by hand."""
    bounds = [0, *(at + 1 for at, c in enumerate(text) if c == "\n"), len(text)]
    return [(str(n), *span) for n, span in enumerate(zip(bounds, bounds[1:]))]


def offsets_of(texts):
    return tokencount.OffsetMap(texts, ENCODER.encode(texts), tokencount.token_sizes(ENCODER.vocabulary))


texts = st.text(alphabet="ab é文🙂\n.the", max_size=50)
spans = st.lists(st.tuples(st.none(), st.integers(-3, 60) | st.none(), st.integers(-3, 60) | st.none()), max_size=6)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(texts, st.none() | spans), max_size=4), st.sampled_from(tokencount.RULES))
def test_any_spans(rows, rule):
    kind = pa.list_(pa.struct([("section", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    listed = [of and [dict(zip(("section", "start", "end"), span)) for span in of] for _, of in rows]
    offsets = offsets_of([text for text, _ in rows])
    owners, (_, start, end, tokens, crossing) = tokencount._given(pa.array(listed, kind), offsets, rule)
    found = zip(owners.tolist(), start.to_pylist(), end.to_pylist(), tokens.to_pylist(), crossing.to_pylist(), strict=True)
    expected = [
        (n, *span[1:], pytest.approx(held), crossing)
        for n, (text, of) in enumerate(rows)
        for span, (held, crossing) in zip(of or (), brute(text, of or (), rule)[0], strict=True)
    ]
    assert list(found) == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(texts, max_size=4), st.sampled_from(tokencount.RULES))
def test_lines_hand_out_each_token_once(several, rule):
    offsets = offsets_of(several)
    owners, _, start, end = offsets.lines()
    base = offsets.bounds[owners]
    found = list(zip(owners.tolist(), (start - base).tolist(), (end - base).tolist(), strict=True))
    assert found == [(n, *span[1:]) for n, text in enumerate(several) for span in lines(text)]
    tokens, _ = offsets.allocate(start, end, rule)
    held = np.bincount(owners, tokens, len(several))
    assert held.tolist() == pytest.approx(offsets.counts.tolist())


def test_token_spans_cover_split_characters():
    offsets = offsets_of(["a🙂文", "", "b"])
    spans = list(zip(offsets.first.tolist(), offsets.last.tolist(), strict=True))
    assert spans[0] == (0, 1) and spans[-1] == (3, 4)
    assert all(start < end for start, end in spans)
    assert {c for start, end in spans for c in range(start, end)} == {0, 1, 2, 3}


def test_a_token_larger_than_its_sections():
    offsets = offsets_of([" international"])
    assert offsets.counts.tolist() == [1]
    start, end = np.array([0, 3, 7, 5]), np.array([3, 7, 14, 5])
    size = len(" international")
    for rule, held in (("first", [1, 0, 0, 0]), ("last", [0, 0, 1, 0]), ("split", [3 / size, 4 / size, 7 / size, 0])):
        tokens, crossing = offsets.allocate(start, end, rule)
        assert tokens.tolist() == pytest.approx(held) and crossing.tolist() == [1, 1, 1, 0]


@pytest.mark.parametrize("clashes", [False, True])
def test_documents(spark, clashes):
    docs = documents(spark, clashes=clashes)
    df = tokencount.section_tokens(docs, RANKS, public_tokenizers.PATTERN)
    expected = []
    for id, text in ROWS:
        spans = lines(text or "")
        counts, total = brute(text or "", spans, "first")
        expected += [(id, *span, *count, total) for span, count in zip(spans, counts, strict=True)]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, expected))


def test_given_sections(spark):
    kind = "doc_id long, text string, sections array<struct<section:string,start:int,end:int>>"
    rows = [
        (1, "title and body", [("title", 0, 5), ("rest", 5, 14), (None, None, 3), None]),
        (2, "no sections", None),
        (3, None, [("all", 0, 100)]),
        (4, "none at all", []),
    ]
    df = tokencount.section_tokens(
        spark.createDataFrame(rows, kind), RANKS, public_tokenizers.PATTERN, sections="sections"
    )
    found = {(r["id"], r["section"], r["start"]): r["tokens"] for r in df.collect()}
    assert df.count() == 5
    assert found == {(1, "title", 0): 1, (1, "rest", 5): 2, (1, None, None): 0, (3, "all", 0): 0}


def test_fields(spark):
    docs = spark.createDataFrame([("Héad", None, "body text")], "title string, note string, body string")
    row = tokencount.with_fields(docs, ["title", "note", "body"], "text", "sections").first()
    assert row["text"] == "Héad\n\nbody text"
    assert [row["text"][s["start"] : s["end"]] for s in row["sections"]] == ["Héad", "", "body text"]


def test_unknown_rule_and_empty_table(spark):
    with pytest.raises(ValueError):
        tokencount.section_tokens(documents(spark), RANKS, public_tokenizers.PATTERN, rule="none")
    df = tokencount.section_tokens(documents(spark, []), RANKS, public_tokenizers.PATTERN)
    assert df.collect() == []
