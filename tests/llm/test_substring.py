"""Cutting of repeats against windows compared word by word."""

import hashlib
import random
from collections import Counter

import pytest
from edge import ROWS, documents, rows_of

from cohortry.llm import queries, substring

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, window):
    words = [(id, (t or "").encode().split()) for id, t in rows]
    least = {}
    for id, w in words:
        if id is not None:
            for p in range(len(w) - window + 1):
                run = tuple(w[p : p + window])
                least[run] = min(id, least.get(run, id))
    found = []
    for id, w in words:
        gone = set()
        for p in range(len(w) - window + 1) if id is not None else ():
            if least[tuple(w[p : p + window])] < id:
                gone |= set(range(p, p + window))
        kept = b" ".join(x for n, x in enumerate(w) if n not in gone)
        found.append((id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def found_by(df, work, **options):
    return rows_of(substring.cut_repeats(df, work, **options), "id", "n_words", "n_removed", "kept_sha256")


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 50)
    found = queries.op11_substring_dedup(spark, SF_DIR)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == expected
    assert sum(r[2] > 0 for r in expected) > 20 and sum(0 < r[2] < r[1] for r in expected) > 5


@pytest.mark.parametrize("clashes, window", [(False, 50), (True, 2), (False, 3)])
def test_edge_rows(spark, work, clashes, window):
    assert found_by(documents(spark, clashes=clashes), work, window=window) == brute(ROWS, window)


def test_no_rows(spark, work):
    assert found_by(documents(spark, []), work) == []
    with pytest.raises(ValueError):
        substring.cut_repeats(documents(spark, []), work, window=1)


def spliced(seed, n=120):
    """Texts of few different words with passages of each other, branching, periodic and nested."""
    draw = random.Random(seed)
    passages = [[draw.choice("abcdefgh") for _ in range(draw.randint(3, 40))] for _ in range(12)]
    passages += [["x", "y"] * 15, ["z"] * 30, passages[0] + passages[1] + passages[2]]
    rows = []
    for id in range(n):
        words = []
        for _ in range(draw.randint(0, 4)):
            part = draw.choice(passages)
            first = draw.randint(0, len(part) // 2)
            words += part[first : first + draw.randint(1, len(part))]
            words += [f"w{draw.randint(0, 300)}" for _ in range(draw.randint(0, 3))]
        rows.append((draw.choice([id, id, id, 7, None]), draw.choice([" ", "  ", "\t", "\n"]).join(words)))
    return rows


@pytest.mark.parametrize("seed, window, piece", [(1, 5, 256), (2, 8, 3), (3, 2, 1)])
def test_branching_and_periodic_texts(spark, work, monkeypatch, seed, window, piece):
    monkeypatch.setattr(substring, "PIECE", piece)
    rows = spliced(seed)
    assert found_by(documents(spark, rows).repartition(5), work, window=window) == brute(rows, window)


def test_kept_texts(spark, work):
    rows = [(1, "a b c d e f"), (2, "x a  b c d y"), (3, "q"), (4, "a b c d e f")]
    found = substring.cut_repeats(documents(spark, rows), work, window=4, with_text=True)
    assert {r["id"]: r["kept"] for r in found.collect()} == {1: None, 2: "x y", 3: None, 4: ""}


def test_words_are_not_changed(spark, work):
    """Only ASCII white space parts words; case and marks count."""
    rows = [(1, "A b c"), (2, "a b c"), (3, "A b\x0bc"), (4, "A b c")]
    assert found_by(documents(spark, rows), work, window=2) == brute(rows, 2)


def test_colliding_hashes_are_told_apart(spark, work, monkeypatch):
    """Under the first seed all words have one hash: the comparison at the source sees it."""

    class Colliding(substring.WordHashes):
        def of(self, words):
            return super().of([b"same" if not self.seed else w for w in words])

    monkeypatch.setattr(substring, "WordHashes", Colliding)
    rows = [(1, "a b c d"), (2, "e f g h"), (3, "c d e f"), (4, "x b c d")]
    assert found_by(documents(spark, rows), work, window=3) == brute(rows, 3)


def test_paths_are_few(spark, work):
    """A long passage shared by many texts is one path, however often it is repeated."""
    passage = " ".join(f"p{n}" for n in range(100))
    rows = [(id, f"s{id} {passage} e{id}") for id in range(40)]
    docs = documents(spark, rows)
    assert found_by(docs, work, window=10) == brute(rows, 10)
    paths = spark.read.parquet(f"{work.root}/paths-0")
    assert paths.select("source.id", "piece").distinct().count() == 1 and paths.count() == 91
    spans = spark.read.parquet(f"{work.root}/spans-0").collect()
    assert Counter(s["n"] for s in spans) == {91: 39}
