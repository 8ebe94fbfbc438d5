"""The homomorphism, and the documents' order, against plain Python."""

import random

import pytest
import xxhash
from edge import ROWS, documents
from pyspark.sql import functions as F

from cohortry.llm import multiset, queries


def prints(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    rows = df.select("n", multiset.digest(multiset.fingerprint(F.col("text"))).alias("d")).collect()
    return [r["d"] for r in sorted(rows)]


def test_order_does_not_matter_but_counts_do(spark):
    a, b, c, d, e = prints(spark, "x. y.\nz\nw", "w\nx. y.\nz", "x. y.\nz\nw\nw", "x. y.\nz", "y. x.\nz\nw")
    assert a == b and len({a, c, d, e}) == 4


def test_empty_texts(spark):
    found = prints(spark, "", None, "\n\n")
    assert len(set(found)) == 1 and set(found[0]) == {"0"}


def test_insert_and_delete(spark):
    lines = ["first line. two sentences", "second", "second", "third line!", "été 文字"]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(lines[:-1]), lines[-1])], "a string, b string, p string")
    whole, part, line = (multiset.fingerprint(F.col(c)) for c in "abp")
    df = df.select(whole.alias("whole"), part.alias("part"), line.alias("line"), "p")
    row = df.select(
        multiset.digest(F.col("whole")).alias("whole"),
        multiset.digest(F.col("part")).alias("part"),
        multiset.digest(multiset.insert(F.col("part"), F.col("p"))).alias("inserted"),
        multiset.digest(multiset.delete(F.col("whole"), F.col("p"))).alias("deleted"),
    ).first()
    assert row["inserted"] == row["whole"] and row["deleted"] == row["part"]


def test_likeness_follows_shared_sentences(spark):
    draw = random.Random(2)
    sentences = [" ".join(draw.choices("abcdefgh", k=9)) for _ in range(120)]
    pairs = [(share, sentences[:60], sentences[:share] + sentences[60 : 120 - share]) for share in range(0, 61, 15)]
    rows = [(n, ". ".join(a), ". ".join(b)) for n, a, b in pairs]
    df = spark.createDataFrame(rows, "n int, a string, b string")
    df = df.select("n", multiset.fingerprint(F.col("a")).alias("a"), multiset.fingerprint(F.col("b")).alias("b"))
    found = {r["n"]: r["near"] for r in df.select("n", multiset.likeness(F.col("a"), F.col("b")).alias("near")).collect()}
    assert found[60] == 1
    assert all(0 <= near <= 1 and abs(near - n / 60) < 0.3 for n, near in found.items())


def test_negative_counters_do_not_borrow(spark):
    """Every counter of a difference is read back, whatever the signs."""
    texts = ["\n".join(f"s{i}" for i in range(n)) for n in (0, 1, 7, 300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(multiset.fingerprint(F.col("t")).alias("f"))
    band = F.slice("f", multiset.EXACT + 1, multiset.LIKE)
    for row in df.select(band.alias("lanes"), multiset._squares(band).alias("squares")).collect():
        counts = []
        for lane in row["lanes"]:
            for _ in range(multiset._COUNTERS):
                digit = (lane + 128) % 256 - 128
                counts.append(digit)
                lane = (lane - digit) >> 8
        assert sum(c * c for c in counts) == row["squares"]


def place(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64 if value >> 63 else 0)


def check_next(found, rows):
    """Rows of one id go by their texts' hashes; nulls come first."""
    order = sorted(((id is not None, id or 0, place(t or ""), t or "") for id, t in rows))
    expected = [
        (id if known else None, text, order[(i + 1) % len(order)][3]) for i, (known, id, _, text) in enumerate(order)
    ]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


HOT = [(draw % 3 and (7 if draw % 3 == 1 else draw) or None, f"text {draw}") for draw in range(900)]


@pytest.mark.parametrize("rows", [HOT, HOT[:300] + [(7, "same")] * 200, [(None, str(n)) for n in range(200)], [(7, str(n)) for n in range(200)]])
def test_next_of_frequent_ids(spark, rows):
    """A third of the rows without id and a third of one id: both are parted by the texts' hashes."""
    found = multiset.fingerprint_documents(documents(spark, rows)).collect()
    check_next([(r["id"], r["text"], r["next_text"]) for r in found], rows)


def test_frequent_ids_are_many_slices(spark):
    rows = documents(spark, HOT).selectExpr("doc_id AS id", "xxhash64(text) AS place")
    sizes = [r["count"] for r in multiset._sliced(rows, 60).groupBy("own").count().collect()]
    assert sum(sizes) == 900 and max(sizes) <= 3 * 900 / 60


@pytest.mark.parametrize("kind", ["string", "double"])
def test_ids_have_to_be_whole_numbers(spark, kind):
    with pytest.raises(TypeError, match="whole numbers"):
        multiset.fingerprint_documents(documents(spark).withColumn("doc_id", F.col("doc_id").cast(kind)))


@pytest.mark.parametrize("clashes", [False, True])
def test_next_rows(spark, clashes):
    df = multiset.fingerprint_documents(documents(spark, clashes=clashes))
    found = df.collect()
    check_next([(r["id"], r["text"], r["next_text"]) for r in found], ROWS)
    own = {r["text"]: r["fingerprint"] for r in found}
    assert all(r["next_fingerprint"] == own[r["next_text"]] for r in found)


@pytest.mark.parametrize("rows", [[], [(5, "alone")], [(5, "a"), (5, "a"), (5, "b")], [(None, "x"), (None, None)], [(-3, "a"), (9, "b")]])
def test_next_of_few_rows(spark, rows):
    found = multiset.fingerprint_documents(documents(spark, rows)).collect()
    check_next([(r["id"], r["text"], r["next_text"]) for r in found], rows)


def test_next_of_many_rows(spark):
    draw = random.Random(4)
    rows = [(draw.randint(-500, 500) ** 3, str(draw.random())) for _ in range(600)]
    found = multiset.fingerprint_documents(documents(spark, rows)).collect()
    check_next([(r["id"], r["text"], r["next_text"]) for r in found], rows)


def test_table(spark):
    import hashlib

    rows = queries.op3_fingerprints(spark, "/root/testdata/sf0.001").collect()
    docs = sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect(), key=lambda d: d["doc_id"])
    found = {r["doc_id"]: r for r in rows}
    by_print = {}
    for i, d in enumerate(docs):
        r, n, following = found[d["doc_id"]], len(d["text"]), docs[(i + 1) % len(docs)]["text"]
        edited = d["text"][: n - n // 2] + following[: n // 2]
        assert r["n_chars"] == n
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        by_print.setdefault(r["fingerprint"], set()).add(d["text"])
    assert len(found) == len(docs)
    # Texts with one fingerprint have the same lines, in whatever order.
    assert all(len({tuple(sorted(filter(None, t.split("\n")))) for t in same}) == 1 for same in by_print.values())
    assert sum(r["near_edited"] for r in rows) > 5 * sum(r["near_next"] for r in rows)


def test_plan_is_native(spark):
    plan = queries.op3_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("k", [256, 512, 65536])
def test_repeated_sentences_count_fully(spark, k):
    """Half of a text that repeats one line is replaced: likeness is that of the true counts."""
    line, other = "this very line is found again and again.", "something else is written here instead."
    texts = [(line + "\n") * k, (line + "\n") * (k // 2) + (other + "\n") * (k // 2)]
    df = spark.createDataFrame([tuple(texts)], "a string, b string")
    df = df.select(multiset.fingerprint(F.col("a")).alias("a"), multiset.fingerprint(F.col("b")).alias("b"))
    row = df.select(multiset.likeness(F.col("a"), F.col("b")).alias("near"), F.slice("a", multiset.EXACT + 1, multiset.LIKE).alias("lanes")).first()
    # |a|^2 = k^2, |b|^2 = k^2 / 2, |a - b|^2 = k^2 / 2; lines may meet in a bin.
    assert abs(row["near"] - 2 / 3) < 0.1
    counts = [(lane + (1 << 31)) % (1 << 32) - (1 << 31) for lane in row["lanes"]]
    assert all(c % k == 0 for c in counts) and any(counts)


def likenesses(spark, pairs):
    df = spark.createDataFrame([(n, *pair) for n, pair in enumerate(pairs)], "n int, a string, b string")
    df = df.select("n", multiset.fingerprint(F.col("a")).alias("a"), multiset.fingerprint(F.col("b")).alias("b"))
    rows = df.select("n", multiset.likeness(F.col("a"), F.col("b")).alias("near")).collect()
    return [r["near"] for r in sorted(rows)]


@pytest.mark.parametrize("mark", [" ", "; ", "\u3002", ""])
def test_one_long_sentence_shares_its_half(spark, mark):
    """Texts without sentence marks, or without spaces, are like their edited text."""
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz" if mark.endswith(" ") else [chr(0x4E00 + i) for i in range(2000)]
    pairs = []
    for _ in range(8):
        a, b = (mark.join("".join(draw.choices(letters, k=6)) for _ in range(200)) for _ in range(2))
        half = len(a) // 2
        pairs += [(a, a[:half] + b[half:]), (a, b)]
    found = likenesses(spark, pairs)
    for edited, following in zip(found[::2], found[1::2]):
        assert edited > following and 0.2 < edited < 0.8


def test_documents_are_nearest_to_their_own_half(spark):
    """Every document of the table, except where so little text has chance in it."""
    rows = queries.op3_fingerprints(spark, "/root/testdata/sf0.01").where("n_chars >= 1000").collect()
    assert rows and all(r["near_edited"] > r["near_next"] for r in rows if r["near_next"] < 0.3)


def test_exact_lanes_are_cut_from_the_paragraphs_digest(spark):
    import hashlib

    lines = ["first line", "second", "second", "été 文字"]
    cuts = [[int(hashlib.sha256(t.encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(8)] for t in lines]
    expected = "".join(f"{sum(lanes) % (1 << 32):08x}" for lanes in zip(*cuts))
    assert prints(spark, "\n".join(lines))[0][: len(expected)] == expected
