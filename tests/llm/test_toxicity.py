"""Noisy-or training and location, on made and on labelled documents."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import ROWS, documents

from cohortry.llm import queries, toxicity


def made(count, seed):
    """Texts in which a planted stem marks one sentence of the toxic half."""
    draw = random.Random(seed)
    words = ["".join(draw.choices("aeioulmnrst", k=draw.randint(2, 7))) for _ in range(300)]
    texts, labels = [], []
    for i in range(count):
        sentences = [" ".join(draw.choices(words, k=draw.randint(8, 14))) for _ in range(draw.randint(1, 12))]
        if i % 2:
            at = draw.randrange(len(sentences))
            sentences[at] += " zquux" + draw.choice(["a", "en", "ing"]) + " " + draw.choice(words)
        texts.append(". ".join(sentences) + ".")
        labels.append(i % 2)
    return texts, labels


def test_fit_finds_the_sentence():
    model = toxicity.fit(*made(400, 1))
    texts, labels = made(200, 2)
    for text, label in zip(texts, labels, strict=True):
        score, offending = model.judge(text)
        assert (score >= toxicity.THRESHOLD) == bool(label)
        assert len(offending) == label
        assert all("zquux" in text[start:end] for start, end, _ in offending)


def test_score_is_the_noisy_or():
    model = toxicity.fit(*made(100, 3))
    for text in made(20, 4)[0]:
        clean = np.prod([1 - model.sentence_score(words) for _, _, words in toxicity.sentences(text)])
        assert model.judge(text)[0] == pytest.approx(1 - (1 - toxicity._LEAK) * clean)


def test_length_is_no_sign_of_toxicity():
    model = toxicity.fit(*made(200, 7))
    assert model.judge(" ".join(made(1, 8)[0]) * 2000)[0] < 0.1
    assert toxicity.Model().judge("word " * 100_000)[0] == model.judge("")[0] == pytest.approx(toxicity._LEAK)


def test_sentences_cover_the_text():
    for _, text in ROWS:
        spans = toxicity.sentences(text or "")
        assert spans[0][0] == 0 and spans[-1][1] <= len(text or "")
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert all(len(words) >= toxicity.SENTENCE_WORDS for _, _, words in spans[:-1])


def test_without_both_labels_nothing_is_learnt():
    texts, _ = made(20, 5)
    for labels in ([0] * 20, [1] * 20):
        assert toxicity.fit(texts, labels).weights == {}
    assert toxicity.fit([], []).weights == {}


@pytest.mark.parametrize("clashes", [False, True])
def test_edge_documents(spark, clashes):
    docs = documents(spark, clashes=clashes)
    labels = spark.createDataFrame(
        [(1, 0), (4, 1), (4, 0), (7, 1), (8, 0), (None, 1), (99, 1), (5, None)], "doc_id long, toxic int"
    )
    model = toxicity.train(docs, labels)
    found = sorted(((r["id"], r["score"]) for r in toxicity.score(docs, model).collect()), key=repr)
    assert found == sorted(((id, model.judge(t or "")[0]) for id, t in ROWS), key=repr)
    assert all(0 <= score <= 1 for _, score in found)
    assert toxicity.score(documents(spark, []), model).collect() == []
    assert toxicity.train(documents(spark, []), labels).weights == {}


def test_sample_is_bounded_and_deterministic(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_SAMPLE", 5)
    monkeypatch.setattr(toxicity, "CLEAN_SAMPLE", 7)
    texts, labels = made(60, 6)
    docs = documents(spark, list(enumerate(texts)))
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda t, y: seen.append((list(t), y)))
    for parts in (1, 7):
        toxicity.train(docs.repartition(parts), marks.repartition(parts))
    assert seen[0] == seen[1] and sorted(seen[0][1]) == [0] * 7 + [1] * 5


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = queries.op2_toxicity(spark, sf_dir).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    hits = sum(p and t for p, t in held)
    # Some documents are marked toxic but were overwritten by junk without a trace of it.
    assert hits / sum(t for _, t in held) > 0.75
    assert hits / sum(p for p, _ in held) > 0.95


def test_labels_of_held_out_rows_are_not_read(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda docs, labels: seen.extend(labels.collect()))
    queries.toxicity_model(spark, None, "/root/testdata/sf0.001")
    assert seen and all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in seen)


def test_sample_keeps_within_its_characters(spark, monkeypatch):
    """However long the labelled documents are, a bounded number of characters is fitted."""
    fitted = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: fitted.extend(zip(map(len, texts), labels)))
    for name, value in {"TOXIC_SAMPLE": 10, "CLEAN_SAMPLE": 30, "SAMPLE_CHARS": 1000, "MEAN_CHARS": 100}.items():
        monkeypatch.setattr(toxicity, name, value)
    docs = spark.createDataFrame([(i, "word " * (i % 250)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    toxicity.train(docs, labels)
    for label, most in ((1, 1000), (0, 3000)):
        sizes = [n for n, of in fitted if of == label]
        assert sizes and max(sizes) <= 1000 and sum(sizes) <= most


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def log_clean(signs):
    """Log of the chance that a sentence isn't toxic; one without signs isn't."""
    return math.log((1 + math.exp(toxicity._BIAS)) / (1 + math.exp(max(signs, 0.0) + toxicity._BIAS)))


def plain_fit(texts, labels):
    """The same steps sentence by sentence, in dictionaries."""
    bags = [[{f for w in words for f in toxicity.features(w)} for _, _, words in toxicity.sentences(t)] for t in texts]
    held = Counter(f for bag in bags for f in set().union(*bag))
    names = {f for f, n in held.items() if n >= toxicity._RARE}
    weights, past = dict.fromkeys(names, 0.0), dict.fromkeys(names, 1e-6)
    for _ in range(toxicity._EPOCHS):
        slope = dict.fromkeys(names, 0.0)
        for bag, label in zip(bags, labels):
            signs = [sum(weights[f] for f in sentence if f in names) for sentence in bag]
            clean = math.exp(math.log1p(-toxicity._LEAK) + sum(map(log_clean, signs)))
            pull = clean / (1 - clean) if label else -1.0
            for sentence, sign in zip(bag, signs):
                for f in sentence & names:
                    slope[f] += pull * sigmoid(sign + toxicity._BIAS) * (sign >= 0)
        for f in names:
            past[f] += slope[f] ** 2
            step = toxicity._RATE / math.sqrt(past[f])
            moved = weights[f] + step * slope[f]
            weights[f] = math.copysign(max(0.0, abs(moved) - step * toxicity._SPARSITY), moved)
    return {f: w for f, w in weights.items() if w}


def test_fit_and_score_against_plain_python():
    texts, labels = made(60, 11)
    model, expected = toxicity.fit(texts, labels), plain_fit(texts, labels)
    assert set(model.weights) == set(expected) and expected
    assert all(model.weights[f] == pytest.approx(w, rel=1e-6, abs=1e-6) for f, w in expected.items())
    for text in [*texts, *made(10, 12)[0], "", "nothing known"]:
        clean = 1 - toxicity._LEAK
        for _, _, words in toxicity.sentences(text):
            hits = {f for w in words for f in toxicity.features(w)} & set(expected)
            clean *= math.exp(log_clean(sum(expected[f] for f in hits)))
        assert model.judge(text)[0] == pytest.approx(1 - clean, rel=1e-6, abs=1e-6)
