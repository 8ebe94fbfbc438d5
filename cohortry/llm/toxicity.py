"""Toxicity by multiple-instance learning.

A document is a bag of sentences and is toxic if at least one of them is. Only documents are
labelled, so sentence scores are trained through the noisy-or that combines them: ``P(document) = 1
- (1 - leak) * prod(1 - p(sentence))``. A sentence without any sign of toxicity has the score 0, so
a text doesn't become suspicious by being long; the leak is what a text without any sign scores.
The trained sentence scores then locate the offending sentences.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import pick

#: A document this likely to be toxic is rejected.
THRESHOLD = 0.7
#: Sentences this likely to be toxic are reported.
OFFENDING = 0.5
#: Bounds of the training sample: documents of each label, characters of a document, and of all
#: documents of a label, for each of those that it may have.
TOXIC_SAMPLE, CLEAN_SAMPLE, SAMPLE_CHARS, MEAN_CHARS = 800, 3200, 50_000, 5_000
#: A sentence has so many words at least; shorter ones are joined to the next, so that
#: a text cut into many scraps isn't many chances to be toxic.
SENTENCE_WORDS = 8
_PREFIXES = (3, 4, 5, 6)
_FEATURES = 1 << 20
_RARE = 5
_BIAS, _LEAK = -6.5, 0.01
_SPARSITY, _RATE, _EPOCHS = 0.3, 1.0, 100
_CACHED_WORDS = 200_000

_SPAN = ("start", "end", "score")
_PIECE = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")
_WORD = re.compile(r"\w+")


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """Start, end and lower-case words of each sentence; one empty one if there is no text."""
    found, begin, words = [], 0, []
    for piece in _PIECE.finditer(text):
        words += _WORD.findall(piece.group().lower())
        if len(words) >= SENTENCE_WORDS:
            found.append((begin, piece.end(), words))
            begin, words = piece.end(), []
    if words or not found:
        found.append((begin, len(text), words))
    return found


def features(word: str) -> list[int]:
    """The word itself and its beginnings, so that inflected forms share what they mean; hashed."""
    parts = [f"{word}$", *(word[:n] for n in _PREFIXES if len(word) > n)]
    return [zlib.crc32(part.encode()) % _FEATURES for part in parts]


@dataclass
class Model:
    """Weights of features; a sentence's log-odds are their sum and a constant."""

    weights: dict[int, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._known: dict[str, tuple[int, ...]] = {}

    def sentence_score(self, words: Iterable[str]) -> float:
        hits: set[int] = set()
        for word in words:
            known = self._known.get(word)
            if known is None:
                if len(self._known) >= _CACHED_WORDS:
                    self._known.clear()
                known = tuple(f for f in features(word) if f in self.weights)
                self._known[word] = known
            if known:
                hits.update(known)
        return float(-np.expm1(_log_clean(sum(self.weights[f] for f in sorted(hits)))))

    def judge(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score and its offending sentences."""
        clean, offending = np.log1p(-_LEAK), []
        for start, end, words in sentences(text):
            p = self.sentence_score(words)
            clean += np.log1p(-min(p, 1 - 1e-12))
            if p >= OFFENDING:
                offending.append((start, end, p))
        return float(-np.expm1(clean)), offending


def fit(texts: Iterable[str], toxic: Sequence[int]) -> Model:
    """Noisy-or training by proximal AdaGrad on the documents' likelihood.

    Features of fewer than five documents are left out, and weights that don't earn their place are
    zero.
    """
    cells, sizes, lengths = array("i"), array("i"), array("i")  # features of sentences of documents
    documents = np.zeros(_FEATURES, np.int32)
    for text in texts:
        bag = [{f for w in words for f in features(w)} for _, _, words in sentences(text)]
        lengths.append(len(bag))
        sizes.extend(map(len, bag))
        for sentence in bag:
            cells.extend(sentence)
        documents[list(set().union(*bag))] += 1
    names = np.flatnonzero(documents >= _RARE)
    if not len(names) or len(set(toxic)) < 2:
        return Model()
    column = np.full(_FEATURES, -1, np.int32)
    column[names] = np.arange(len(names))
    col = column[np.frombuffer(cells, np.int32)]
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[col >= 0]
    col = col[col >= 0]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    y = np.array(toxic)

    weights, past = np.zeros(len(names)), np.full(len(names), 1e-6)
    for _ in range(_EPOCHS):
        signs = np.bincount(row, weights[col], len(sizes))
        clean = np.log1p(-_LEAK) + np.bincount(owner, _log_clean(signs), len(lengths))
        # d log P(label) / d signs of a sentence; one below 0 counts as 0 and has no slope.
        pull = np.where(y == 1, np.exp(clean) / -np.expm1(clean), -1.0)[owner]
        pull *= np.where(signs >= 0, _sigmoid(signs + _BIAS), 0)
        slope = np.bincount(col, pull[row], len(names))
        past += slope**2
        step = _RATE / np.sqrt(past)
        weights += step * slope
        weights = np.sign(weights) * np.maximum(0, np.abs(weights) - step * _SPARSITY)
    return Model({int(names[i]): float(weights[i]) for i in np.flatnonzero(weights)})


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic"
) -> Model:
    """Fit a model to a bounded sample of labelled documents.

    The sample takes each label's first documents by a hash of the id, as far as their characters
    keep within the bound for all, and leaves out very long ones. A document labelled both ways counts as toxic, null labels not at
    all, repeated ids once. Without documents of both labels the model knows
    no word and gives every document the same small score.
    """
    known = pick(labels, id=id, toxic=toxic).where("id is not null and toxic is not null")
    known = known.groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("id"), F.col("id")]
    toxics = known.where("toxic = 1").orderBy(*order).limit(TOXIC_SAMPLE)
    cleans = known.where("toxic = 0").orderBy(*order).limit(CLEAN_SAMPLE)
    # The limits bound the broadcast and what is brought here.
    sample = toxics.union(cleans).select(F.col("id").alias("of"), "toxic")
    texts = pick(docs, id=id, text=text).where(F.length("text") <= SAMPLE_CHARS)
    found = (
        texts.join(F.broadcast(sample), F.col("id") == F.col("of"))
        .groupBy("id")
        .agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    )
    # As many rows as the sample has at most.
    upto = Window.partitionBy("toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("upto", F.sum(F.length("text")).over(upto))
    most = F.when(F.col("toxic") == 1, TOXIC_SAMPLE).otherwise(CLEAN_SAMPLE) * MEAN_CHARS
    found = found.where(F.col("upto") <= most).collect()
    found.sort(key=lambda r: r["id"])
    return fit((r["text"] for r in found), [r["toxic"] for r in found])


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, score, offending)`` per row of ``docs``.

    ``offending`` lists start, end (in characters) and score of the sentences that are more likely
    toxic than not. An empty or null text is one sentence without words and scores the leak. Rows
    come out as they come in, also repeated ones and those without id.
    """
    rows = pick(docs, id=id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    kinds = pa.list_(pa.struct(list(zip(_SPAN, [pa.int32(), pa.int32(), pa.float64()]))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.judge(x) for x in batch.column(1).to_pylist()]
            scores = pa.array([s for s, _ in found], pa.float64())
            offending = [[dict(zip(_SPAN, x, strict=True)) for x in spans] for _, spans in found]
            columns = [batch.column(0), scores, pa.array(offending, kinds)]
            yield pa.record_batch(columns, ["id", "score", "offending"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id {kind}, score double, offending array<struct<start:int,end:int,score:double>>"
    )


def clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``THRESHOLD``, with all their columns.

    Each row goes by its own text, whatever other rows of its id score. A null text is an empty one.
    """
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = (model.judge(x or "")[0] for x in batch.column(at).to_pylist())
            yield batch.filter(pa.array([score < THRESHOLD for score in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _log_clean(signs):
    """log(1 - p) of a sentence: what its signs add to the odds of one without any."""
    return np.minimum(0.0, np.logaddexp(0, _BIAS) - np.logaddexp(0, signs + _BIAS))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
