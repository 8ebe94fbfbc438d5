"""Substring dedup by De Bruijn compaction: repeated runs of words are cut out of all but one text.

A window of ``window`` words is an edge from the node of its first ``window - 1`` words to the node of
its last ones. Edges found under two ids are repeated; each knows its source, the place where it
starts under the smallest id. Where the node between two repeated edges has no other way in or out
and their sources are neighbours, they are one path, so long repeated spans become few rows. The words
of each path, read at its source, go to every place that repeats a part of it and are compared with
what stands there, before anything is cut.

Only few windows become edges. Each window has an anchor, the smallest hash among the shorter runs of
words in it, so equal windows have equal anchors and neighbouring windows mostly the same one; windows
whose anchor is in one text only are unique and never leave their text. Equal texts are one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.bpe import in_portions
from cohortry.llm.common import pick, utf8
from cohortry.sources.results import Workspace

WINDOW = 50
#: Words of the runs that anchors are chosen from, as a share of the window.
ANCHOR_SHARE = 0.4
#: Edges of a path that are one row at most.
PIECE = 256
#: Hash seeds to try, should windows collide.
_SEEDS = 8
_CACHED_WORDS = 250_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: The multiplier's inverse modulo 2^64.
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


class WordHashes(dict):
    """Hashes of words, of which a bounded number is remembered."""

    def __init__(self, seed: int) -> None:
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return found

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spreads hashes over all 64 bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Powers:
    """Powers of the multiplier and of its inverse, as many as were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, base)))
                for base in (_ODD, _ODD_INVERSE)
            )
        return self.up[:n], self.down[:n]


class Runs:
    """Hashes of runs of words over several texts, one after the other."""

    def __init__(self, texts: Sequence[Sequence[bytes]], hashes: WordHashes, powers: Powers, window: int) -> None:
        self.window = window
        self.sizes = np.array([len(words) for words in texts], np.int64)
        words = hashes.of(list(chain.from_iterable(texts)))
        up, self._down = powers.upto(len(words) + 1)
        self._sums = np.append(np.uint64(0), np.cumsum(words * up[:-1], dtype=np.uint64))
        #: The texts of the windows, where these start among all words, and in their texts.
        self.text = np.repeat(np.arange(len(texts)), np.maximum(self.sizes - window + 1, 0))
        ends = np.cumsum(np.maximum(self.sizes - window + 1, 0))
        firsts = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.text)) - np.append(0, ends)[self.text]
        self.start = self.place + firsts[self.text]

    def hashes(self, length: int) -> np.ndarray:
        """Of each run of so many words, also of those across two texts."""
        sums = self._sums[length:] - self._sums[: len(self._sums) - length]
        return _mixed(sums * self._down[: len(sums)])

    def anchors(self) -> np.ndarray:
        """Of each window: the smallest hash among its runs of fewer words."""
        if not len(self.start):
            return np.empty(0, np.int64)
        length = max(1, int(self.window * ANCHOR_SHARE))
        least, width, wanted = self.hashes(length), 1, self.window - length + 1
        while width < wanted:
            step = min(width, wanted - width)
            least = np.minimum(least[: len(least) - step], least[step:])
            width += step
        return least[self.start].view(np.int64)

    def nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each window: the hashes of its words but the last, and but the first."""
        if not len(self.start):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        found = self.hashes(self.window - 1).view(np.int64)
        return found[self.start], found[self.start + 1]


def _distinct(texts: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text; texts ascend."""
    changed = np.append(True, (values[1:] != values[:-1]) | (texts[1:] != texts[:-1]))[: len(values)]
    texts, values = texts[changed], values[changed]
    order = np.lexsort((values, texts))
    texts, values = texts[order], values[order]
    changed = np.append(True, (values[1:] != values[:-1]) | (texts[1:] != texts[:-1]))[: len(values)]
    return texts[changed], values[changed]


def _lists(owners: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """The values of each owner as a list; owners ascend."""
    return pa.ListArray.from_arrays(np.searchsorted(owners, np.arange(n + 1)).astype(np.int32), pa.array(values))


def surveyed(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """``(id, key, n_words, kept_sha256, anchors)`` per row of ``(id, key, text)``: its anchors, and its
    digest if nothing is cut.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, powers = WordHashes(seed), Powers()
        for batch in batches:
            data = batch.column(2).to_pylist()
            for first, last in in_portions(data):
                texts = [t.split() for t in data[first:last]]
                runs = Runs(texts, hashes, powers, window)
                columns = [
                    *(c.slice(first, last - first) for c in batch.columns[:2]),
                    pa.array(runs.sizes),
                    pa.array([_digest(words) for words in texts]),
                    _lists(*_distinct(runs.text, runs.anchors()), len(texts)),
                ]
                yield pa.record_batch(columns, ["id", "key", "n_words", "kept_sha256", "anchors"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"id {kind}, key binary, n_words long, kept_sha256 string, anchors array<long>"
    )


def _digest(words: Sequence[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def repeated_anchors(texts: DataFrame) -> DataFrame:
    """``(key, id, marks)``: the anchors of each text that other texts have, too."""
    each = texts.select("key", "id", F.explode("anchors").alias("anchor"))
    seen = each.groupBy(F.col("anchor").alias("mark")).agg(F.min("key").alias("least"), F.max("key").alias("most"))
    # Recomputed, so that it has a shuffle of its own and a frequent anchor's rows can be split.
    seen = seen.where("least < most").select(F.col("mark").bitwiseXOR(F.lit(0)).alias("mark"))
    found = each.join(seen, F.col("anchor") == F.col("mark"))
    return found.groupBy("key", "id").agg(F.collect_list("mark").alias("marks"))


def edges(marked: DataFrame, window: int, seed: int) -> DataFrame:
    """``(key, id, pos, left, right)`` for the windows of ``(key, id, text, marks)`` whose anchor is marked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, powers = WordHashes(seed), Powers()
        for batch in batches:
            data = batch.column(2).to_pylist()
            for first, last in in_portions(data):
                runs = Runs([t.split() for t in data[first:last]], hashes, powers, window)
                anchors, keep = runs.anchors(), np.zeros(len(runs.text), bool)
                bounds = np.searchsorted(runs.text, np.arange(last - first + 1))
                for n, (start, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    marks = batch.column(3)[first + n].values.to_numpy()
                    keep[start:end] = np.isin(anchors[start:end], marks)
                left, right = runs.nodes()
                owners = pa.array(first + runs.text[keep])
                columns = [batch.column(0).take(owners), batch.column(1).take(owners), pa.array(runs.place[keep])]
                columns += [pa.array(left[keep]), pa.array(right[keep])]
                yield pa.record_batch(columns, ["key", "id", "pos", "left", "right"])

    kind = marked.schema["id"].dataType.simpleString()
    return marked.select("key", "id", "text", "marks").mapInArrow(
        run, f"key binary, id {kind}, pos long, left long, right long"
    )


def repeated_edges(found: DataFrame) -> DataFrame:
    """``(left, right, source)`` for the edges under two ids at least; the source is ``(id, key, pos)``."""
    sources = found.groupBy("left", "right").agg(
        F.min(F.struct("id", "key", "pos")).alias("source"), F.max("id").alias("last")
    )
    return sources.where("source.id < last").drop("last")


def compacted(repeated: DataFrame) -> DataFrame:
    """``repeated`` with ``piece``, where in its source the path starts that an edge is part of.

    An edge goes on with the path of the one before it in its source if the node between them has
    no other edge in or out. Paths are cut after ``PIECE`` edges.
    """
    ways = repeated.select(F.col("left").alias("node"), F.lit(0).alias("in"), F.lit(None).alias("into"))
    ways = ways.union(repeated.select("right", F.lit(1), "source"))
    between = ways.groupBy("node").agg(
        F.sum("in").alias("in"), F.count("*").alias("all"), F.min("into").alias("into")
    )
    between = between.where("`in` = 1 and `all` = 2").select(F.col("node").bitwiseXOR(F.lit(0)).alias("node"), "into")
    joined = repeated.join(between, F.col("left") == F.col("node"), "left")
    goes_on = (
        (F.col("into.id") == F.col("source.id"))
        & (F.col("into.key") == F.col("source.key"))
        & (F.col("into.pos") + 1 == F.col("source.pos"))
    )
    # The edges of one source are as many as its words at most.
    along = Window.partitionBy("source.id", "source.key").orderBy("source.pos")
    start = F.when(F.coalesce(goes_on, F.lit(False)), None).otherwise(F.col("source.pos"))
    joined = joined.withColumn("start", F.last(start, ignorenulls=True).over(along))
    piece = F.col("start") + F.floor((F.col("source.pos") - F.col("start")) / PIECE) * PIECE
    return joined.select("left", "right", "source", piece.alias("piece"))


def spans(found: DataFrame, paths: DataFrame) -> DataFrame:
    """``(key, id, start, n, source_key, source_id, piece, from)``: runs of ``n`` windows that repeat
    a part of a path, which starts at ``from`` in the source; only under larger ids than the source's.
    """
    paths = paths.select(F.col("left").alias("l"), F.col("right").alias("r"), "source", "piece")
    same = (F.col("left") == F.col("l")) & (F.col("right") == F.col("r"))
    met = found.join(paths, same & (F.col("id") > F.col("source.id")))
    met = met.select(
        "key", "id", "pos", F.col("source.key").alias("source_key"), F.col("source.id").alias("source_id"),
        F.col("source.pos").alias("from"), "piece",
    )
    # A text's windows are as many as its words at most.
    along = Window.partitionBy("key", "id").orderBy("pos")
    met = met.withColumn("run", F.col("pos") - F.row_number().over(along))
    runs = met.groupBy("key", "id", "source_key", "source_id", "piece", "run", F.col("pos") - F.col("from"))
    return runs.agg(F.min("pos").alias("start"), F.count("*").alias("n"), F.min("from").alias("from")).select(
        "key", "id", "start", "n", "source_key", "source_id", "piece", "from"
    )


def path_words(found: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``(source_key, source_id, piece, first, words)``: what stands at the source of the paths that
    spans refer to, from the word ``first`` on.
    """
    wanted = found.groupBy("source_key", "source_id", "piece").agg(
        F.min("from").alias("first"), (F.max(F.col("from") + F.col("n")) + window - 1).alias("end")
    )
    wanted = wanted.groupBy("source_key", "source_id").agg(F.collect_list(F.struct("piece", "first", "end")).alias("parts"))
    held = texts.join(wanted, (F.col("key") == F.col("source_key")) & (F.col("id") == F.col("source_id")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, (text, parts) in enumerate(zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)):
                words, owners = text.split(), pa.array([n] * len(parts), pa.int64())
                columns = [batch.column(0).take(owners), batch.column(1).take(owners)]
                columns += [pa.array([p[name] for p in parts], pa.int64()) for name in ("piece", "first")]
                columns.append(pa.array([b" ".join(words[p["first"] : p["end"]]) for p in parts], pa.binary()))
                yield pa.record_batch(columns, ["source_key", "source_id", "piece", "first", "words"])

    kind = texts.schema["id"].dataType.simpleString()
    return held.select("source_key", "source_id", "text", "parts").mapInArrow(
        run, f"source_key binary, source_id {kind}, piece long, first long, words binary"
    )


def verified(found: DataFrame, words: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``(key, id, n_removed, kept_sha256, kept, wrong)`` per text with spans, after comparing each with the
    words at its source; ``wrong`` counts the spans that differ, which are left.
    """
    same = ["source_key", "source_id", "piece"]
    to = words.select(*(F.col(c).alias(f"of_{c}") for c in same), "first", "words")
    joined = found.join(to, [F.col(c) == F.col(f"of_{c}") for c in same])
    span = F.struct("start", "n", (F.col("from") - F.col("first")).alias("skip"), "words")
    lists = joined.groupBy(F.col("key").alias("of"), F.col("id").alias("its")).agg(F.collect_list(span).alias("spans"))
    held = texts.join(lists, (F.col("key") == F.col("of")) & (F.col("id") == F.col("its")))
    names = ["key", "id", "n_removed", "kept_sha256", "kept", "wrong"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, listed in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                words, wrong = text.split(), 0
                keep = np.ones(len(words), bool)
                for span in listed:
                    length, start, skip = span["n"] + window - 1, span["start"], span["skip"]
                    if words[start : start + length] == span["words"].split()[skip : skip + length]:
                        keep[start : start + length] = False
                    else:
                        wrong += 1
                kept = b" ".join([w for w, stays in zip(words, keep.tolist(), strict=True) if stays])
                rows.append((int(len(words) - keep.sum()), hashlib.sha256(kept).hexdigest(), kept, wrong))
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.record_batch([*batch.columns[:2], *columns], names)

    kind = texts.schema["id"].dataType.simpleString()
    return held.select("key", "id", "text", "spans").mapInArrow(
        run, f"key binary, id {kind}, n_removed long, kept_sha256 string, kept binary, wrong long"
    )


def _key(text: str) -> Column:
    """Half of the text's SHA-256; equal texts have equal keys."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def cut_repeats(
    docs: DataFrame, work: Workspace, window: int = WINDOW, id: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256)`` per row of ``docs``, with ``with_text`` also ``kept``.

    Words are runs without space, tab, line feed, vertical tab, form feed or carriage return. Removed
    is each word that a window covers whose words also start in a row of a smaller id. Rows without id
    keep everything and take nothing from others; rows of one id take nothing from each other; repeated
    rows have equal results. A null text has no words; a text shorter than the window keeps them. An
    empty table gives an empty result. ``kept`` is null where nothing is removed, as the text says it.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    rows = pick(docs, id=id, text=text).withColumn("text", utf8("text"))
    rows = rows.select("id", _key("text").alias("key"), "text")
    for seed in range(_SEEDS):
        name = lambda part: f"{part}-{seed}"  # noqa: B023, E731
        survey = work.keep(surveyed(rows, window, seed), name("survey"))
        # Of equal texts the one of the smallest id stands for all: what it repeats, they do.
        texts = survey.where("id is not null").groupBy("key").agg(
            F.min("id").alias("id"), F.first("anchors").alias("anchors")
        )
        texts = work.keep(texts, name("texts"))
        marks = work.keep(repeated_anchors(texts), name("marks"))
        marked = _texts_of(rows, marks)
        marked = work.keep(marked, name("marked"))
        found = work.keep(edges(marked, window, seed), name("edges"))
        repeated = work.keep(repeated_edges(found), name("repeated"))
        paths = work.keep(compacted(repeated), name("paths"))
        runs = work.keep(spans(found, paths), name("spans"))
        marked = marked.drop("marks")
        words = work.keep(path_words(runs, marked, window), name("words"))
        cut = work.keep(verified(runs, words, marked, window), name("cut"))
        # Two different windows of equal hashes: another seed tells them apart.
        if not cut.agg(F.sum("wrong")).first()[0]:
            return _judged(survey, texts, cut, window, with_text)
    raise RuntimeError(f"different windows had equal hashes under each of {_SEEDS} seeds")


def _texts_of(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``(key, id, text, marks)``: each marked text once."""
    marks = marks.select(F.col("key").alias("of"), F.col("id").alias("its"), "marks")
    met = rows.join(marks, (F.col("key") == F.col("of")) & (F.col("id") == F.col("its")))
    return met.select("key", "id", "text", "marks").dropDuplicates(["key", "id"])


def _judged(survey: DataFrame, texts: DataFrame, cut: DataFrame, window: int, with_text: bool) -> DataFrame:
    first = texts.select(F.col("key").alias("of"), F.col("id").alias("first"))
    cut = cut.select(
        F.col("key").alias("cut_key"), F.col("id").alias("cut_id"), "n_removed", F.col("kept_sha256").alias("cut_sha256"), "kept"
    )
    rows = survey.drop("anchors").join(first, F.col("key") == F.col("of"), "left")
    rows = rows.join(cut, (F.col("key") == F.col("cut_key")) & (F.col("id") == F.col("cut_id")), "left")
    whole = F.coalesce((F.col("id") > F.col("first")) & (F.col("n_words") >= window), F.lit(False))
    removed = F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long")))
    digest = F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", "kept_sha256"))
    kept = F.when(whole, F.lit(b"")).otherwise(F.col("kept")).cast("string")
    found = rows.select("id", "n_words", removed.alias("n_removed"), digest.alias("kept_sha256"), kept.alias("kept"))
    return found if with_text else found.drop("kept")
