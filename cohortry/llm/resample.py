"""Target-distribution importance resampling over hashed n-grams.

Documents are drawn by how likely their n-grams are in a target corpus rather than in the documents
at large. Each n-gram falls into one of some thousand buckets; a bucket's gain is the scaled log ratio
of its smoothed shares in both corpora, a document's weight the sum of its n-grams' gains, and a draw
without replacement takes the highest weights with a Gumbel term from each id's hash.

Within a batch n-grams are interned in an open-addressed table of NumPy arrays: xxhash64 keys find a
slot by linear probing, equal keys are verified by their bytes, and each slot stores its bucket and
count. Bucket and byte work is thus done once for each distinct n-gram; the slot ids of the
occurrences then gather the slots' gains.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.bpe import in_portions
from cohortry.llm.common import pick, utf8
from cohortry.sources.results import Workspace

BUCKETS = 10_000
#: Gains and draws are whole thousandths.
SCALE = 1000
#: Parts in which ranks are counted on their own, per shuffle partition.
SLICES_PER_PARTITION = 4
#: Letters, digits and everything beyond ASCII, after A-Z are lower-cased.
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_EMPTY = -1


@dataclass(frozen=True)
class Interned:
    """The distinct n-grams of a batch: for each slot taken its bucket and its count.

    ``slots`` has the slot of every occurrence, in their order.
    """

    slots: np.ndarray
    buckets: np.ndarray
    counts: np.ndarray


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def n_grams(words: Sequence[bytes], longest: int) -> list[bytes]:
    """Runs of 1 to ``longest`` consecutive words, joined by a space, shorter runs first."""
    found = list(words)
    for n in range(2, longest + 1):
        found += map(b" ".join, zip(*(words[k:] for k in range(n)), strict=False))
    return found


def intern(grams: Sequence[bytes], buckets: int = BUCKETS, hashed=xxhash.xxh64_intdigest) -> Interned:
    """Places n-grams in a table of at most half its slots."""
    size = 1 << max(4, (2 * len(grams) - 1).bit_length())
    mask = np.uint64(size - 1)
    keys = np.fromiter(map(hashed, grams), np.uint64, len(grams))
    bytes_of = np.empty(len(grams), object)
    bytes_of[:] = grams
    holder = np.full(size, _EMPTY, np.int64)  # the occurrence that took the slot
    slots = (keys & mask).astype(np.int64)
    open_ = np.arange(len(grams))
    while len(open_):
        at = slots[open_]
        free = holder[at] == _EMPTY
        holder[at[free]] = open_[free]  # of several that want a slot the last one gets it
        first = holder[at]
        same = keys[first] == keys[open_]
        same[same] = bytes_of[first[same]] == bytes_of[open_[same]]
        open_ = open_[~same]
        slots[open_] = (slots[open_] + 1) & int(mask)
    taken = np.flatnonzero(holder != _EMPTY)
    number = np.empty(size, np.int64)
    number[taken] = np.arange(len(taken))
    slots = number[slots]
    places = np.fromiter((zlib.crc32(g) % buckets for g in bytes_of[holder[taken]]), np.int64, len(taken))
    return Interned(slots, places, np.bincount(slots, minlength=len(taken)))


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: how many n-grams of all texts fall into each bucket; none for empty ones."""
    rows = texts.select(utf8(F.col(text)).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data = batch.column(0).to_pylist()
            for first, last in in_portions(data):
                found = intern([g for t in data[first:last] for g in n_grams(words_of(t), longest)], buckets)
                np.add.at(total, found.buckets, found.counts)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counted = rows.mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain, from two tables of ``bucket_counts``."""
    counts = []
    for table in (source, target):
        held = np.zeros(buckets)
        for row in table.collect():  # as many rows as buckets at most
            held[row["bucket"]] = row["n"]
        counts.append(held)
    every, wanted = counts
    return np.array(
        [
            math.floor(SCALE * math.log((t + 1) * (every.sum() + buckets) / ((s + 1) * (wanted.sum() + buckets))))
            for s, t in zip(every.tolist(), wanted.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(seed: int, id: str) -> int:
    """A Gumbel term of the id, in whole thousandths."""
    drawn = int(hashlib.sha256(f"{seed}:{id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((drawn + 0.5) / 4294967296)))


def weighted(
    docs: DataFrame,
    gain: np.ndarray,
    longest: int = 1,
    seed: int = 2024,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(id, n_words, n_features, weight, score)`` per row of ``docs``."""
    rows = pick(docs, id=id, text=text)
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.select("id", utf8("text").alias("text"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    names = ["id", "n_words", "n_features", "weight", "score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, keys = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for first, last in in_portions(data):
                words = [words_of(t) for t in data[first:last]]
                grams = [n_grams(w, longest) for w in words]
                sizes = np.array([len(g) for g in grams], np.int64)
                found = intern([g for of in grams for g in of], len(gain))
                earlier = np.append(0, np.cumsum(gain[found.buckets][found.slots]))
                ends = np.cumsum(sizes)
                weight = earlier[ends] - earlier[ends - sizes]
                score = weight + [noise(seed, key) for key in keys[first:last]]
                columns = ([len(w) for w in words], sizes, weight, score)
                yield pa.record_batch(
                    [batch.column(0).slice(first, last - first), *(pa.array(c, pa.int64()) for c in columns)], names
                )

    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    work: Workspace,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    least_words: int = 20,
    percent: int = 10,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` per row of ``docs``; ranks of those drawn, from 1.

    Of the N rows with at least ``least_words`` words the ``floor(percent * N / 100)`` highest scores
    are drawn, ties to the smaller id; rows without id come last among equal scores, and share one
    draw of the hash, that of an empty id. Null and empty texts have no n-gram and weight 0. Each
    repeated row is a row of its own, of equal score and with a rank of its own. An empty table gives
    an empty result, an empty target leaves what is rare in the documents the gain of smoothing.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)
    rows = work.keep(weighted(docs, gain, longest, seed, id, text), "weighted")
    eligible = F.col("n_words") >= least_words
    drawn = rows.where(eligible).count() * percent // 100
    own = ["id", "n_features", "weight", "score"]
    rest = rows.where(~eligible).select(*own, F.lit(None).cast("long").alias("rank"))
    return _ranked(rows.where(eligible).select(*own), drawn, work).unionByName(rest)


def _ranked(rows: DataFrame, drawn: int, work: Workspace) -> DataFrame:
    """``rows`` with their rank by score, then id, up to ``drawn``; null from there on.

    Scores are cut into slices at quantiles; ranks are counted within a slice and start from the
    total of the slices above it. Equal rows are one row with a count, so they are no large slice.
    """
    spark = rows.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions")) * SLICES_PER_PARTITION
    shares = [k / slices for k in range(1, slices)]
    cuts = rows.agg(F.percentile_approx("score", shares, 50 * slices)).first()[0] or []
    cuts = sorted({-c for c in cuts})
    own = rows.columns
    rows = rows.groupBy(*own).agg(F.count("*").alias("rows"))
    rows = work.keep(rows.withColumn("slice", _upto(-F.col("score"), cuts)), "eligible")
    counts = rows.groupBy("slice").agg(F.sum("rows").alias("n"))
    # A row per slice: as many as the quantiles asked for.
    above = Window.partitionBy(F.lit(0)).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        F.col("slice").alias("of"), F.coalesce(F.sum("n").over(above), F.lit(0)).alias("first")
    )
    first = work.keep(first, "slices")
    order = Window.partitionBy("slice").orderBy(F.desc("score"), F.asc_nulls_last("id"), "n_features", "weight")
    within = F.coalesce(F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("place", within).join(first, F.col("slice") == F.col("of"))
    placed = placed.withColumn("copy", F.explode(F.expr("sequence(1L, rows)")))
    rank = F.col("first") + F.col("place") + F.col("copy")
    return placed.select(*own, F.when(rank <= drawn, rank).alias("rank"))


def _upto(value: Column, cuts: Sequence[int]) -> Column:
    """How many cuts are below the value."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.lit(list(cuts)).cast("array<long>"), lambda cut: cut < value))
