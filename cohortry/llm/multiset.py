"""Document fingerprints by a homomorphic multiset hash.

A paragraph is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs'
vectors, lane by lane modulo a power of two. So it doesn't depend on the paragraphs' order, it
counts repeats, and a paragraph is inserted or deleted by adding or subtracting its vector, without
the rest of the text.

A vector has two bands. The ``EXACT`` lanes, modulo 2^32, are cut from the SHA-256 of the whole
paragraph: they tell equal multisets from different ones, but for chance collisions of 256 bits. They
don't resist paragraphs chosen to collide, since sums modulo a power of two can be solved bit by bit;
that takes many more lanes. The ``LIKE`` lanes, modulo 2^32 too, estimate
how much two documents share: each run of ``RUN`` words of the paragraph adds +1 or -1, by its hash,
to one of them. In the difference of two fingerprints the shared runs cancel, so the lanes' sum of
squares estimates how many are not shared. A text has at most 2^31 bytes, so no lane leaves its signed range.

Everything is DataFrame expressions over one row, without a shuffle.
"""

from __future__ import annotations

import json
from collections import Counter
from itertools import accumulate
from math import isqrt

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from cohortry.llm.common import pick

EXACT, LIKE = 8, 128
_BITS = 32
#: Counters in a LIKE lane.
_COUNTERS = 1
BINS = LIKE * _COUNTERS
#: Bits by which hashes are parted into bins, a few at a time, from the highest on.
_PARTINGS = (2, 2, 3)
#: Words that make up a run; the last runs of a paragraph are shorter.
RUN = 4
#: A word, or a character of what goes on for longer without a space, as some scripts do.
_WORD = r"\S{1,24}+(?!\S)|\S"
#: Slices of the documents in id order, per shuffle partition.
SLICES_PER_PARTITION = 10


def paragraphs(text: Column) -> Column:
    """Non-empty lines."""
    return F.filter(F.split(text, "\n"), lambda p: p != "")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text, as an array of lanes; of an empty or null one all are 0."""
    lines = F.coalesce(paragraphs(text), F.array().cast("array<string>"))
    hashes = _once(lines, lambda ps: F.struct(_digests(ps).alias("whole"), _pieces(ps).alias("pieces")))
    return _once(hashes, lambda h: _lanes(h["whole"], h["pieces"]))


def _digests(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.sha2(t.cast("binary"), 256))


def _hashes(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.xxhash64(t))


def _pieces(paragraphs: Column) -> Column:
    """Hashes of the runs of words that begin at each word of the paragraphs."""

    def runs(words: Column) -> Column:
        # Hashes skip nulls, which stand after the last word.
        following = lambda i: (F.get(words, i + n) for n in range(1, RUN))
        return F.transform(words, lambda word, i: F.xxhash64(word, *following(i)))

    words = lambda p: _hashes(F.regexp_extract_all(p, F.lit(_WORD), F.lit(0)))
    return F.flatten(F.transform(paragraphs, lambda p: _once(words(p), runs)))


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def _lanes(whole: Column, pieces: Column) -> Column:
    """The sums of the lanes over digests of paragraphs and hashes of runs of words."""
    exact = [_sum(whole, lambda d, i=i: _cut(d, i)) for i in range(EXACT)]
    return F.concat(F.array(*exact), F.transform(_binned(pieces), lambda bin: _sum(bin, _sign)))


def _cut(digest: Column, lane: int) -> Column:
    digits = _BITS // 4
    return F.conv(F.substring(digest, 1 + digits * lane, digits), 16, 10).cast("long")


def _sum(values: Column, term) -> Column:
    # Terms are far below 2^63, so the sum can't overflow before it is reduced.
    total = F.aggregate(values, F.lit(0).cast("long"), lambda total, v: total + term(v))
    return _modulo(total)


def _binned(hashes: Column) -> Column:
    """The hashes of each bin, as an array of ``BINS`` arrays."""
    parts, shift = F.array(hashes), 64
    for bits in _PARTINGS:
        shift -= bits
        parts = F.flatten(F.transform(parts, _parted(shift, bits)))
    return parts


def _parted(shift: int, bits: int):
    def of(k: int):
        low = F.lit((1 << bits) - 1)
        return lambda h: F.shiftrightunsigned(h, shift).bitwiseAND(low) == k

    return lambda part: F.array(*(F.filter(part, of(k)) for k in range(1 << bits)))


def _sign(h: Column) -> Column:
    return F.lit(1) - F.shiftleft(h.bitwiseAND(F.lit(1).cast("long")), 1)


def _modulo(value: Column) -> Column:
    return value.bitwiseAND(F.lit((1 << _BITS) - 1))


def insert(fingerprints: Column, paragraph: Column) -> Column:
    """The fingerprint with one more paragraph."""
    return _combined(fingerprints, fingerprint(paragraph), 1)


def delete(fingerprints: Column, paragraph: Column) -> Column:
    """The fingerprint with one such paragraph less."""
    return _combined(fingerprints, fingerprint(paragraph), -1)


def _combined(a: Column, b: Column, sign: int) -> Column:
    return F.zip_with(a, b, lambda x, y: _modulo(x + sign * y))


def digest(fingerprints: Column) -> Column:
    """All lanes in hexadecimal, as one string."""
    lanes = F.transform(fingerprints, lambda lane: F.lpad(F.hex(lane), _BITS // 4, "0"))
    return F.lower(F.array_join(lanes, ""))


def likeness(a: Column, b: Column) -> Column:
    """What two documents share of their runs of words, estimated from fingerprints: 0 to 1.

    1 for equal multisets of paragraphs, otherwise ``1 - |a - b|^2 / (|a|^2 + |b|^2)`` over the
    counters, where negative estimates are 0.
    """
    equal = F.slice(a, 1, EXACT) == F.slice(b, 1, EXACT)
    band = lambda f: F.slice(f, EXACT + 1, LIKE)
    apart = F.zip_with(band(a), band(b), lambda x, y: _modulo(x - y))
    both = _squares(band(a)) + _squares(band(b))
    near = F.when(both > 0, 1 - _squares(apart) / both).otherwise(0.0)
    return F.when(equal, 1.0).otherwise(F.greatest(F.least(near, F.lit(1.0)), F.lit(0.0)))


def _squares(lanes: Column) -> Column:
    """Sum of squares of the counters; a lane is a signed number modulo 2^32."""
    half = F.lit(1 << (_BITS - 1))

    def square(lane: Column) -> Column:
        count = (_modulo(lane + half) - half).cast("double")
        return count * count

    return F.aggregate(lanes, F.lit(0.0), lambda total, lane: total + square(lane))


def fingerprint_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, text, fingerprint, next_text, next_fingerprint)`` per row of ``docs``.

    Next is the next row by id, for the last one the first. Ids are whole numbers; others are refused.

    Rows are dealt into slices of the order, found by quantiles of the ids, and each slice is sorted on
    its own; the first row of a slice is also given to the slice before as the end of its order. So one
    shuffle moves each text once. Rows of one id go by a hash of the text, then the text, and rows
    without id come first; where these are many, slices part them by the hash. Only rows equal in both
    id and text stay together. A null text is an empty one.
    """
    rows = pick(docs, id=id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    if not isinstance(rows.schema["id"].dataType, IntegralType):
        raise TypeError(f"ids have to be whole numbers, not {rows.schema['id'].dataType.simpleString()}")
    rows = rows.select(F.col("id").cast("long"), "text", F.xxhash64("text").alias("place"))
    spark = docs.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions")) * SLICES_PER_PARTITION
    sliced = _sliced(rows, slices)
    first = F.min(F.struct(F.col("id").isNotNull().alias("has_id"), "id", "place"))
    firsts = sorted(sliced.groupBy("own").agg(first.alias("first")).collect())
    # One row per slice: as many as the quantiles asked for.
    size = 1 + max((f["own"] for f in firsts), default=0)
    before, ids, places = ([None] * size for _ in range(3))
    for k, f in enumerate(firsts):
        before[f["own"]] = firsts[k - 1]["own"]  # the last slice is before the first
        ids[f["own"]], places[f["own"]] = f["first"]["id"], f["first"]["place"]

    def of_slice(values: list) -> Column:
        return F.get(_constant(values, "array<bigint>"), F.col("own"))

    is_first = F.col("id").eqNullSafe(of_slice(ids)) & (F.col("place") == of_slice(places))
    lent = sliced.where(is_first).groupBy("own", "id", "place").agg(F.min("text").alias("text"))
    own = sliced.select("id", "text", "place", F.col("own").alias("slice"), F.lit(False).alias("lent"))
    lent = lent.select("id", "text", "place", of_slice(before).alias("slice"), F.lit(True).alias("lent"))
    # False sorts before true: what is lent comes after the slice's own rows.
    seated = own.union(lent).withColumn("fingerprint", fingerprint(F.col("text")))
    order = Window.partitionBy("slice").orderBy("lent", "id", "place", "text")
    nexts = {f"next_{name}": F.lead(name).over(order) for name in ("text", "fingerprint")}
    done = seated.withColumns(nexts).where("not lent")
    return done.select("id", "text", "fingerprint", "next_text", "next_fingerprint")


def _sliced(rows: DataFrame, slices: int) -> DataFrame:
    """``rows`` with ``own``, the slice of each."""
    found = rows.agg(
        F.percentile_approx("id", [k / slices for k in range(1, slices)], 50 * slices).alias("cuts"),
        F.min("id").alias("min"),
        F.count_if(F.col("id").isNull()).alias("nulls"),
        F.count("*").alias("rows"),
    ).first()
    return rows.withColumn("own", _slice(found, slices))


def _slice(found: Row, slices: int) -> Column:
    """The slice of a row, ascending along the order.

    An id that several quantiles fall on has so many slices, parted by the text's hash; so have the rows
    without id by their share. Other ids are in the last slice of the cut before them.
    """
    times = Counter(found["cuts"] or [])
    cuts = sorted({found["min"], *times} - {None})
    parts = [max(1, times[cut]) for cut in cuts]
    nameless = -(-found["nulls"] * slices // max(1, found["rows"]))
    begin = [nameless, *accumulate(parts, initial=nameless)][1:]
    # Cuts are looked up in two steps, first the run of cuts and then the cut in the run.
    step = max(1, isqrt(len(cuts)))
    runs = [cuts[k : k + step] for k in range(0, len(cuts), step)]
    run = F.size(F.filter(_constant([r[0] for r in runs], "array<bigint>"), lambda cut: cut <= F.col("id"))) - 1
    in_run = F.get(_constant(runs, "array<array<bigint>>"), run)
    at = run * step + F.size(F.filter(in_run, lambda cut: cut <= F.col("id"))) - 1
    is_cut = F.get(_constant(cuts, "array<bigint>"), at) == F.col("id")
    many = F.get(_constant(parts, "array<bigint>"), at)
    own = F.get(_constant(begin, "array<bigint>"), at) + F.when(is_cut, _part(many)).otherwise(many - 1)
    return F.when(F.col("id").isNull(), _part(F.lit(nameless))).otherwise(own).cast("int")


def _part(parts: Column) -> Column:
    """One of so many parts of the range of hashes, ascending with the hash."""
    share = F.col("place") / F.lit(2.0**64) + F.lit(0.5)
    return F.least(F.floor(share * parts), parts - 1).cast("bigint")


def _constant(values: list, kind: str) -> Column:
    """A nested list as one constant; as columns, thousands of numbers would slow planning down."""
    return F.from_json(F.lit(json.dumps(values)), kind)
