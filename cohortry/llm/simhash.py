"""SimHash near-duplicates by pigeonring filtering.

A text's fingerprint has 64 bits; texts whose fingerprints differ in few bits are
linked, and linked texts form groups. The bits are cut into ``SEGMENTS`` segments on
a ring. If two fingerprints differ in at most ``d`` bits, then from some segment on
every chain of ``l`` consecutive segments differs in at most ``floor(l * d /
SEGMENTS)`` bits, for all ``l`` (the strong form of the pigeonhole principle on a ring).
So only pairs with a chain that keeps within all these budgets are compared:
the first two segments by equi-join, the longer chains in the join's condition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations
from operator import or_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions import own_shuffle
from cohortry.llm.common import pick, utf8
from cohortry.llm.components import components
from cohortry.sources.results import Workspace

BITS = 64
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEGMENTS = 5
#: Segments that make up a join key. With more data, longer keys keep chance meetings rare.
KEY_SEGMENTS = 2
HASH_SEED = 42
_SHINGLES_AT_ONCE = 1 << 16


def simhash(data: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a text's UTF-8 bytes; 0 if it has no word.

    A-Z are lower-cased; words are runs without space, tab, line feed, vertical
    tab, form feed or carriage return; a text of fewer words is one shingle. A bit is
    set if it is in more than half of all shingles' hashes, repeats counted.
    """
    words = data.lower().split()
    if not words:
        return 0
    total = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(BITS, np.int64)
    for first in range(0, total, _SHINGLES_AT_ONCE):
        last = min(first + _SHINGLES_AT_ONCE, total)
        hashes = np.fromiter(
            (
                xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle_words]), HASH_SEED)
                for i in range(first, last)
            ),
            np.dtype("<u8"),
            last - first,
        )
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(0, dtype=np.int64)
    bits = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id: str, text: str, shingle_words: int) -> DataFrame:
    """``(id, fp)`` per row, ``fp`` as a signed long."""
    return _with_fingerprints(pick(docs, id=id, text=text), shingle_words)


def _with_fingerprints(rows: DataFrame, shingle_words: int) -> DataFrame:
    """``rows`` with ``fp`` in place of the last column, the text."""
    kept = rows.columns[:-1]
    kinds = [f"{name} {rows.schema[name].dataType.simpleString()}" for name in kept]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(x, shingle_words) for x in batch.column(len(kept)).to_pylist()]
            columns = [*batch.columns[:-1], pa.array(found, pa.int64())]
            yield pa.record_batch(columns, [*kept, "fp"])

    return rows.withColumn("text", utf8("text")).mapInArrow(run, ", ".join([*kinds, "fp long"]))


def row_key(id: str | Column, text: str | Column) -> Column:
    """A digest of a row's id and text; it tells rows without id, or of one id, apart by text."""
    name = (F.col(id) if isinstance(id, str) else id).cast("string")
    # With its length, no id runs into the text; a row without id has neither.
    named = F.coalesce(F.concat(F.length(name).cast("string"), F.lit(":"), name), F.lit(""))
    return F.unhex(F.sha2(F.concat(F.concat(named, F.lit(":")).cast("binary"), utf8(text)), 256))


def near_duplicates(
    docs: DataFrame,
    work: Workspace,
    id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """``(id, fp, component)`` per row of ``docs``; component is the smallest linked id.

    Nulls: a null text is an empty one, and all texts without words are linked by
    fingerprint 0. A row without id keeps a null id and gets its group's smallest
    id, null if no row of the group has one. Repeated rows come out as often as they
    come in. An empty table gives an empty result.
    """
    rows = work.keep(fingerprints(docs, id, text, shingle_words), "fingerprints")
    grouped = _grouped(rows, F.min("id"), work, max_distance)
    smallest = grouped.groupBy(F.col("root").alias("of")).agg(F.min("first").alias("component"))
    named = work.keep(
        grouped.join(smallest, grouped["root"] == smallest["of"]).select(
            F.col("fp").alias("class"), "component"
        ),
        "groups",
    )
    return rows.join(named, rows["fp"] == named["class"]).select("id", "fp", "component")


def keepers(
    docs: DataFrame,
    work: Workspace,
    id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """The ``row_key`` of one row per group of near duplicates, as ``keeper``.

    It is the group's row with the smallest id, of several the one with the smallest key; a row
    without id is taken only where no row of the group has one.
    """
    keyed = pick(docs, id=id, text=text).select("id", row_key("id", "text").alias("key"), "text")
    rows = work.keep(_with_fingerprints(keyed, shingle_words), "keyed")
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "key"))
    grouped = _grouped(rows, first, work, max_distance)
    return grouped.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.key").alias("keeper")
    )


def _grouped(rows: DataFrame, first: Column, work: Workspace, max_distance: int) -> DataFrame:
    """``(fp, first, root)`` per class: what of its rows comes ``first``, and its group's root."""
    # Equal fingerprints are one class; a large group of copies is one row from here on.
    classes = work.keep(rows.groupBy("fp").agg(first.alias("first")), "classes")
    linked = _linked_classes(classes.select("fp"), work, max_distance)
    return classes.join(linked, classes["fp"] == linked["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def _linked_classes(classes: DataFrame, work: Workspace, max_distance: int) -> DataFrame:
    """``(node, root)``: every class that is linked to a smaller one, with its group's root.

    Only the groups are wanted, so a dense cloud of near copies isn't spelled out as
    pairs. First each class is linked to the smallest class with its key; pairs are
    then sought only between classes that this left in different groups.
    """
    ring = Ring(max_distance)
    keyed = ring.keys(classes, [0])
    heads = keyed.groupBy(F.col("key").alias("at")).agg(F.min("fp").alias("head"))
    stars = keyed.join(own_shuffle(heads, "at"), F.col("key") == F.col("at")).where(
        F.bit_count(F.col("fp").bitwiseXOR(F.col("head"))).between(1, max_distance)
    )
    first = components(stars.select("fp", "head"), work, "stars")
    grouped = work.keep(
        classes.join(first, classes["fp"] == first["node"], "left").select(
            "fp", F.coalesce("root", "fp").alias("group")
        ),
        "star-groups",
    )
    x = ring.keys(grouped, [0]).alias("x")
    y = ring.keys(grouped, ring.neighbours).alias("y")
    pairs = x.join(
        y,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.fp") < F.col("y.fp"))
        & (F.col("x.group") != F.col("y.group"))
        & ring.within_budgets(F.col("x.key"), F.col("x.fp").bitwiseXOR(F.col("y.fp"))),
    ).select(F.col("x.group").alias("a"), F.col("y.group").alias("b"))
    second = components(pairs, work, "links")
    joined = grouped.join(second, grouped["group"] == second["node"], "left")
    return joined.select(
        F.col("fp").alias("node"), F.coalesce("root", "group").alias("root")
    ).where("node != root")


class Ring:
    """Segments of a fingerprint on a ring, and what their chains may differ in."""

    def __init__(
        self, max_distance: int, segments: int = SEGMENTS, key_segments: int = KEY_SEGMENTS
    ) -> None:
        self.max_distance = max_distance
        self.segments = segments
        self.key_segments = key_segments
        cuts = [BITS * k // segments for k in range(segments + 1)]
        self.starts = cuts[:-1]
        # All chains start at bit 0 after turning, so segments get the width of the
        # narrowest start: the chain of l segments from any start has at least these bits.
        self.ends = [
            min((cuts[(k + n) % segments] - cuts[k]) % BITS or BITS for k in range(segments))
            for n in range(1, segments + 1)
        ]

    def budget(self, length: int) -> int:
        """Bits in which a chain of so many segments may differ."""
        return length * self.max_distance // self.segments

    @property
    def neighbours(self) -> list[int]:
        """All differences that a key may have within the budgets of its chains; 0 first."""
        width = self._key_bits
        most = self.budget(self.key_segments)
        return [
            mask
            for n in range(most + 1)
            for bits in combinations(range(width), n)
            if self._allowed(mask := reduce(or_, (1 << b for b in bits), 0))
        ]

    def _allowed(self, mask: int) -> bool:
        return all(
            (mask & ((1 << end) - 1)).bit_count() <= self.budget(n)
            for n, end in enumerate(self.ends[: self.key_segments], 1)
        )

    def keys(self, classes: DataFrame, masks: list[int]) -> DataFrame:
        """A row per class, start and mask, with a ``key``: the start's number above the chain's
        bits.
        """
        rows = classes.withColumn("start", F.explode(F.expr(f"sequence(0L, {self.segments - 1}L)")))
        rows = rows.withColumn("mask", F.explode(F.array(*(F.lit(m).cast("long") for m in masks))))
        low = self._turned(F.col("fp"), F.col("start")).bitwiseXOR(F.col("mask"))
        low = low.bitwiseAND(F.lit((1 << self._key_bits) - 1))
        key = F.shiftleft(F.col("start"), self._key_bits).bitwiseOR(low)
        return rows.select(key.alias("key"), *classes.columns)

    def within_budgets(self, key: Column, difference: Column) -> Column:
        """Whether every chain from the key's start keeps its budget; the longest is the whole."""
        turned = self._turned(difference, F.shiftright(key, self._key_bits))
        checks = [
            F.bit_count(turned.bitwiseAND(F.lit((1 << end) - 1))) <= self.budget(n)
            for n, end in enumerate(self.ends, 1)
            if end < BITS
        ]
        # The whole first: it rejects most chance meetings, and doesn't depend on the start.
        whole = F.bit_count(difference) <= self.max_distance
        return reduce(lambda a, b: a & b, [whole, *checks])

    @property
    def _key_bits(self) -> int:
        return self.ends[self.key_segments - 1]

    def _turned(self, bits: Column, start: Column) -> Column:
        """The bits turned on the ring so that the chain from a start comes lowest."""
        at = F.element_at(F.array(*(F.lit(at) for at in self.starts)), start.cast("int") + 1)
        right = F.call_function("shiftrightunsigned", bits, at)
        return right.bitwiseOR(F.call_function("shiftleft", bits, F.lit(BITS) - at))
