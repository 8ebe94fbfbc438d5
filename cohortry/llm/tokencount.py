"""Token counts of a document's sections by offset-mapped attribution.

A document is encoded once, as a whole; counting each section on its own would cut tokens
differently at the seams. The offset map gives each token's span in characters; one that holds only a
part of a character spans all of it. These spans are interval-joined with the sections' spans: both
bounds of the token spans ascend, so the tokens that overlap a section are a run, found by look-ups of
the section's bounds, for all texts of a portion at once. A token that crosses a section's bound is
allocated by a rule:

- ``first``: to the sections that hold its first character,
- ``last``: to the sections that hold its last character,
- ``split``: to each section the part of its bytes that lie there.

With sections that cover the text without overlap, every rule hands out each token exactly once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.bpe import Encoder, Vocabulary, in_portions
from cohortry.llm.common import pick, utf8

RULES = ("first", "last", "split")
_LINE_FEED = 0x0A


def token_sizes(vocabulary: Vocabulary) -> np.ndarray:
    """Bytes of each id's token."""
    return np.array([len(token or b"") for token in vocabulary.tokens], np.int64)


class OffsetMap:
    """Where the tokens of several texts, one after the other, are among the characters of all."""

    def __init__(self, texts: Sequence[str], encoded: Sequence[Sequence[int]], sizes: np.ndarray) -> None:
        units = np.frombuffer("".join(texts).encode(), np.uint8)
        leads = (units & 0xC0) != 0x80
        holder = np.cumsum(leads) - 1  # the character of each byte
        #: Tokens of each text, and the characters where each text starts and the last one ends.
        self.counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        self.bounds = np.cumsum([0, *map(len, texts)])
        #: The byte at which each character starts, and the end.
        self.places = np.append(np.flatnonzero(leads), len(units))
        self.feeds = holder[units == _LINE_FEED]
        of_ids = sizes[np.fromiter(chain.from_iterable(encoded), np.int64, self.counts.sum())]
        self.sizes, self.ends = of_ids, np.cumsum(of_ids)
        #: Each token's span: its first character, and the one after its last.
        self.first = holder[self.ends - of_ids]
        self.last = holder[self.ends - 1] + 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, number, start and end of each line, its line feed included; an empty text has one."""
        counts = np.diff(np.searchsorted(self.feeds, self.bounds)) + 1
        firsts = np.cumsum(counts) - counts
        owners = np.repeat(np.arange(len(counts)), counts)
        ends = np.empty(len(owners), np.int64)
        is_last = np.zeros(len(owners), bool)
        is_last[firsts + counts - 1] = True
        ends[is_last], ends[~is_last] = self.bounds[1:], self.feeds + 1
        starts = np.append(0, ends[:-1])[: len(ends)]
        return owners, np.arange(len(owners)) - firsts[owners], starts, ends

    def allocate(self, start: np.ndarray, end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each section, and how many of them cross one of its bounds.

        Sections lie in one text each; they may overlap, leave gaps and come in any order.
        """
        # Of the tokens, [begun, after) overlap the section, [inside, upto) start and end in it. At
        # most one crosses a bound, as a bound is between characters.
        begun, upto = np.searchsorted(self.last, start, "right"), np.searchsorted(self.last, end, "right")
        inside, after = np.searchsorted(self.first, start, "left"), np.searchsorted(self.first, end, "left")
        enters, leaves = inside > begun, after > upto
        within = enters & leaves & (begun == upto)  # one token is larger than the section
        some = end > start
        crossing = (enters.astype(np.int32) + leaves - within) * some
        if rule == "first":
            return (after - inside) * some.astype(float), crossing
        if rule == "last":
            return (upto - begun) * some.astype(float), crossing
        held = np.maximum(upto - inside, 0).astype(float)
        low, high = self.places[start], self.places[end]
        at = begun[enters]
        held[enters] += (np.minimum(self.ends[at], high[enters]) - low[enters]) / self.sizes[at]
        leaves &= ~within
        at = upto[leaves]
        held[leaves] += (high[leaves] - self.ends[at] + self.sizes[at]) / self.sizes[at]
        return held * some, crossing


def with_fields(
    docs: DataFrame, fields: Sequence[str], text: str, sections: str, between: str = "\n"
) -> DataFrame:
    """``docs`` with its fields joined to one ``text`` and their spans in ``sections``; null fields
    are empty.
    """
    values = [F.coalesce(F.col(f), F.lit("")) for f in fields]
    spans, at = [], F.lit(0)
    for field, value in zip(fields, values, strict=True):
        end = at + F.char_length(value)
        spans.append(F.struct(F.lit(field).alias("section"), at.alias("start"), end.alias("end")))
        at = end + len(between)
    return docs.withColumns({text: F.concat_ws(between, *values), sections: F.array(*spans)})


def section_tokens(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    rule: str = "first",
    id: str = "doc_id",
    text: str = "text",
    sections: str | None = None,
) -> DataFrame:
    """``(id, section, start, end, tokens, crossing, document_tokens)`` per section of each row of
    ``docs``.

    ``sections`` names a column of ``array<struct<section, start, end>>`` with spans in characters;
    without it, sections are the lines, numbered from 0. Spans come out as given; they may overlap or
    leave gaps, what lies beyond the text counts for nothing, and a span without a bound or with its
    end before its start is empty. A null text is an empty one; null or no sections give no row, null
    spans no tokens. Repeated rows and rows without id are counted like any other. An empty table gives
    an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {', '.join(RULES)}")
    columns = {"id": id, "text": text} | ({"sections": sections} if sections else {})
    rows = pick(docs, **columns).withColumn("text", utf8("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(ranks, pattern)
        sizes = token_sizes(encoder.vocabulary)
        for batch in batches:
            data = batch.column(1).to_pylist()
            for first, last in in_portions(data):
                texts = [x.decode("utf-8", "replace") for x in data[first:last]]
                offsets = OffsetMap(texts, encoder.encode(texts), sizes)
                portion = batch.slice(first, last - first)
                found = _given(portion.column(2), offsets, rule) if sections else _lines(offsets, rule)
                owners, columns = found
                columns.append(pa.array(offsets.counts[owners], pa.int32()))
                yield pa.record_batch([portion.column(0).take(pa.array(owners)), *columns], names)

    names = ["id", "section", "start", "end", "tokens", "crossing", "document_tokens"]
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"id {kind}, section string, start long, end long, tokens double, crossing int, document_tokens int",
    )


def _lines(offsets: OffsetMap, rule: str) -> tuple[np.ndarray, list[pa.Array]]:
    owners, numbers, start, end = offsets.lines()
    tokens, crossing = offsets.allocate(start, end, rule)
    base = offsets.bounds[owners]
    columns = [pa.array(numbers).cast(pa.string()), pa.array(start - base), pa.array(end - base)]
    return owners, [*columns, pa.array(tokens), pa.array(crossing, pa.int32())]


def _given(sections: pa.Array, offsets: OffsetMap, rule: str) -> tuple[np.ndarray, list[pa.Array]]:
    counts = pc.fill_null(pc.list_value_length(sections), 0).to_numpy()
    owners = np.repeat(np.arange(len(counts)), counts)
    spans = sections.flatten()
    bounds = [pc.struct_field(spans, name).cast(pa.int64()) for name in ("start", "end")]
    start, end = (pc.fill_null(bound, 0).to_numpy() for bound in bounds)
    empty = np.zeros(len(owners), bool)
    for bound in bounds:
        empty |= bound.is_null().to_numpy(zero_copy_only=False)
    base, size = offsets.bounds[owners], np.diff(offsets.bounds)[owners]
    start, end = (base + np.where(empty, 0, np.clip(bound, 0, size)) for bound in (start, end))
    tokens, crossing = offsets.allocate(start, np.maximum(start, end), rule)
    names = pc.struct_field(spans, "section").cast(pa.string())
    return owners, [names, *bounds, pa.array(tokens), pa.array(crossing, pa.int32())]
