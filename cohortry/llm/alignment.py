"""Cross-tokenizer alignment: tokens of two tokenizers grouped where both end at the same byte.

Both token sequences cover the same bytes. Every token points to the farthest-right token of the
other sequence that overlaps it; one whose partner ends where it ends itself, in the second sequence,
points to itself. Successors are doubled (each token takes its successor's successor) for all texts of
a portion at once, until nothing changes: then every token points to the terminal token of its
component, which is its group's label.

Id pairs linked by a group are counted by the texts that hold them. A text's pairs travel as one row of
distinct pairs with multiplicities; counts are grouped with partial sums and joined back.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortry.functions import own_shuffle
from cohortry.llm.bpe import in_portions
from cohortry.llm.common import pick, utf8
from cohortry.sources.results import Workspace

_ID_BITS = 32
_SPACE_MARK = "▁"
#: Rows that a task can number.
_ROW_BITS = 40
# A fixed value: how a byte-level tokenizer splits a text into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LONG_SPACE = re.compile(r"\s{1000}")


class ByteLevel:
    """A byte-level tokenizer from the content of its JSON file.

    Where the file's merges come in the order of the ids they make and words are split by the usual
    pattern, the ids are the ranks that ``tiktoken`` takes, which gives the same tokens several times
    faster. Its pattern's look-ahead overflows on very long white space; such texts, and other files,
    go through the ``tokenizers`` library.
    """

    def __init__(self, content: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.encode_special_tokens = True
        bytes_of = {c: b for b, c in _byte_characters().items()}
        ids = self.tokenizer.get_vocab(with_added_tokens=False)
        self.tokens = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for name, id in ids.items():
            self.tokens[id] = bytes(map(bytes_of.__getitem__, name)) if bytes_of.keys() >= set(name) else b""
        self.quick = None
        if _in_order(json.loads(content)):
            ranks = {token: id for id, token in enumerate(self.tokens) if token}
            self.quick = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        quick = [self.quick is not None and not _LONG_SPACE.search(t) for t in texts]
        slow = [t for t, is_quick in zip(texts, quick, strict=True) if not is_quick]
        others = iter(self.tokenizer.encode_batch_fast(slow, add_special_tokens=False))
        return [
            self.quick.encode_ordinary(t) if is_quick else next(others).ids
            for t, is_quick in zip(texts, quick, strict=True)
        ]


def _in_order(file: dict) -> bool:
    """Whether a pair's rank is the id of its merge, words are split by ``PATTERN`` and nothing is
    done to the text before.
    """
    model, split = file["model"], file["pre_tokenizer"] or {}
    merges = (m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ()))
    return (
        model["type"] == "BPE"
        and not model.get("ignore_merges")
        and not file["normalizer"]
        and (split.get("type"), split.get("use_regex", True), split.get("add_prefix_space")) == ("ByteLevel", True, False)
        and all(model["vocab"].get("".join(m)) == id for id, m in enumerate(merges, 256))
    )


class Pieces:
    """A ``sentencepiece`` tokenizer, from the content of its model file."""

    def __init__(self, content: bytes) -> None:
        self.tokenizer = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.tokens = [self._bytes(id) for id in range(self.tokenizer.vocab_size())]

    def _bytes(self, id: int) -> bytes:
        piece = self.tokenizer.id_to_piece(id)
        if self.tokenizer.is_byte(id):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace(_SPACE_MARK, " ").encode()

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self.tokenizer.encode(list(texts), num_threads=1)


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


@lru_cache(2)
def _tokenizers(byte_level: bytes, pieces: bytes) -> tuple[ByteLevel, Pieces, Rendered]:
    a, b = ByteLevel(byte_level), Pieces(pieces)
    return a, b, Rendered(len(a.tokens), len(b.tokens))


class Rendered:
    """Ids in decimal with what follows them in a text of groups."""

    def __init__(self, first: int, second: int) -> None:
        self.second = 2 * first
        self.table = [f"{id}{end}" for id in range(first) for end in ",|"]
        self.table += [f"{id}{end}" for id in range(second) for end in ",;"]

    def text(self, places: Iterable[int]) -> str:
        return "".join(map(self.table.__getitem__, places))[:-1]


@dataclass(frozen=True)
class Tokens:
    """A tokenizer's tokens over several texts, one after the other."""

    ids: np.ndarray
    ends: np.ndarray  # in bytes of all texts
    texts: np.ndarray  # the text of each token

    @staticmethod
    def of(encoded: Sequence[Sequence[int]], sizes: np.ndarray) -> Tokens:
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids = np.fromiter(chain.from_iterable(encoded), np.int64, counts.sum())
        return Tokens(ids, np.cumsum(sizes[ids]), np.repeat(np.arange(len(encoded)), counts))


def successors(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For tokens of both sequences, first all of ``a``, the farthest-right one that overlaps each.

    ``a`` and ``b`` are the tokens' ends, ascending and without empty tokens; both end at the same place.
    """
    # The token of the other sequence that holds a token's last byte is the last to overlap it.
    from_a = len(a) + np.searchsorted(b, a, "left")
    from_b = np.searchsorted(a, b, "left")
    own = np.arange(len(a), len(a) + len(b))
    return np.concatenate([from_a, np.where(a[from_b] == b, own, from_b)] if len(a) else [from_a])


def terminals(successor: np.ndarray) -> np.ndarray:
    """The terminal token that each token's successors lead to, by doubling."""
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor
        successor = doubled


@dataclass(frozen=True)
class Aligned:
    """Groups of several texts, numbered from 0 in their order."""

    a: Tokens
    b: Tokens
    of_a: np.ndarray  # the group of each token
    of_b: np.ndarray
    texts: np.ndarray  # the text of each group

    @staticmethod
    def of(a: Tokens, b: Tokens) -> Aligned:
        label = terminals(successors(a.ends, b.ends))
        # Terminal tokens ascend along the text, so their order is the groups' order.
        is_terminal = np.zeros(len(label), bool)
        is_terminal[label] = True
        number = (np.cumsum(is_terminal) - 1)[label]
        ends = np.flatnonzero(is_terminal) - len(a.ids)
        return Aligned(a, b, number[: len(a.ids)], number[len(a.ids) :], b.texts[ends])

    def rendered(self, texts: int, table: Rendered) -> list[str]:
        """Each text's groups, as in ``a1,a2|b1;a3|b2,b3``; nothing for a text without tokens."""
        last_a = np.append(self.of_a[1:] != self.of_a[:-1], True)[: len(self.of_a)]
        last_b = np.append(self.of_b[1:] != self.of_b[:-1], True)[: len(self.of_b)]
        places = np.concatenate([2 * self.a.ids + last_a, table.second + 2 * self.b.ids + last_b])
        order = np.argsort(np.concatenate([2 * self.of_a, 2 * self.of_b + 1]), kind="stable")
        owners = np.concatenate([self.a.texts, self.b.texts])[order]
        bounds = np.searchsorted(owners, np.arange(texts + 1))
        listed = places[order].tolist()
        return [table.text(listed[s:e]) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, packed id pair and multiplicity of each text's distinct linked pairs.

        Ids are counted within a group first, so a group of many repeated tokens makes few pairs.
        """
        group_a, id_a, times_a = _counted(self.of_a, self.a.ids)
        group_b, id_b, times_b = _counted(self.of_b, self.b.ids)
        first = np.searchsorted(group_b, group_a, "left")
        partners = np.searchsorted(group_b, group_a, "right") - first
        left = np.repeat(np.arange(len(group_a)), partners)
        right = np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners) + first[left]
        text, pair = self.texts[group_a[left]], id_a[left] << _ID_BITS | id_b[right]
        times = times_a[left] * times_b[right]
        # Ids are small, so text and pair fit one key.
        width = int(id_b.max(initial=0)) + 1
        key = (text * (int(id_a.max(initial=0)) + 1) + id_a[left]) * width + id_b[right]
        order = np.argsort(key, kind="stable")
        starts = _starts(key[order])
        pick_ = order[starts]
        sums = np.add.reduceat(times[order], starts) if len(times) else times
        return text[pick_], pair[pick_], sums


def _counted(groups: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each group, and how often each is there; groups ascend."""
    keys = np.sort(groups << _ID_BITS | ids, kind="stable")
    starts = _starts(keys)
    keys = keys[starts]
    return keys >> _ID_BITS, keys & ((1 << _ID_BITS) - 1), np.diff(np.append(starts, len(ids)))


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where a new one of sorted keys begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])


def _aligned_texts(texts: Sequence[bytes], byte_level: bytes, pieces: bytes) -> pa.RecordBatch:
    """A row per text: its counts, digest, distinct pairs and their multiplicities."""
    tokenizer_a, tokenizer_b, table = _tokenizers(byte_level, pieces)
    plain = [t.decode("utf-8", "replace") for t in texts]
    encoded_a = tokenizer_a.encode([" " + t for t in plain])
    encoded_b = tokenizer_b.encode(plain)
    for n, text in enumerate(texts):
        spaced = b" " + text
        if not text or any(
            b"".join(map(t.tokens.__getitem__, ids)) != spaced
            for t, ids in ((tokenizer_a, encoded_a[n]), (tokenizer_b, encoded_b[n]))
        ):
            encoded_a[n] = encoded_b[n] = ()
    sizes = [np.fromiter(map(len, t.tokens), np.int64) for t in (tokenizer_a, tokenizer_b)]
    a, b = Tokens.of(encoded_a, sizes[0]), Tokens.of(encoded_b, sizes[1])
    found = Aligned.of(a, b)
    text, pair, times = found.links()
    count = lambda owners, weights=None: np.bincount(owners, weights, len(texts)).astype(np.int64)
    offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
    groups = found.rendered(len(texts), table)
    columns = {
        "n_a": pa.array(count(a.texts)),
        "n_b": pa.array(count(b.texts)),
        "n_groups": pa.array(count(found.texts)),
        "n_links": pa.array(count(text, times)),
        "groups_sha256": pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
        "pairs": pa.ListArray.from_arrays(offsets, pa.array(pair, pa.int64())),
        "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
    }
    return pa.record_batch(list(columns.values()), list(columns))


def aligned(docs: DataFrame, byte_level: bytes, pieces: bytes, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times)`` per row of ``docs``.

    ``row`` numbers the rows; it holds once the result is written.
    """
    rows = pick(docs, id=id, text=text).withColumn("text", utf8("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _ROW_BITS
        for batch in batches:
            data = batch.column(1).to_pylist()
            for first, last in in_portions(data):
                found = _aligned_texts(data[first:last], byte_level, pieces)
                numbers = pa.array(np.arange(number, number + last - first))
                number += last - first
                columns = [numbers, batch.column(0).slice(first, last - first), *found.columns]
                yield pa.record_batch(columns, ["row", "id", *found.schema.names])

    return rows.mapInArrow(
        run,
        f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<long>",
    )


def pair_counts(found: DataFrame) -> DataFrame:
    """``(pair, count, is_best)``: texts that hold a pair linked, and whether its first id has no
    higher count with another.
    """
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    # The pairs of an id are as many as the other vocabulary's ids at most.
    of_id = Window.partitionBy(F.shiftrightunsigned("pair", _ID_BITS))
    return counts.withColumn("is_best", F.col("count") == F.max("count").over(of_id))


def align(
    docs: DataFrame,
    work: Workspace,
    byte_level: bytes,
    pieces: bytes,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row of ``docs``.

    The first tokenizer encodes a space and the text, the second the text, to which it adds the space
    itself. Texts that are null or empty, and those of which either's tokens don't join to the space
    and the text, have no tokens: numbers are 0 and the digest is empty. Every row is a text of its
    own, also repeated ones and those without id. An empty table gives an empty result.
    """
    found = work.keep(aligned(docs, byte_level, pieces, id, text), "aligned")
    counts = work.keep(pair_counts(found), "pairs")
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("row", F.col("link.pairs").alias("linked"), F.col("link.times").alias("times"))
    links = links.join(own_shuffle(counts, "pair"), F.col("linked") == F.col("pair"))
    sums = links.groupBy(F.col("row").alias("of")).agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    rows = found.drop("pairs", "times")
    joined = rows.join(work.keep(sums, "sums"), F.col("row") == F.col("of"), "left")
    total = lambda name: F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name)
    return joined.select(
        "id", "n_a", "n_b", "n_groups", "n_links", total("n_best"), total("count_sum"), "groups_sha256"
    )
