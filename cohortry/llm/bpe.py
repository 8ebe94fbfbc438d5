"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A text is cut by the vocabulary's pattern; each piece starts as single bytes. A segment tree
over byte positions holds, at the position of each live token, the rank of the pair it forms
with the next live token, and in each inner node the leftmost smallest rank below. The root
is therefore the next merge. A merge changes three leaves (the merged token, the one it
swallowed, the live neighbour before it), each carried up in logarithmic time.

Most pieces are short and many are new, so those are merged many at a time, in rows
of one array; long ones have a tree of their own.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cohortry.llm.common import pick, utf8

#: Pieces up to this many bytes are merged many at a time.
SHORT = 64
_CACHED_PIECES = 250_000
_BYTES_AT_ONCE = 1 << 19
_ROWS_AT_ONCE = 1 << 14
_NONE = np.int64(1) << 62
_ID_BITS = 24
_AT_BITS = 8


class Vocabulary:
    """Tokens by id, and for each pair of ids that merges the merged token's id.

    The rank of a pair is the id of what it merges to.
    """

    def __init__(self, tokens: dict[bytes, int]) -> None:
        self.ids = tokens
        self.tokens: list[bytes | None] = [None] * (max(tokens.values()) + 1)
        for token, id in tokens.items():
            self.tokens[id] = token
        self.single = np.array([tokens[bytes([b])] for b in range(256)], np.int64)
        self.pairs = {
            tokens[a] << _ID_BITS | tokens[b]: id
            for token, id in tokens.items()
            for cut in range(1, len(token))
            if (a := token[:cut]) in tokens and (b := token[cut:]) in tokens
        }
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        order = np.argsort(keys)
        self._keys = np.append(keys[order], _NONE)
        self._ranks = np.append(np.fromiter(self.pairs.values(), np.int64, len(keys))[order], -1)

    @staticmethod
    @lru_cache(4)
    def parse(ranks: bytes) -> Vocabulary:
        """From the lines of a rank file: a token in base64, a space, its id."""
        lines = (line.split() for line in ranks.splitlines() if line)
        return Vocabulary({base64.b64decode(token): int(id) for token, id in lines})

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of many pairs, ``_NONE`` where a pair doesn't merge."""
        keys = left << _ID_BITS | right
        at = np.searchsorted(self._keys, keys)
        return np.where(self._keys[at] == keys, self._ranks[at], _NONE)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.tokens[id] for id in ids])


def merge_one(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of one piece, by a segment tree of its own."""
    n, pairs, single = len(piece), vocabulary.pairs, vocabulary.single
    ids = [int(single[b]) for b in piece]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    width = 1 << max(n - 1, 1).bit_length()
    none = (1 << 62, 0)
    tree = [none] * (2 * width)

    def leaf(at: int) -> tuple[int, int]:
        rank = pairs.get(ids[at] << _ID_BITS | ids[after[at]]) if after[at] < n else None
        return none if rank is None else (rank, at)

    def put(at: int, value: tuple[int, int]) -> None:
        node = width + at
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least

    for at in range(n):
        tree[width + at] = leaf(at)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    while tree[1] is not none:
        rank, at = tree[1]
        gone = after[at]
        ids[at], after[at] = rank, after[gone]
        if after[at] < n:
            before[after[at]] = at
        put(gone, none)
        put(at, leaf(at))
        if before[at] >= 0:
            put(before[at], leaf(before[at]))
    live, at = [], 0
    while at < n:
        live.append(ids[at])
        at = after[at]
    return live


def merge_many(pieces: Sequence[bytes], vocabulary: Vocabulary) -> list[tuple[int, ...]]:
    """Ids of each of many pieces of 1 to ``SHORT`` bytes; a row of the arrays is a piece."""
    found: list[tuple[int, ...]] = [()] * len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    for width in (4, 8, 16, 32, 64):
        rows = np.nonzero((sizes <= width) & (sizes > (width // 2 if width > 4 else 0)))[0]
        for first in range(0, len(rows), _ROWS_AT_ONCE):
            some = rows[first : first + _ROWS_AT_ONCE]
            merged = _merge_rows([pieces[i] for i in some], sizes[some], width, vocabulary)
            for i, ids in zip(some.tolist(), merged, strict=True):
                found[i] = ids
    return found


def _merge_rows(
    pieces: list[bytes], sizes: np.ndarray, width: int, vocabulary: Vocabulary
) -> Iterator[tuple[int, ...]]:
    count, span = len(pieces), width + 1  # a place more, for what has no neighbour
    data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
    places = np.arange(width)
    inside = places < sizes[:, None]
    ids = np.zeros((count, span), np.int64)
    ids[:, :width] = vocabulary.single[data.reshape(count, width)]
    after = np.tile(np.arange(1, span + 1), (count, 1))
    before = np.tile(np.arange(-1, span - 1), (count, 1))
    tree = np.full((count, 2 * width), _NONE)
    paired = places[:-1] + 1 < sizes[:, None]
    ranks = vocabulary.ranks_of(ids[:, : width - 1], ids[:, 1:width])
    tree[:, width : 2 * width - 1] = np.where(
        paired & (ranks < _NONE), ranks << _AT_BITS | places[:-1], _NONE
    )
    level = width
    while level > 1:
        level //= 2
        tree[:, level : 2 * level] = tree[:, 2 * level : 4 * level].reshape(count, level, 2).min(2)

    ids_, after_, before_, tree_ = ids.ravel(), after.ravel(), before.ravel(), tree.ravel()
    live_ = inside.copy().ravel()
    rows = np.arange(count)
    while True:
        root = tree_[rows * (2 * width) + 1]
        rows, root = rows[root < _NONE], root[root < _NONE]
        if not len(rows):
            break
        base, top, size = rows * span, rows * (2 * width), sizes[rows]
        at = root & ((1 << _AT_BITS) - 1)
        gone = after_[base + at]
        follow = after_[base + gone]
        ids_[base + at] = root >> _AT_BITS
        after_[base + at] = follow
        before_[base + np.minimum(follow, width)] = at
        live_[rows * width + gone] = False
        ahead = before_[base + at]
        own = vocabulary.ranks_of(ids_[base + at], ids_[base + np.minimum(follow, width)])
        own = np.where((follow < size) & (own < _NONE), own << _AT_BITS | at, _NONE)
        has = ahead >= 0
        prior = vocabulary.ranks_of(ids_[base + np.maximum(ahead, 0)], ids_[base + at])
        prior = np.where(prior < _NONE, prior << _AT_BITS | ahead, _NONE)
        tree_[top + width + gone] = _NONE
        tree_[top + width + at] = own
        tree_[(top + width + ahead)[has]] = prior[has]
        # All three leaves climb together; one without a live neighbour goes with its own leaf.
        node = width + np.stack([gone, at, np.where(has, ahead, at)])
        level = width
        while level > 1:
            level //= 2
            node >>= 1
            child = top + 2 * node
            tree_[top + node] = np.minimum(tree_[child], tree_[child + 1])
    live = live_.reshape(count, width)
    flat = ids[:, :width][live].tolist()
    end = 0
    for n in live.sum(1).tolist():
        end += n
        yield tuple(flat[end - n : end])


class Encoder:
    """Encodes texts; remembers the ids of pieces it has seen, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary = vocabulary
        self.pieces = regex.compile(pattern).findall
        self._known: dict[str, tuple[int, ...]] = {}

    @staticmethod
    @lru_cache(4)
    def of(ranks: bytes, pattern: str) -> Encoder:
        encoder = Encoder(Vocabulary.parse(ranks), pattern)
        gc.freeze()  # the vocabulary stays; walking over it again and again takes a third of the time
        return encoder

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        """Ids of each text. Ids of a piece that is a token itself are that token's."""
        cut = [self.pieces(text) for text in texts]
        known = self._known
        if len(known) > _CACHED_PIECES:
            known.clear()
        new = set().union(*cut).difference(known)
        short, ids = [], self.vocabulary.ids
        for piece in new:
            data = piece.encode()
            whole = ids.get(data)
            if whole is not None:
                known[piece] = (whole,)
            elif len(data) <= SHORT:
                short.append((piece, data))
            else:
                known[piece] = tuple(merge_one(data, self.vocabulary))
        merged = merge_many([data for _, data in short], self.vocabulary)
        known.update(zip((piece for piece, _ in short), merged, strict=True))
        return [list(chain.from_iterable(map(known.__getitem__, pieces))) for pieces in cut]


def in_portions(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of some megabytes together, or of one longer text."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _BYTES_AT_ONCE:
            yield first, i
            first, size = i, 0
        size += len(text)
    if len(texts) > first:
        yield first, len(texts)


def encode(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    id: str = "doc_id",
    text: str = "text",
    decode: bool = False,
) -> DataFrame:
    """``(id, ids)`` per row of ``docs``, with ``decode`` also the bytes the ids stand for.

    ``ranks`` is the content of the rank file, of a fixed size, and goes to every task.
    A null text is an empty one and has no ids. Rows come out as they come in, also
    repeated ones and those without id.
    """
    rows = pick(docs, id=id, text=text).withColumn("text", utf8("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(ranks, pattern)
        for batch in batches:
            data = batch.column(1).to_pylist()
            for first, last in in_portions(data):
                found = encoder.encode([x.decode("utf-8", "replace") for x in data[first:last]])
                lists = pa.ListArray.from_arrays(
                    np.cumsum([0, *map(len, found)], dtype=np.int32),
                    pa.array(np.fromiter(chain.from_iterable(found), np.int32)),
                )
                columns = [batch.column(0).slice(first, last - first), lists]
                if decode:
                    texts = [encoder.vocabulary.decode(x) for x in found]
                    columns.append(pa.array(texts, pa.binary()))
                yield pa.record_batch(columns, ["id", "ids", "decoded"][: len(columns)])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>" + ", decoded binary" * decode)


def decode(rows: DataFrame, ranks: bytes, id: str = "id", ids: str = "ids") -> DataFrame:
    """``(id, decoded)`` per row: the bytes of its ids; null ids have none."""
    picked = pick(rows, id=id, ids=ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.parse(ranks)
        for batch in batches:
            texts = [vocabulary.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.binary())], ["id", "decoded"])

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, decoded binary")
