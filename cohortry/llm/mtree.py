"""Exact top-k search by inner product in M-trees.

Inner products have no triangle inequality, so vectors are lifted by one component: a candidate x
gets ``sqrt(R^2 - |x|^2)``, with R the largest norm, and a query gets 0. Then ``d(q, x)^2 = |q|^2 +
R^2 - 2 q.x``: the nearest candidates are those of the largest product, and distances obey the
triangle inequality.

Candidates are split into shards around sampled pivots, each with an M-tree of its own: pages of
bounded size, each with a routing object, a covering radius and its entries' distances to the
routing object. A block of queries walks a tree together: pages come from a queue, the one with
the smallest possible distance to any query first, and the walk ends when that can't reach the k
best of any query so far. A page is scored at once for the queries that its bounds leave; an entry
whose distance to the parent differs from the query's by more than the query's limit for every one
of them is never compared. Products that are compared are exact integers.

Each query first searches the shard next to it; with the limit found there it goes on to those
other shards that can hold something better.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import pick
from cohortry.sources.results import Workspace

#: Entries of a page, vectors of a shard, queries searched at once.
PAGE, SHARD, BLOCK = 256, 8192, 4096
#: Vectors sampled by a hash of their ids: pivots are among them, and they give each query a first
#: limit.
SAMPLE, PIVOTS = 2048, 256
#: Rounding errors that bounds allow for, as parts of the largest norm and of its square.
_SLACK, _SLACK_SQUARED = 1e-5, 1e-12
#: Whole numbers up to here are exact as floats.
_EXACT = 2.0**53
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_PAGES = (
    "shard int, page int, parent int, routing binary, radius double, ids binary, vectors binary, "
    "distances binary"
)


def lifted(vectors: np.ndarray, square: float) -> np.ndarray:
    """Candidates with the component that makes all their norms equal."""
    rest = np.sqrt(np.maximum(square - (vectors.astype(float) ** 2).sum(1), 0))
    return np.hstack([vectors, rest[:, None]])


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - to) ** 2).sum(1))


def _all_distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """From each point to each of the others."""
    squares = (points**2).sum(1)[:, None] + (to**2).sum(1) - 2 * points @ to.T
    return np.sqrt(np.maximum(squares, 0))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; beyond 64 bits they are the largest or smallest there.

    As floats where no sum can leave the range in which floats are exact, else as integers.
    """
    left, right = queries.astype(float), vectors.astype(float)
    largest = np.sqrt((left**2).sum(1).max(initial=0) * (right**2).sum(1).max(initial=0))
    if largest < _EXACT / 2:
        return left @ right.T
    whole = queries.astype(object) @ vectors.astype(object).T
    return np.clip(whole, _LEAST, _MOST).astype(np.int64)


@dataclass
class Page:
    """A node: where it hangs, what it covers, and for a leaf its entries."""

    number: int
    parent: int
    routing: np.ndarray
    radius: float
    ids: np.ndarray
    vectors: np.ndarray
    distances: np.ndarray  # of the entries, or of an inner node's children, to the routing object


@dataclass(frozen=True)
class Ball:
    """The candidates nearest to a pivot, and their shards."""

    pivot: int
    radius: float
    first: int
    shards: int


def build(ids: np.ndarray, vectors: np.ndarray, square: float) -> list[Page]:
    """The pages of a tree over some candidates, parents before children; the first is the root."""
    points = lifted(vectors, square)
    pages: list[Page] = []

    def add(rows: np.ndarray, routing: np.ndarray, parent: int) -> int:
        apart = _distances(points[rows], routing)
        number = len(pages)
        radius = float(apart.max(initial=0))
        none = np.empty(0)
        if len(rows) <= PAGE:
            pages.append(Page(number, parent, routing, radius, ids[rows], vectors[rows], apart))
            return number
        page = Page(number, parent, routing, radius, none.astype(np.int64), vectors[:0], none)
        pages.append(page)
        parts = _parts(rows)
        heads = [points[part[0]] for part in parts]
        for part, head in zip(parts, heads, strict=True):
            add(part, head, number)
        page.distances = np.array([_distances(h[None], routing)[0] for h in heads])
        return number

    def _parts(rows: np.ndarray) -> list[np.ndarray]:
        """Around evenly spaced members; equal vectors, which these can't tell apart, by number."""
        count = min(PAGE, -(-len(rows) // (PAGE // 2)))
        heads = rows[np.linspace(0, len(rows) - 1, count).astype(int)]
        own = points[heads]
        squares = (own**2).sum(1) - 2 * points[rows] @ own.T
        nearest = squares.argmin(1)
        parts = [rows[nearest == k] for k in range(count)]
        # The head first, as it routes.
        parts = [
            np.concatenate([[h], p[p != h]]) for h, p in zip(heads, parts, strict=True) if h in p
        ]
        if len(parts) < 2 or sum(map(len, parts)) < len(rows):
            return [rows[i : i + PAGE] for i in range(0, len(rows), PAGE)]
        return parts

    add(np.arange(len(ids)), points[0], -1)
    return pages


class Tree:
    """A tree read back from its pages."""

    def __init__(self, pages: Iterable[Page]) -> None:
        self.pages = {p.number: p for p in pages}
        self.children: dict[int, list[int]] = {}
        for p in self.pages.values():
            self.children.setdefault(p.parent, []).append(p.number)
        below = {n: [self.pages[c] for c in numbers] for n, numbers in self.children.items()}
        self.routing = {n: np.stack([p.routing for p in pages]) for n, pages in below.items()}
        self.radii = {n: np.array([p.radius for p in pages]) for n, pages in below.items()}

    def search(
        self, queries: np.ndarray, own: np.ndarray, k: int, least: np.ndarray, square: float
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The best ``k`` of each query but its ``own`` id, and how many pairs were compared.

        Returned are the numbers of the queries, the ids and the scores, one entry per result, each
        query's from the best on. Scores below ``least`` needn't be found: k others are known to reach it.
        Ties go to the smaller id.
        """
        best = _Best(len(queries), k, least)
        points = np.hstack([queries.astype(float), np.zeros((len(queries), 1))])
        norms = (points**2).sum(1)
        slack = _SLACK * (np.sqrt(square) + np.sqrt(norms.max(initial=0)))
        compared = 0

        def limits(some: np.ndarray) -> np.ndarray:
            """The distances at which a candidate can still count."""
            floor = best.floor[some]
            squares = norms[some] + square - 2 * floor.astype(float)
            reach = np.sqrt(np.maximum(squares, 0) + _SLACK_SQUARED * (norms[some] + square)) + slack
            return np.where(floor == _LEAST, np.inf, reach)

        root = self.children[-1][0]
        everyone = np.arange(len(queries))
        start = _all_distances(points, self.pages[root].routing[None])[:, 0]
        bounds = start - self.pages[root].radius
        queue = [(float(bounds.min(initial=0)), root, everyone, start, bounds)]
        while queue:
            _, number, some, apart, bounds = heapq.heappop(queue)
            reach = limits(some)
            left = bounds <= reach
            if not left.any():
                continue
            some, apart, reach, page = some[left], apart[left], reach[left], self.pages[number]
            gap = np.abs(apart[:, None] - page.distances)
            children = self.children.get(number)
            if children:
                radii = self.radii[number]
                near = gap - radii <= reach[:, None]
                columns = np.flatnonzero(near.any(0))
                found = _all_distances(points[some], self.routing[number][columns])
                compared += found.size
                for at, column in enumerate(columns):
                    bounds = found[:, at] - radii[column]
                    into = near[:, column] & (bounds <= reach)
                    if into.any():
                        entry = (some[into], found[into, at], bounds[into])
                        heapq.heappush(queue, (float(bounds[into].min()), children[column], *entry))
                continue
            columns = np.flatnonzero((gap <= reach[:, None]).any(0))
            scores = products(queries[some], page.vectors[columns])
            compared += scores.size
            ids = page.ids[columns]
            best.add(some, ids, scores, own)
        return *best.found(), compared


class _Best:
    """The k best of each query, from what is added page by page."""

    def __init__(self, queries: int, k: int, least: np.ndarray) -> None:
        self.k, self.queries = k, queries
        known = np.clip(np.floor(np.where(np.isfinite(least), least, 0)), -(2.0**62), 2.0**62)
        #: What a score has to reach; the smallest number where all do.
        self.floor = np.where(np.isfinite(least), known.astype(np.int64), _LEAST)
        none = np.empty(0, np.int64)
        self._held, self._pending, self._waiting = (none, none, none), [], 0

    def add(self, some: np.ndarray, ids: np.ndarray, scores: np.ndarray, own: np.ndarray) -> None:
        good = (scores >= self.floor[some][:, None]) & (own[some][:, None] != ids)
        rows, columns = np.nonzero(good)
        if len(rows):
            self._pending.append((some[rows], ids[columns], scores[rows, columns].astype(np.int64)))
            self._waiting += len(rows)
            if 2 * self._waiting >= self.k * self.queries:
                self._settle()

    def _settle(self) -> None:
        query, ids, scores = (np.concatenate(c) for c in zip(self._held, *self._pending, strict=True))
        # Turned around bit by bit, larger scores come first; negated, the smallest would overflow.
        order = np.lexsort((ids, ~scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        last = place == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], scores[last])
        keep = place < self.k
        self._held, self._pending, self._waiting = (query[keep], ids[keep], scores[keep]), [], 0

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._settle()
        return self._held


def quantised(vectors: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """``(id, vector)`` with whole-number components; rows without id or a full, finite vector left
    out.

    Rows equal in id and vector are one.
    """
    rows = pick(vectors, id=id, vector=vector).where("id is not null and vector is not null")
    numbers = F.transform("vector", lambda x: x.cast("double"))
    rows = rows.withColumn("vector", numbers)
    rows = rows.where(
        ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    return rows.select("id", F.transform("vector", lambda x: _whole(x, scale)).alias("vector")).distinct()


def _whole(x: Column, scale: int) -> Column:
    """``floor(scale * x)``, or the largest or smallest number of 64 bits beyond these."""
    scaled = x * F.lit(float(scale))
    small = F.abs(scaled) < 2.0**63
    return F.when(small, F.floor(scaled)).when(scaled > 0, F.lit(_MOST)).otherwise(F.lit(_LEAST))


def top_k(
    vectors: DataFrame,
    work: Workspace,
    k: int = 20,
    query_every: int = 20,
    scale: int = 64,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` best candidates by inner product.

    Queries are the rows whose id is divisible by ``query_every``; candidates are all rows of
    another id. Components become ``floor(scale * x)``; components and scores beyond 64 bits count as
    the largest or smallest number there. Null vectors, those with null or non-finite components and
    rows without id take no part; repeated rows are one, rows of one id and different vectors are
    queries of their own; shorter vectors count as filled up with zeros. With fewer than ``k``
    candidates all are returned, for an empty table nothing.
    """
    rows = work.keep(quantised(vectors, id, vector, scale), "vectors")
    square_of = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    facts = rows.agg(
        F.max(square_of).alias("square"),
        F.max(F.size("vector")).alias("width"),
        F.count("*").alias("n"),
    ).first()
    if not facts["n"]:
        return rows.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score long"
        )
    square, width = float(facts["square"]), facts["width"]
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    seen_ids = sample["id"].to_numpy()
    seen = _matrix(sample["vector"].combine_chunks(), width)
    pivots = lifted(np.unique(seen[: min(PIVOTS, -(-facts["n"] // SHARD))], axis=0), square)

    placed = work.keep(_placed(rows, pivots, width, square), "placed")
    near = placed.groupBy("pivot").agg(F.count("*").alias("n"), F.max("apart").alias("radius"))
    balls, first = [], 0
    for ball in sorted(near.collect(), key=lambda b: b["pivot"]):
        balls.append(Ball(ball["pivot"], ball["radius"], first, -(-ball["n"] // SHARD)))
        first += balls[-1].shards
    firsts = F.create_map(*(F.lit(x) for b in balls for x in (b.pivot, b.first)))
    counts = F.create_map(*(F.lit(x) for b in balls for x in (b.pivot, b.shards)))
    pivot = F.col("pivot")
    shard = firsts[pivot] + F.pmod(F.xxhash64("id"), counts[pivot])
    pages = work.keep(_pages(placed.withColumn("shard", shard.cast("int")), width, square), "pages")

    # The sample gives every query a first limit, the shard next to it a better one.
    asked = placed.where(F.pmod("id", F.lit(query_every)) == 0)
    ask = F.xxhash64("vector").alias("ask")
    asked = _limited(asked.select("id", ask, "vector"), _least_scores(seen_ids, seen, k, square), width)
    centres = pivots[[b.pivot for b in balls]]
    to = _reached(centres, balls, width, square)
    search = _Search(pages, facts["n"] // query_every + 1, k, width, square)
    home = work.keep(search.results(_sent(asked, to, home=True)), "home")
    better = home.groupBy("query_id", "ask").agg(F.count("*").alias("hits"), F.min("score").alias("last"))
    better = better.where(F.col("hits") >= k).select("query_id", F.col("ask").alias("of"), "last")
    asked = asked.join(better, (F.col("id") == F.col("query_id")) & (F.col("ask") == F.col("of")), "left")
    asked = asked.withColumn("least", F.greatest("least", F.col("last").cast("double")))
    asked = asked.select("id", "ask", "vector", "least")
    found = home.union(work.keep(search.results(_sent(asked, to, home=False)), "others"))
    order = Window.partitionBy("query_id", "ask").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(rows: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    found = np.zeros((len(rows), width), np.int64)
    sizes = rows.value_lengths().to_numpy(zero_copy_only=False)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found[np.repeat(np.arange(len(rows)), sizes), place] = rows.flatten().to_numpy(zero_copy_only=False)
    return found


def _unpacked(rows: pa.Array | pd.Series, width: int) -> np.ndarray:
    """Vectors stored as bytes."""
    return np.frombuffer(b"".join(rows.to_pylist() if isinstance(rows, pa.Array) else rows), np.int64).reshape(-1, width)


def _packed(vectors: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in vectors], pa.binary())


def _placed(rows: DataFrame, pivots: np.ndarray, width: int, square: float) -> DataFrame:
    """Each vector, as bytes, with its nearest pivot and the distance to it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), width)
            points = lifted(vectors, square)
            nearest = ((pivots**2).sum(1) - 2 * points @ pivots.T).argmin(1)
            apart = _distances(points, pivots[nearest])
            columns = [batch.column(0), _packed(vectors), pa.array(nearest.astype(np.int32)), pa.array(apart)]
            yield pa.record_batch(columns, ["id", "vector", "pivot", "apart"])

    return rows.mapInArrow(run, "id long, vector binary, pivot int, apart double")


def _pages(dealt: DataFrame, width: int, square: float) -> DataFrame:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        pages = build(rows["id"].to_numpy(), _unpacked(rows["vector"], width), square)
        return pd.DataFrame(
            [
                (
                    key[0],
                    p.number,
                    p.parent,
                    p.routing.tobytes(),
                    p.radius,
                    p.ids.astype(np.int64).tobytes(),
                    p.vectors.astype(np.int64).tobytes(),
                    p.distances.tobytes(),
                )
                for p in pages
            ],
            columns=[c.split()[0] for c in _PAGES.split(", ")],
        )

    return dealt.select("shard", "id", "vector").groupBy("shard").applyInPandas(run, _PAGES)


def _least_scores(ids: np.ndarray, vectors: np.ndarray, k: int, square: float):
    """For some queries, the score that ``k`` of the given candidates are known to reach."""
    points = vectors.T.astype(float)

    def least(query_ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
        if len(ids) < k:
            return np.full(len(query_ids), -np.inf)
        own = queries.astype(float)
        scores = own @ points
        scores[query_ids[:, None] == ids] = -np.inf
        known = np.partition(scores, len(ids) - k, axis=1)[:, -k]
        largest = np.sqrt((own**2).sum(1) * square)
        return np.where(largest < _EXACT / 2, known, known - _SLACK * largest)

    return least


def _limited(rows: DataFrame, least, width: int) -> DataFrame:
    """Queries with the score they are sure to reach."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            known = least(ids, _unpacked(batch.column(2), width))
            yield pa.record_batch([*batch.columns, pa.array(known)], ["id", "ask", "vector", "least"])

    return rows.mapInArrow(run, "id long, ask long, vector binary, least double")


def _reached(centres: np.ndarray, balls: list[Ball], width: int, square: float):
    """For some queries, the shard next to each, and the others that can reach its limit."""
    radii = np.array([b.radius for b in balls])
    shards = [range(b.first, b.first + b.shards) for b in balls]

    def reached(ids: np.ndarray, queries: np.ndarray, known: np.ndarray) -> tuple[list, list]:
        points = np.hstack([queries.astype(float), np.zeros((len(queries), 1))])
        norms = (points**2).sum(1)
        squares = np.maximum(norms + square - 2 * known, 0) + _SLACK_SQUARED * (norms + square)
        apart = _all_distances(points, centres)
        slack = _SLACK * (np.sqrt(square) + np.sqrt(norms))
        can = apart - radii <= (np.sqrt(squares) + slack)[:, None]
        nearest = apart.argmin(1) if len(apart) else np.empty(0, int)
        home = [shards[b][id % len(shards[b])] for b, id in zip(nearest, ids.tolist(), strict=True)]
        others = [
            [s for ball in np.flatnonzero(row) for s in shards[ball] if s != own]
            for row, own in zip(can, home, strict=True)
        ]
        return [[s] for s in home], others

    def run(home: bool):
        def shards_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                known = batch.column(3).to_numpy(zero_copy_only=False)
                into = reached(ids, _unpacked(batch.column(2), width), known)[0 if home else 1]
                columns = [*batch.columns, pa.array(into, pa.list_(pa.int32()))]
                yield pa.record_batch(columns, ["id", "ask", "vector", "least", "shards"])

        return shards_of

    return run


def _sent(asked: DataFrame, to, home: bool) -> DataFrame:
    """A row per query and shard to search."""
    kinds = "id long, ask long, vector binary, least double, shards array<int>"
    sent = asked.mapInArrow(to(home), kinds)
    return sent.select("id", "ask", "vector", "least", F.explode("shards").alias("shard"))


@dataclass(frozen=True)
class _Search:
    """Searches of blocks of queries in shards."""

    pages: DataFrame
    queries: int
    k: int
    width: int
    square: float

    def results(self, sent: DataFrame) -> DataFrame:
        """``(query_id, ask, vec_id, score)``: the best of each shard that a query is sent to."""
        blocks = max(1, -(-self.queries // BLOCK))
        block = F.pmod(F.xxhash64("id", "ask"), F.lit(blocks)).cast("int").alias("block")
        sent = sent.select("*", block)
        # Pages go to each block of queries that looks into their shard.
        meets = sent.select(F.col("shard").alias("of"), F.col("block").alias("for_block")).distinct()
        copies = self.pages.join(meets, F.col("shard") == F.col("of")).drop("of")
        return (
            sent.groupBy("shard", "block")
            .cogroup(copies.groupBy("shard", "for_block"))
            .applyInPandas(
                _searcher(self.k, self.width, self.square), "query_id long, ask long, vec_id long, score long"
            )
        )


def _searcher(k: int, width: int, square: float):
    def run(queries: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(pages):
            return pd.DataFrame({"query_id": [], "ask": [], "vec_id": [], "score": []}, dtype="int64")
        tree = Tree(
            Page(
                r.page,
                r.parent,
                np.frombuffer(r.routing),
                r.radius,
                np.frombuffer(r.ids, np.int64),
                np.frombuffer(r.vectors, np.int64).reshape(-1, width),
                np.frombuffer(r.distances),
            )
            for r in pages.itertuples()
        )
        own = queries["id"].to_numpy()
        vectors = _unpacked(queries["vector"], width)
        query, ids, scores, _ = tree.search(vectors, own, k, queries["least"].to_numpy(), square)
        found = {"query_id": own[query], "ask": queries["ask"].to_numpy()[query], "vec_id": ids, "score": scores}
        return pd.DataFrame(found, dtype="int64")

    return run
