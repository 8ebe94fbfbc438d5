"""Trees and searches against all inner products."""

import math
import random

import numpy as np
import pytest
from edge import CLASHES, rows_of

from cohortry.llm import mtree


def brute(vectors, k, every, scale=64):
    def whole(x):
        return min(max(x, -(2**63)), 2**63 - 1)

    known = {
        (id, tuple(whole(math.floor(scale * x)) for x in v))
        for id, v in vectors
        if id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    found = []
    for id, q in known:
        if id % every == 0:
            scores = sorted((-whole(sum(a * b for a, b in zip(q, v))), other) for other, v in known if other != id)
            found += [(id, rank, other, -s) for rank, (s, other) in enumerate(scores[:k], 1)]
    return sorted(found, key=repr)


def points(n, width, seed, kinds=6):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 30, (kinds, width))
    return (centres[draw.integers(kinds, size=n)] + draw.normal(0, 6, (n, width))).round().astype(np.int64)


def checked(pages, vectors, square):
    """Every entry in one leaf, within the radii of all pages above it, at the stored distances."""
    by_number = {p.number: p for p in pages}
    where = {}
    for page in pages:
        if len(page.ids):
            assert len(page.ids) <= mtree.PAGE
            where |= dict.fromkeys(page.ids.tolist(), page.number)
            own = mtree.lifted(page.vectors, square)
            assert np.allclose(np.sqrt(((own - page.routing) ** 2).sum(1)), page.distances)
    assert sorted(where) == list(range(len(vectors)))
    lifted = mtree.lifted(vectors, square)
    for id, number in where.items():
        while number >= 0:
            page = by_number[number]
            assert np.sqrt(((lifted[id] - page.routing) ** 2).sum()) <= page.radius + 1e-9
            number = page.parent


@pytest.mark.parametrize("n", [1, 5, 300])
def test_tree(monkeypatch, n):
    monkeypatch.setattr(mtree, "PAGE", 8)
    vectors = points(n, 5, n)
    square = float((vectors**2).sum(1).max())
    pages = mtree.build(np.arange(n), vectors, square)
    checked(pages, vectors, square)
    assert_searched(mtree.Tree(pages), vectors, np.arange(0, n, 7), 4, square)
    if n == 300:
        share = assert_searched(mtree.Tree(pages), vectors, np.arange(0, n, 7), 4, square)
        assert share < 0.8  # bounds spare comparisons of clustered vectors


def assert_searched(tree, vectors, queries, k, square):
    """Searches as all products; returns the share of pairs that were compared."""
    none = np.full(len(queries), -np.inf)
    query, ids, scores, compared = tree.search(vectors[queries], queries, k, none, square)
    for at, i in enumerate(queries.tolist()):
        exact = sorted((-sum(map(int.__mul__, vectors[i].tolist(), v.tolist())), j) for j, v in enumerate(vectors) if j != i)
        mine = query == at
        assert [(-s, j) for s, j in zip(scores[mine].tolist(), ids[mine].tolist())] == exact[:k]
    return compared / (len(queries) * len(vectors))


def test_equal_vectors(monkeypatch):
    monkeypatch.setattr(mtree, "PAGE", 4)
    vectors = np.ones((50, 3), np.int64)
    pages = mtree.build(np.arange(50), vectors, 3.0)
    checked(pages, vectors, 3.0)
    _, ids, scores, _ = mtree.Tree(pages).search(vectors[7:8], np.array([7]), 5, np.array([-np.inf]), 3.0)
    assert ids.tolist() == [0, 1, 2, 3, 4] and scores.tolist() == [3] * 5


def test_share_of_pairs_compared():
    """Pages of full size over clusters that lie apart: most pairs are never compared."""
    vectors = points(6000, 8, 3, kinds=40)
    square = float((vectors**2).sum(1).max())
    tree = mtree.Tree(mtree.build(np.arange(6000), vectors, square))
    shares = [assert_searched(tree, vectors, np.array([i]), 20, square) for i in range(0, 6000, 600)]
    print(f"compared: {np.mean(shares):.3f} of the pairs")
    assert np.mean(shares) < 0.4


@pytest.mark.parametrize("size", [10**7, 2 * 10**8, 2**31])
def test_large_components(monkeypatch, size):
    """Products beyond what floats hold exactly are worked out as integers."""
    monkeypatch.setattr(mtree, "PAGE", 8)
    draw = np.random.default_rng(size)
    vectors = draw.integers(-size, size, (100, 2))
    square = float((vectors.astype(float) ** 2).sum(1).max())
    pages = mtree.build(np.arange(100), vectors, square)
    assert_searched(mtree.Tree(pages), vectors, np.arange(0, 100, 9), 6, square)


def test_products_beyond_64_bits_stop_there():
    largest, least = 2**63 - 1, -(2**63)
    big = np.array([[largest, largest], [least, least], [1, 0]])
    assert mtree.products(big, big).tolist() == [[largest, least, largest], [least, largest, least], [largest, least, 1]]


ROWS = [
    (0, [0.5, -0.25, 0.1]), (20, [0.5, -0.25, 0.1]), (3, [0.5, -0.25, 0.1]), (3, [0.5, -0.25, 0.1]),
    (4, None), (40, [0.1, None, 0.2]), (60, [float("nan"), 0.0, 0.0]), (5, [float("inf"), 0.0, 0.0]),
    (80, []), (6, [1.0]), (7, [0.0, 0.0, 0.0]), (8, [-0.9, 0.3, 0.2]), (8, [0.9, 0.3, 0.2]), (None, [1.0, 1.0, 1.0]),
    (-20, [0.3, 0.3, 0.3]), (100, [1e-9, -1e-9, 0.999]), (120, [0.5, 0.5]), (120, [-0.5, -0.5]),
]
#: Components of 32 bits and more; the last two leave 64 bits.
LARGE = [(9, [4e7, 1.0]), (140, [5e7, -1.0, 3.5]), (11, [-3e8, 2.0]), (160, [1e300, 0.0]), (12, [-1e300])]


@pytest.mark.parametrize("clashes, k, large", [(False, 3, []), (True, 50, []), (False, 3, LARGE[:3]), (True, 50, LARGE)])
def test_edge_rows(spark, work, clashes, k, large):
    rows = ROWS + large
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    if clashes:
        df = df.selectExpr("*", *(f"'clash' as `{c}`" for c in [*CLASHES, "vector", "pivot", "least", "block"]))
    found = rows_of(mtree.top_k(df, work, k=k), "query_id", "rank", "vec_id", "score")
    assert found == brute(rows, k, 20)


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(0, None)], [(1, [1.0]), (2, [2.0])]])
def test_few_rows(spark, work, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(mtree.top_k(df, work)) == []


def test_many_shards_and_blocks(spark, work, monkeypatch):
    for name, value in {"PAGE": 8, "SHARD": 60, "BLOCK": 3, "SAMPLE": 40, "PIVOTS": 5}.items():
        monkeypatch.setattr(mtree, name, value)
    draw = random.Random(1)
    rows = [(i, [x / 64 for x in v]) for i, v in enumerate(points(400, 6, 9).tolist())]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # a third of all are one vector
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = rows_of(mtree.top_k(df, work, k=5, query_every=20), "query_id", "rank", "vec_id", "score")
    assert found == brute(rows, 5, 20)
