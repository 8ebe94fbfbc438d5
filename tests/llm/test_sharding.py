"""Placement by the key law, and what moves when the tree changes."""

import math
import zlib

import pytest
import xxhash
from edge import ROWS, documents
from pyspark.sql import functions as F

from cohortry.llm.sharding import PER_RACK, RACKS, Shard, Tree, assign


def placed(spark, tree, keys=range(4000)):
    df = spark.createDataFrame([(str(k),) for k in keys], "k string")
    return {r["k"]: r["s"] for r in df.select("k", tree.shard_of(F.col("k")).alias("s")).collect()}


def descend(tree, key):
    """The same descent in plain Python: best region, best rack in it, best shard in that."""

    def draw(shard):
        start = xxhash.xxh64_intdigest(key.encode(), 42)
        uniform = (xxhash.xxh64_intdigest(f"shard:{shard.number}".encode(), start) >> 11) + 0.5
        return math.log(uniform / 2.0**53) / shard.weight

    left = [s for s in tree.shards if s.weight > 0]
    for level in ("region", "rack", "number"):
        names = {getattr(s, level) for s in left}
        best = max(names, key=lambda name: max(draw(s) for s in left if getattr(s, level) == name))
        left = [s for s in left if getattr(s, level) == best]
    return left[0].number


def test_plain_descent_agrees(spark):
    uneven = Tree((Shard("a", "x", 0, 1), Shard("a", "y", 1, 2), Shard("b", "z", 2, 4), Shard("b", "z", 3, 0.5), Shard("b", "w", 4, 0)))
    for tree in (uneven, Tree.even(1), Tree.even(16), Tree.even(23)):
        for key, shard in placed(spark, tree, range(300)).items():
            assert shard == descend(tree, key)


def test_one_law_by_shard_count(spark):
    """The placement by n + 1 shards is what n shards grow to, and rows move only into the new one."""
    assert all(Tree.even(n).grown() == Tree.even(n + 1) for n in range(41))
    assert len({s.region for s in Tree.even(40).shards}) == -(-40 // (PER_RACK * RACKS))
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    trees = [Tree.even(n).shard_of(F.col("k")).alias(f"n{n}") for n in range(1, 42)]
    rows = df.select("k", *trees).collect()
    for n in range(1, 41):
        moved = {r[f"n{n + 1}"] for r in rows if r[f"n{n}"] != r[f"n{n + 1}"]}
        assert moved == {n}


def test_shares_follow_weights(spark):
    tree = Tree((Shard("a", "x", 0, 1), Shard("a", "y", 1, 2), Shard("b", "z", 2, 4), Shard("b", "z", 3, 1), Shard("b", "w", 4, 0)))
    found = list(placed(spark, tree).values())
    for number, share in {0: 1 / 8, 1: 2 / 8, 2: 4 / 8, 3: 1 / 8, 4: 0}.items():
        assert abs(found.count(number) / len(found) - share) < 0.03


@pytest.mark.parametrize("count", [1, 2, 5, 16])
def test_one_more_shard_takes_rows_only_into_itself(spark, count):
    before, after = placed(spark, Tree.even(count)), placed(spark, Tree.even(count).grown())
    moved = {k for k in before if before[k] != after[k]}
    assert {after[k] for k in moved} == {count}
    assert abs(len(moved) / len(before) - 1 / (count + 1)) < 0.05


def test_movement_stays_in_subtrees_whose_weight_changes(spark):
    """A heavier shard draws rows into its region and, within it, into its rack; regions left alone swap none."""
    shards = [Shard(f"r{n // 4}", f"k{n // 2}", n) for n in range(12)]
    heavier = [Shard(s.region, s.rack, s.number, 2.0 if s.number == 0 else 1.0) for s in shards]
    before, after = placed(spark, Tree(tuple(shards))), placed(spark, Tree(tuple(heavier)))
    for key in before:
        old, new = shards[before[key]], shards[after[key]]
        if old.region != new.region:
            assert new.region == "r0"
        elif old.rack != new.rack:
            assert new.rack == "k0"
        elif old != new:
            assert new.number == 0


def test_no_weight_no_shard(spark):
    assert set(placed(spark, Tree(()), range(3)).values()) == {None}


@pytest.mark.parametrize("clashes", [False, True])
def test_documents(spark, work, clashes):
    rows = assign(documents(spark, clashes=clashes), Tree.even(4), work).collect()
    found = sorted(((r["id"], r["size"], r["text_crc32"]) for r in rows), key=repr)
    data = [(id, (t or "").encode()) for id, t in ROWS]
    assert found == sorted(((id, len(d) + 1, zlib.crc32(d)) for id, d in data), key=repr)
    slots, shards = {}, {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        shards.setdefault(r["id"], set()).add((r["shard"], r["grown_shard"]))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())


def test_slots_do_not_depend_on_partitions(spark, work):
    docs = spark.range(3000).selectExpr("id * 7 as doc_id", "repeat('x', int(id % 50)) as text")
    docs = docs.union(spark.range(500).selectExpr("77L", "'hot'"))
    a, b = (sorted(map(tuple, assign(docs.repartition(n), Tree.even(16), work).collect())) for n in (1, 9))
    assert a == b
    by_shard = {}
    for r in a:
        by_shard.setdefault(r[4], []).append(r[5])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and set(by_shard) == set(range(16))


def test_empty_table(spark, work):
    assert assign(documents(spark, []), Tree.even(4), work).collect() == []
