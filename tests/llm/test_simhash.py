"""Fingerprints and groups against brute force."""

import random

import pytest
import xxhash
from edge import LONG, ROWS, documents

from cohortry.llm import queries, simhash
from cohortry.llm.common import prepared
from cohortry.llm.components import components


def plain_simhash(text: str) -> int:
    words, word = [], ""
    for c in text:
        if c in " \t\n\v\f\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    words += [word] * bool(word)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: dict, distance: int = 4) -> dict:
    """The smallest linked id of each id, by comparing all pairs of fingerprints."""
    distinct = sorted(set(prints.values()))
    group = {p: p for p in distinct}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                group[root(a)] = root(b)
    least = {}
    for id, p in sorted(prints.items()):
        least.setdefault(root(p), id)
    return {id: least[root(p)] for id, p in prints.items()}


@pytest.mark.parametrize("text", [t or "" for _, t in ROWS if t != LONG] + ["A b C d", "x " * 500, " a b"])
def test_fingerprint(text):
    assert simhash.simhash(text.encode()) & (1 << 64) - 1 == plain_simhash(text)


def test_fingerprint_in_portions(monkeypatch):
    whole = simhash.simhash(LONG.encode())
    monkeypatch.setattr(simhash, "_SHINGLES_AT_ONCE", 7)
    assert simhash.simhash(LONG.encode()) == whole


@pytest.mark.parametrize("distance", [0, 1, 3, 4, 7])
def test_every_near_pair_meets_under_a_key(distance):
    """The ring loses no pair: some start keeps every chain's budget and shares a key."""
    ring, draw = simhash.Ring(distance), random.Random(distance)
    width = ring.ends[ring.key_segments - 1]
    for _ in range(500):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randint(0, distance)):
            b ^= 1 << bit
        difference = a ^ b
        turned = [(difference >> at | difference << 64 - at) & (1 << 64) - 1 for at in ring.starts]
        assert any(
            all((t & (1 << end) - 1).bit_count() <= ring.budget(n) for n, end in enumerate(ring.ends, 1))
            and t & (1 << width) - 1 in ring.neighbours
            for t in turned
        )


def test_linked_classes(spark, work):
    """Clouds of near fingerprints, chains, and strangers."""
    draw = random.Random(1)
    prints = set()
    for _ in range(12):
        p = draw.getrandbits(64)
        for _ in range(25):
            prints.add(p)
            prints.add(p ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 5))))
            if draw.random() < 0.4:
                p ^= sum(1 << b for b in draw.sample(range(64), 4))
    prints |= {draw.getrandbits(64) for _ in range(100)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    linked = {r["node"]: r["root"] for r in simhash._linked_classes(table, work, 4).collect()}
    expected = groups({p: p & (1 << 64) - 1 for p in signed})
    assert {p: linked.get(p, p) for p in signed} == expected


@pytest.mark.parametrize("clashes", [False, True])
def test_documents(spark, work, clashes):
    found = simhash.near_duplicates(documents(spark, clashes=clashes), work).collect()
    prints = [(id, simhash.simhash((t or "").encode())) for id, t in ROWS]
    assert sorted((repr(r["id"]), r["fp"]) for r in found) == sorted((repr(i), p) for i, p in prints)
    of = {(r["id"], r["fp"]): r["component"] for r in found}
    empty, same = simhash.simhash(b""), simhash.simhash(ROWS[4][1].encode())
    assert of[(2, empty)] == of[(3, empty)] == of[(9, empty)] == of[(None, empty)] == 2
    assert of[(5, same)] == of[(6, same)] == 5


def test_table_equals_brute_force(spark):
    rows = queries.op4_simhash(spark, "/root/testdata/sf0.01").collect()
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    assert {r["doc_id"]: r["component_id"] for r in rows} == groups(prints)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(50).collect()
    assert all(prints[d["doc_id"]] == plain_simhash(d["text"]) for d in docs)


def test_empty_table(spark, work):
    assert simhash.near_duplicates(documents(spark, []), work).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randint(0, 150), draw.randint(0, 150)) for _ in range(90)]
    links += [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(30)] + [(7, 7), (None, 1)]
    draw.shuffle(links)
    table = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["root"] for r in components(table, prepared(spark), "c").collect()}
    root = {n: n for link in links for n in link if n is not None}
    for _ in root:
        for a, b in links:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    assert found == {n: r for n, r in root.items() if n != r}
