"""Connected components of a link table, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions import own_shuffle
from cohortry.sources.results import Workspace


def components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """One row ``(node, root)`` per linked node that isn't its component's smallest.

    ``links`` has two columns of long; order and repeats don't matter, self links and
    nulls are ignored. Rounds of star contraction: first every
    node hands its larger neighbours to its smallest one, then every node hands its
    smaller neighbours to the smallest of them. Each round is grouping and joining
    over rows, so no neighbourhood is held in one place; each is written, which cuts
    the lineage. It ends when a round changes nothing, with stars around the roots.
    """
    a, b = links.columns
    edges = work.keep(_down(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), f"{name}-0")
    before, turn = _digest(edges), 0
    while before[0]:
        turn += 1
        edges = work.keep(_small_star(_large_star(edges)), f"{name}-{turn}")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _down(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node u to the smaller node v."""
    return (
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy(F.col("u").alias("hub")).agg(F.min("v").alias("low"))
    least = least.select(F.col("hub"), F.least("hub", "low").alias("low"))
    larger = both.where("v > u")
    joined = larger.join(own_shuffle(least, "hub"), F.col("u") == F.col("hub"))
    return _down(joined.select(F.col("v").alias("u"), F.col("low").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("hub")).agg(F.min("v").alias("low"))
    joined = edges.join(own_shuffle(least, "hub"), F.col("u") == F.col("hub"))
    moved = joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
    return _down(moved.union(least.select("hub", "low")))


def _digest(edges: DataFrame) -> tuple[int, int]:
    found = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
    ).first()
    return found["n"], int(found["sum"] or 0)
