"""Sharding by a hierarchical weighted hash tree.

Shards are leaves under racks under regions. Each shard draws a number from the row's key and its own
name, weighted by its own weight; a rack's draw is the best below it, a region's the best of its racks,
so a subtree wins in proportion to the weight below it. A row descends from level to level into the
child of the best draw. A draw depends on nothing but the key and the shard, so if weights change, rows
move only into shards that became heavier or out of ones that became lighter, wherever these stand.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import pick, utf8
from cohortry.sources.results import Workspace

#: Parts of a shard in which slots are counted on their own.
PARTS = 1024
#: Shards of a rack and racks of a region, where nothing else is said.
PER_RACK, RACKS = 4, 2
_LAW = "key"
_LEVELS = ("region", "rack", "number")


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    number: int
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    """Where shards stand; shards of no weight get no rows."""

    shards: tuple[Shard, ...]

    @staticmethod
    def even(shards: int) -> Tree:
        """So many shards of weight 1; the tree of one more is this one grown."""
        tree = Tree(())
        while len(tree.shards) < shards:
            tree = tree.grown()
        return tree

    def grown(self, weight: float = 1.0) -> Tree:
        """The tree with one more shard, which takes rows into itself only.

        It stands where its number says: racks and regions are filled one after the other.
        """
        number = max((s.number for s in self.shards), default=-1) + 1
        rack = number // PER_RACK
        return Tree((*self.shards, Shard(f"region{rack // RACKS}", f"rack{rack}", number, weight)))

    def shard_of(self, key: Column) -> Column:
        """The shard a key descends to; null if the tree has no weight."""
        best = _best(key, [s for s in self.shards if s.weight > 0], _LEVELS)
        return F.lit(None).cast("int") if best is None else best["number"]


def _best(key: Column, shards: Sequence[Shard], levels: Sequence[str]) -> Column | None:
    """The best draw below a node, with the shard that made it: the best of its children's."""
    children: dict[object, list[Shard]] = {}
    for shard in shards:
        children.setdefault(getattr(shard, levels[0]), []).append(shard)
    if levels[1:]:
        draws = [_best(key, below, levels[1:]) for below in children.values()]
    else:
        draws = [
            F.struct(_draw(key, number, sum(s.weight for s in own)).alias("draw"), F.lit(number).alias("number"))
            for number, own in children.items()
        ]
    if not draws:
        return None
    return F.greatest(*draws) if len(draws) > 1 else draws[0]


def _draw(key: Column, shard: int, weight: float) -> Column:
    """ln(u) / weight for a uniform u: the largest of several wins in proportion to its weight."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(f"shard:{shard}")), 11) + F.lit(0.5)) / F.lit(2.0**53)
    return F.log(uniform) / F.lit(float(weight))


def assign(
    docs: DataFrame,
    tree: Tree,
    work: Workspace,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(id, size, text_crc32, law, shard, slot, grown_shard)`` per row of ``docs``.

    ``size`` is the text's bytes and one more, ``slot`` the row's place in its shard, gapless from
    0. The shard depends on the id and the tree alone, for even shards on the id and their count, so rows of one id share a shard, and rows
    without id, too; each repeated row gets a slot of its own. A null text is an empty one.
    ``grown_shard`` is the shard with one more of them. An empty table gives an empty result.
    """
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    rows = pick(docs, id=id, text=text).withColumn("text", utf8("text"))
    rows = rows.select(
        "id",
        (F.octet_length("text").cast("long") + 1).alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.lit(_LAW).alias("law"),
        tree.shard_of(key).cast("int").alias("shard"),
        tree.grown().shard_of(key).cast("int").alias("grown_shard"),
    )
    # Equal rows are one row with a count, so a repeated row is no large part.
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("rows"))
    part = F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(PARTS))
    rows = work.keep(rows.withColumn("part", part), "rows")
    counts = rows.groupBy("shard", "part").agg(F.sum("rows").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        F.col("shard").alias("of"),
        F.col("part").alias("at"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"),
    )
    first = work.keep(first, "parts")
    within = Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("place", F.coalesce(F.sum("rows").over(within), F.lit(0)))
    joined = placed.join(first, F.col("shard").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at")))
    joined = joined.withColumn("copy", F.explode(F.expr("sequence(0L, rows - 1)")))
    slot = F.col("first") + F.col("place") + F.col("copy")
    return joined.select("id", "size", "text_crc32", "law", "shard", slot.alias("slot"), "grown_shard")
