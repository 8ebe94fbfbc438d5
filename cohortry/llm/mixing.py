"""Mixing sources to target weights by hierarchical budgeting.

Levels of columns (say domain, language, source) form a tree. A token budget is handed
down it: each node splits its budget among its children in proportion to their
weights, but a child gets no more than its subtree can supply. What a child can't
take goes to its siblings first; only when all of them are exhausted is the node
itself short, and the rest goes to the node's own siblings. A leaf's supply is its tokens
times the epochs allowed. It takes its documents in whole epochs, each in an order of its own
drawn from the seed, and of the last epoch the longest prefix within its quota.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import fresh
from cohortry.sources.results import Workspace

#: Slices of an epoch's order. Only the slice in which the quota ends is ranked row by row.
SLICE_DIGITS = 3


@dataclass(frozen=True)
class Plan:
    """What to mix by.

    ``levels`` names the tree's levels from the root and ``tokens`` gives a document's tokens, both
    as SQL expressions over the documents. ``budget`` counts tokens; a Fraction is that part of all
    tokens. ``weights`` has whole-number weights by path from the root; a node without one weighs
    1.
    """

    levels: Mapping[str, str]
    tokens: str
    budget: int | Fraction
    weights: Mapping[tuple[str, ...], int] = field(default_factory=dict)
    epochs: int = 1
    seed: int = 0

    def named(self) -> dict[str, Column]:
        """The levels and tokens without nulls."""
        names = {n: F.coalesce(F.expr(c).cast("string"), F.lit("")) for n, c in self.levels.items()}
        return names | {"tokens": F.coalesce(F.expr(self.tokens).cast("long"), F.lit(0).cast("long"))}


def leaf_quotas(
    leaves: DataFrame,
    levels: Sequence[str],
    budget: int,
    weights: Mapping[tuple[str, ...], int],
    epochs: int,
) -> DataFrame:
    """``(levels, tokens, quota)`` per leaf; quotas are whole tokens.

    ``leaves`` has the levels and the leaf's ``tokens``. ``weights`` gives the whole-number weight
    of a node by its path from the root; a node without one weighs 1, a node of weight 0 gets
    nothing. Shares are rounded down, so a node may hand on less than its budget, by fewer tokens
    than it has children.
    """
    quotas = None
    for depth in range(1, len(levels) + 1):
        path, parent = list(levels[:depth]), list(levels[: depth - 1])
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * epochs).alias("supply"))
        nodes = nodes.withColumn("weight", _weight(path, weights))
        if quotas is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("long"))
        else:
            above = quotas.select(
                *(F.col(c).alias(f"_{c}") for c in parent), F.col("quota").alias("budget")
            )
            nodes = nodes.join(above, [F.col(c) == F.col(f"_{c}") for c in parent]).drop(
                *(f"_{c}" for c in parent)
            )
        quotas = _poured(nodes, parent, path[-1])
    totals = leaves.groupBy(*(F.col(c).alias(f"_{c}") for c in levels))
    totals = totals.agg(F.sum("tokens").alias("tokens"))
    return quotas.join(totals, [F.col(c) == F.col(f"_{c}") for c in levels]).select(
        *levels, "tokens", "quota"
    )


def _weight(path: Sequence[str], weights: Mapping[tuple[str, ...], int]) -> Column:
    known = [(names, weight) for names, weight in weights.items() if len(names) == len(path)]
    if not known:
        return F.lit(1).cast("long")
    named = F.create_map(
        *(F.lit(x) for names, weight in known for x in ("\u0000".join(names), weight))
    )
    return F.coalesce(named[F.concat_ws("\u0000", *path)], F.lit(1)).cast("long")


def _poured(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Each sibling's share of its parent's ``budget``, as ``quota``.

    Siblings fill up in the order of supply by weight; those before the first
    that keeps room are full, the others share what is left by weight. A window
    sees a parent's children, a few numbers each.
    """
    wanted = nodes.withColumn("weight", F.greatest("weight", F.lit(0)))
    ratio = F.col("supply") / F.nullif(F.col("weight").cast("double"), F.lit(0.0))
    order = [ratio.asc_nulls_last(), F.col(name)]
    siblings = Window.partitionBy(*(parent or [F.lit(0)]))
    so_far = siblings.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    claimed = F.coalesce(F.sum("weight").over(so_far), F.lit(0))
    rows = wanted.select(
        "*",
        F.coalesce(F.sum("supply").over(so_far), F.lit(0)).alias("taken"),
        (F.sum("weight").over(siblings) - claimed).alias("claims"),
    )
    fits = (F.col("weight") > 0) & (
        F.col("supply") * F.col("claims") <= F.col("weight") * (F.col("budget") - F.col("taken"))
    )
    rows = rows.withColumn("full", fits)
    open_ = F.when(~F.col("full") & (F.col("weight") > 0), F.struct("claims", "taken"))
    rows = rows.withColumn("first_open", F.max(open_).over(siblings))
    left = F.expr("(weight * (budget - first_open.taken)) div first_open.claims")
    quota = F.when(F.col("weight") == 0, 0).when(F.col("full"), F.col("supply")).otherwise(left)
    return rows.withColumn("quota", quota.cast("long")).drop("taken", "claims", "full", "first_open")


def draw(seed: int, epoch: Column, id: Column) -> Column:
    """A document's place in an epoch's order, as 32 hexadecimal digits."""
    parts = [F.lit(str(seed)), epoch.cast("string"), F.coalesce(id.cast("string"), F.lit(""))]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def mix(docs: DataFrame, work: Workspace, plan: Plan, id: str = "doc_id") -> DataFrame:
    """``(id, levels, tokens, copies)`` per selected row of ``docs``; copies counts its epochs.

    Null names are empty ones, null tokens none. In an epoch's order ties (repeated ids) go by
    tokens; rows equal in both stand or fall together. The prefix ends before the first row that
    would pass the quota. Rows without id are drawn as if the id were empty. A leaf without any
    token costs nothing and is taken whole; an empty table gives an empty result.
    """
    chosen = _choices(docs, work, plan, id)
    repeated = chosen.withColumn("n", F.explode(F.expr("sequence(1, int(rows))")))
    return repeated.select("id", *plan.levels, "tokens", "copies")


def mixed_documents(docs: DataFrame, work: Workspace, plan: Plan, id: str = "doc_id") -> DataFrame:
    """The selected rows of ``docs`` with all their columns, each as often as it has copies."""
    keys = {name: fresh(name) for name in ("id", *plan.levels, "tokens")}
    chosen = _choices(docs, work, plan, id).select(
        *(F.col(name).alias(key) for name, key in keys.items()), F.col("copies").alias(fresh("n"))
    )
    copies = chosen.columns[-1]
    values = {"id": F.col(id), **plan.named()}
    same = [docs_value.eqNullSafe(F.col(keys[name])) for name, docs_value in values.items()]
    times = F.sequence(F.lit(1), F.col(copies))
    return docs.join(chosen, same).withColumn(copies, F.explode(times)).select(*docs.columns)


def _choices(docs: DataFrame, work: Workspace, plan: Plan, id: str) -> DataFrame:
    """Distinct selected rows, with how many ``rows`` of the input each stands for."""
    names = list(plan.levels)
    rows = docs.select(F.col(id).alias("id"), *(c.alias(n) for n, c in plan.named().items()))
    # Equal rows are one from here on, so a row repeated many times is no hot key.
    rows = work.keep(rows.groupBy("id", *names, "tokens").agg(F.count("*").alias("rows")), "rows")
    weighed = F.col("tokens") * F.col("rows")
    leaves = work.keep(rows.groupBy(*names).agg(F.sum(weighed).alias("tokens")), "leaves")
    budget = plan.budget
    if isinstance(budget, Fraction):
        total = leaves.agg(F.sum("tokens")).first()[0] or 0
        budget = total * budget.numerator // budget.denominator
    quotas = leaf_quotas(leaves, names, budget, plan.weights, plan.epochs)
    whole = F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(plan.epochs)
    quotas = quotas.select(
        *(F.col(n).alias(f"_{n}") for n in names),
        whole.alias("whole"),
        (F.col("quota") - F.col("tokens") * whole).alias("rest"),
    )
    at_leaf = [F.col(n) == F.col(f"_{n}") for n in names]
    placed = rows.join(work.keep(quotas, "quotas"), at_leaf).drop(*(f"_{n}" for n in names))
    placed = placed.withColumn("place", draw(plan.seed, F.col("whole"), F.col("id")))
    slice_ = F.substring("place", 1, SLICE_DIGITS)
    placed = work.keep(placed.withColumn("slice", slice_), "placed")
    # Tokens before each slice: a leaf has as many rows here as there are slices.
    slices = placed.where("rest > 0").groupBy(*names, "slice").agg(
        F.sum(weighed).alias("here"), F.first("rest").alias("room")
    )
    earlier = Window.partitionBy(*names).orderBy("slice")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("here").over(earlier), F.lit(0)))
    ends = slices.where("before <= room and before + here > room").select(
        *(F.col(n).alias(f"_{n}") for n in names), F.col("slice").alias("end"), "before"
    )
    joined = placed.join(work.keep(ends, "ends"), at_leaf, "left").drop(*(f"_{n}" for n in names))
    upto = Window.partitionBy(*names).orderBy("place", "tokens", "id")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_end = joined.where("slice = end").withColumn(
        "taken", F.col("before") + F.sum(weighed).over(upto) <= F.col("rest")
    )
    others = joined.where("end is null or slice <> end").withColumn(
        "taken", F.coalesce(F.col("slice") < F.col("end"), F.lit(False))
    )
    copies = F.col("whole") + F.col("taken").cast("long")
    chosen = others.unionByName(at_end).withColumn("copies", copies.cast("int"))
    return chosen.where("copies > 0").select("id", *names, "tokens", "copies", "rows")
