"""Code list membership."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions.skew import own_shuffle
from cohortry.sources.codesets import inline_codes


@dataclass(frozen=True)
class Marked:
    """A code list that :func:`mark_codes` looked up before; a boolean column says which rows are in it."""

    column: str


# A code list: a table with a concept_id column, literal concept ids, or a mark the rows carry.
Codes = DataFrame | Sequence[int] | Marked


def in_codes(rows: DataFrame, column: str, codes: Codes) -> DataFrame:
    """Rows whose ``column`` is in the list; a null is in no list."""
    if isinstance(codes, Marked):
        return rows.where(F.col(codes.column))
    if not isinstance(codes, DataFrame):
        return rows.where(F.col(column).isin(list(codes)))
    listed = codes.select(F.col("concept_id").cast("bigint").alias(column))
    return rows.join(listed, column, "left_semi").select(*rows.columns)


def in_any_codes(rows: DataFrame, **lists: Sequence[Codes]) -> DataFrame:
    """Rows in which any of the named columns is in any of its lists.

    One pass; each column costs one look-up, which Spark can split at a hot code.
    """
    found = rows
    listed = [F.col(c) for codes in lists.values() for c in marks(*codes)]
    for column, codes in lists.items():
        tables = [
            _as_table(rows.sparkSession, c).select("concept_id") for c in codes if not isinstance(c, Marked)
        ]
        if not tables:
            continue
        ids = reduce(DataFrame.union, tables).select(F.col("concept_id").cast("bigint")).distinct()
        marked = own_shuffle(ids.where("concept_id IS NOT NULL"), "concept_id").select(
            F.col("concept_id").alias(f"_{column}"), F.lit(True).alias(f"_in_{column}")
        )
        found = found.join(marked, F.col(column) == F.col(f"_{column}"), "left")
        listed.append(F.col(f"_in_{column}").isNotNull())
    return found.where(reduce(lambda a, b: a | b, listed)).select(*rows.columns)


def marks(*lists: Codes) -> list[str]:
    """The columns of the lists that are marked."""
    return [codes.column for codes in lists if isinstance(codes, Marked)]


def mark_codes(rows: DataFrame, **lists: Mapping[str, Codes]) -> DataFrame:
    """The rows of :func:`in_any_codes`, with a boolean column per list, of the list's name.

    Rows that are stored and picked by several lists later are looked up once, by the one join that
    finds them, and not shuffled by their codes for each list again.
    """
    found = rows
    for column, named in lists.items():
        flags = flag_codes(rows.sparkSession, **named).withColumnRenamed("concept_id", f"_{column}")
        found = found.join(flags, F.col(column) == F.col(f"_{column}"), "left")
    listed = reduce(lambda a, b: a | b, (F.col(f"_{column}").isNotNull() for column in lists))
    names = (name for named in lists.values() for name in named)
    return found.where(listed).select(
        *rows.columns, *(F.coalesce(F.col(name), F.lit(False)).alias(name) for name in names)
    )


def flagged(rows: DataFrame, column: str, **lists: Codes) -> DataFrame:
    """Rows whose ``column`` is in any of the lists, with a boolean column per list.

    One look-up for all lists, and none if all are marked.
    """
    marked = {name: F.col(codes.column) for name, codes in lists.items() if isinstance(codes, Marked)}
    others = {name: codes for name, codes in lists.items() if name not in marked}
    found = rows
    if others:
        flags = flag_codes(rows.sparkSession, **others).withColumnRenamed("concept_id", column)
        found = rows.join(flags, column, "left" if marked else "inner")
    if marked:
        looked_up = {name: F.coalesce(F.col(name), F.lit(False)) for name in others}
        found = found.withColumns(marked | looked_up).where(reduce(lambda a, b: a | b, map(F.col, lists)))
    return found.select(*rows.columns, *lists)


def flag_codes(spark: SparkSession, **lists: Codes) -> DataFrame:
    """One row per concept of any list, with a boolean column per list.

    Joining this once replaces one membership test, and one scan, per list.
    """
    tagged = [
        _as_table(spark, codes).select(
            F.col("concept_id").cast("bigint").alias("concept_id"),
            *(F.lit(other == name).alias(other) for other in lists),
        )
        for name, codes in lists.items()
    ]
    flags = (
        reduce(DataFrame.unionByName, tagged)
        .where(F.col("concept_id").isNotNull())
        .groupBy("concept_id")
        .agg(*(F.max(name).alias(name) for name in lists))
    )
    return own_shuffle(flags, "concept_id")


def _as_table(spark: SparkSession, codes: Codes) -> DataFrame:
    return codes if isinstance(codes, DataFrame) else inline_codes(spark, codes)
