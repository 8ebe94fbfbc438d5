"""Cohort membership. A cohort is any table with a ``person_id`` column.

Cohorts are reduced to distinct persons and matched with semi- and anti-joins, so
a person listed twice, or at two sites, counts once and never multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.skew import own_shuffle


def of_persons(rows: DataFrame, cohort: DataFrame) -> DataFrame:
    """Rows of persons in the cohort."""
    return rows.join(_members(cohort), "person_id", "left_semi").select(*rows.columns)


def join_persons(rows: DataFrame, cohort: DataFrame) -> DataFrame:
    """As :func:`of_persons`, for rows that come out of a join that filters them.

    Spark moves a semi-join below an inner one: all rows, not only those the inner
    join lets through, would then be shuffled by person. An inner join stays on top.
    """
    return rows.join(_members(cohort), "person_id").select(*rows.columns)


def without_persons(rows: DataFrame, cohort: DataFrame) -> DataFrame:
    """Rows of persons not in the cohort."""
    return rows.join(_members(cohort), "person_id", "left_anti").select(*rows.columns)


def add_site(persons: DataFrame, person: DataFrame) -> DataFrame:
    """The listed persons with their site, from the person table."""
    return of_persons(person.select("person_id", "site"), persons)


def _members(cohort: DataFrame) -> DataFrame:
    ids = cohort.select(F.col("person_id").cast("bigint").alias("person_id"))
    return own_shuffle(ids.distinct(), "person_id")
