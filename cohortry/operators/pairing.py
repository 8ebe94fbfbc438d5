"""Two kinds of diagnosis on the same date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions import of_persons, own_shuffle
from cohortry.sources.results import Keep, keep_aside

_COLUMNS = [
    "condition_occurrence_id",
    "person_id",
    "site",
    "condition_start_date",
    "condition_concept_id",
    "condition_concept_name",
    "condition_source_concept_id",
    "condition_source_concept_name",
    "condition_source_value",
    "visit_occurrence_id",
    "kidney_related",
    "sle",
]


def same_date_pair(
    conditions: DataFrame, codeset: DataFrame, *, keep: Keep = keep_aside
) -> DataFrame:
    """Listed conditions on dates when the person has a kidney-related and an SLE one.

    ``codeset`` marks its entries with 0/1 in ``kidney_related`` and ``sle``; one
    entry may be both. Sites are not told apart. Adds ``any_kidney_related``,
    ``any_sle`` and ``kidney_related_and_sle``, all 1 in the result.

    The dates that qualify are found by aggregation, which reduces a crowded date
    to one row before it is matched with the condition rows. A null date is a date of its own.
    The listed conditions are stored by ``keep``, so that conditions are read once.
    """
    listed = codeset.select(
        F.col("concept_id").alias("condition_concept_id"), "kidney_related", "sle"
    )
    rows = keep(conditions.join(listed, "condition_concept_id").select(*_COLUMNS), "listed_conditions")
    paired = (
        rows.groupBy("person_id", "condition_start_date")
        .agg(
            F.bool_or(F.col("kidney_related") == 1).alias("_kidney"),
            F.bool_or(F.col("sle") == 1).alias("_sle"),
        )
        .where("_kidney AND _sle")
        .select(F.col("person_id").alias("_person"), F.col("condition_start_date").alias("_date"))
    )
    same = (F.col("person_id") == F.col("_person")) & F.col("condition_start_date").eqNullSafe(F.col("_date"))
    return (
        rows.join(own_shuffle(paired, "_person"), same)
        .select(*_COLUMNS)
        .distinct()
        .select(
            *_COLUMNS,
            F.lit(1).alias("any_kidney_related"),
            F.lit(1).alias("any_sle"),
            F.lit(1).alias("kidney_related_and_sle"),
        )
    )


def same_date_pair_for_cohort(
    cohort: DataFrame, conditions: DataFrame, codeset: DataFrame, *, keep: Keep = keep_aside
) -> DataFrame:
    """:func:`same_date_pair` among the conditions of a cohort.

    A pair concerns a single person, so the cohort is applied first.
    """
    return same_date_pair(of_persons(conditions, cohort), codeset, keep=keep)
