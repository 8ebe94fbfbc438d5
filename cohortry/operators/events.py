"""Procedures and conditions of a code list, with the person's age or a cohort."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.defaults import (
    AGE_BOUND_YEARS,
    DAYS_PER_YEAR,
    GUIDED_BIOPSY,
    KIDNEY_BIOPSY,
    KIDNEY_TEXT,
    KIDNEY_TEXT_OR_CODE,
    NOT_KIDNEY_TEXT,
    WINDOW_END,
    WINDOW_START,
)
from cohortry.functions import (
    Codes,
    days_between,
    flagged,
    in_codes,
    join_persons,
    mentions,
    of_persons,
    own_shuffle,
    within,
)


def procedures_in_codeset(
    procedures: DataFrame, person: DataFrame, codeset: Codes, cohort: DataFrame | None = None
) -> DataFrame:
    """Listed procedures, of the cohort if one is given, with the age in days.

    Adds ``birth_date`` and ``procedure_age_days``.
    """
    listed = in_codes(procedures, "procedure_concept_id", codeset)
    return _with_age_days(listed, person, cohort, "procedure_date", "procedure_age_days")


def conditions_in_codeset(
    conditions: DataFrame, person: DataFrame, codeset: Codes, cohort: DataFrame | None = None
) -> DataFrame:
    """Listed conditions, of the cohort if one is given, with the age in days.

    Adds ``birth_date`` and ``condition_age_days``.
    """
    listed = in_codes(conditions, "condition_concept_id", codeset)
    return _with_age_days(listed, person, cohort, "condition_start_date", "condition_age_days")


def transplant_events(
    conditions: DataFrame,
    procedures: DataFrame,
    person: DataFrame,
    cohort: DataFrame,
    codeset: Codes,
    *,
    age_bound_years: int = AGE_BOUND_YEARS,
    first_day: dt.date = WINDOW_START,
    last_day: dt.date = WINDOW_END,
) -> DataFrame:
    """Listed conditions and procedures of the cohort, in the window and below the age.

    Both kinds come in one layout. Occurrence ids of the two kinds may coincide;
    (``table_name``, ``occurrence_id``) identifies an event.
    """
    listed_conditions = in_codes(conditions, "condition_concept_id", codeset).select(
        "person_id",
        "site",
        F.col("condition_occurrence_id").alias("occurrence_id"),
        F.col("condition_concept_id").alias("concept_id"),
        F.col("condition_source_value").alias("source_value"),
        F.col("condition_concept_name").alias("concept_name"),
        F.lit("condition").alias("table_name"),
        F.lit("cond").alias("approach"),
        F.col("condition_start_date").alias("transplant_date"),
    )
    listed_procedures = in_codes(procedures, "procedure_concept_id", codeset).select(
        "person_id",
        "site",
        F.col("procedure_occurrence_id").alias("occurrence_id"),
        F.col("procedure_concept_id").alias("concept_id"),
        F.col("procedure_source_value").alias("source_value"),
        F.col("procedure_concept_name").alias("concept_name"),
        F.lit("procedure").alias("table_name"),
        F.lit("proc").alias("approach"),
        F.col("procedure_date").alias("transplant_date"),
    )
    # Joining birth dates after the union costs one join instead of two.
    events = listed_conditions.unionByName(listed_procedures).where(
        within("transplant_date", first_day, last_day)
    )
    return (
        _with_age_days(events, person, cohort, "transplant_date", "age_in_days")
        .where(F.col("age_in_days") < DAYS_PER_YEAR * age_bound_years)
        .drop("birth_date")
        .distinct()
    )


def biopsy_procedures(
    procedures: DataFrame,
    cohort: DataFrame,
    biopsy_codes: Codes,
    guidance_codes: Codes,
    *,
    evidence: Sequence[str] = KIDNEY_TEXT_OR_CODE,
    counter_evidence: Sequence[str] = NOT_KIDNEY_TEXT,
) -> DataFrame:
    """Kidney biopsies of the cohort.

    A biopsy code counts by itself; a guidance code counts if the source value
    shows ``evidence`` and no ``counter_evidence``.
    """
    coded = _coded_procedures(procedures, biopsy=biopsy_codes, guidance=guidance_codes)
    return (
        join_persons(coded.where(is_biopsy(evidence, counter_evidence)), cohort)
        .select(
            "person_id",
            F.col("procedure_occurrence_id").alias("occurrence_id"),
            F.col("procedure_concept_id").alias("concept_id"),
            F.col("procedure_concept_name").alias("concept_name"),
            F.col("procedure_date").alias("biopsy_date"),
            F.col("procedure_source_value").alias("source_value"),
            F.lit("procedure").alias("table_name"),
            F.lit("procedure").alias("approach"),
        )
        .distinct()
    )


def earliest_biopsy_and_transplant(
    procedures: DataFrame,
    biopsy_codes: Codes,
    guidance_codes: Codes,
    transplant_codes: Codes,
    *,
    age_bound_years: int = AGE_BOUND_YEARS,
    evidence: Sequence[str] = KIDNEY_TEXT_OR_CODE,
    counter_evidence: Sequence[str] = NOT_KIDNEY_TEXT,
) -> DataFrame:
    """Per person the first biopsy and the first transplant below the age, null if none.

    Both minima come from one pass over the procedures and one aggregation.
    """
    coded = _coded_procedures(
        procedures.where(F.col("procedure_age_in_months") < 12 * age_bound_years),
        biopsy=biopsy_codes,
        guidance=guidance_codes,
        transplant=transplant_codes,
    )
    date = F.col("procedure_date")
    return coded.groupBy("person_id").agg(
        F.min(F.when(is_biopsy(evidence, counter_evidence), date)).alias("min_biopsy_date"),
        F.min(F.when(F.col("transplant"), date)).alias("min_transplant_date"),
    )


def biopsy_by_literal_codes(
    procedures: DataFrame,
    cohort: DataFrame,
    biopsy_codes: Codes = KIDNEY_BIOPSY,
    guidance_codes: Codes = GUIDED_BIOPSY,
    *,
    evidence: Sequence[str] = KIDNEY_TEXT,
) -> DataFrame:
    """Cohort procedures with a biopsy code, or a guidance code and textual evidence.

    Unlike :func:`biopsy_procedures` there is no counter-evidence: "adrenal"
    contains "renal" and counts.
    """
    coded = _coded_procedures(procedures, biopsy=biopsy_codes, guidance=guidance_codes)
    return join_persons(coded.where(is_biopsy(evidence, ())), cohort).select(
        "procedure_occurrence_id",
        "person_id",
        "site",
        "procedure_date",
        "procedure_concept_id",
        "procedure_concept_name",
        "procedure_source_value",
    )


def is_biopsy(evidence: Sequence[str], counter_evidence: Sequence[str]):
    """Condition on procedures flagged ``biopsy`` and ``guidance``."""
    return F.col("biopsy") | (
        F.col("guidance") & mentions("procedure_source_value", evidence, counter_evidence)
    )


def _coded_procedures(procedures: DataFrame, **lists: Codes) -> DataFrame:
    """Procedures of any of the lists, with a boolean column per list."""
    return flagged(procedures, "procedure_concept_id", **lists)


def _with_age_days(
    rows: DataFrame, person: DataFrame, cohort: DataFrame | None, date: str, age: str
) -> DataFrame:
    births = person.select("person_id", "birth_date")
    if cohort is not None:
        births = own_shuffle(of_persons(births, cohort), "person_id")
    return rows.join(births, "person_id").select(
        *rows.columns, "birth_date", days_between("birth_date", date).alias(age)
    )
