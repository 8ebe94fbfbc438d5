"""The disease cohort and its sub-cohort by dominant diagnosis category."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.defaults import (
    AGE_BOUND_YEARS,
    KIDNEY_TEXT_OR_CODE,
    NEPHROLOGY_REQUIRED,
    NOT_KIDNEY_TEXT,
    OTHER_CODE_REQUIRED,
    WINDOW_END,
    WINDOW_START,
)
from cohortry.functions import Codes, flagged, of_persons, own_shuffle, within
from cohortry.operators.events import earliest_biopsy_and_transplant
from cohortry.operators.specialty import at_specialty
from cohortry.sources import Cdm


def disease_cohort(
    cdm: Cdm,
    disease_codes: Codes,
    biopsy_codes: Codes,
    guidance_codes: Codes,
    transplant_codes: Codes,
    nephrology_specialties: Codes,
    *,
    other_code_required: Codes = OTHER_CODE_REQUIRED,
    nephrology_required: Codes = NEPHROLOGY_REQUIRED,
    age_bound_years: int = AGE_BOUND_YEARS,
    first_day: dt.date = WINDOW_START,
    last_day: dt.date = WINDOW_END,
    evidence: Sequence[str] = KIDNEY_TEXT_OR_CODE,
    counter_evidence: Sequence[str] = NOT_KIDNEY_TEXT,
) -> DataFrame:
    """Persons with the disease, per site, and how they entered.

    Diagnoses count if listed, made below the age and in the window; those in
    ``nephrology_required`` only at a visit with a listed specialty. A person enters

    - as "two_codes" with diagnoses on two dates, unless all distinct codes are in
      ``other_code_required`` (the dates of the other code do not matter);
    - otherwise as "one_code_w_biopsy" with one diagnosis and a first biopsy that
      lies in the window and before any transplant. A person refused by the first
      rule can enter by this one. Only the very first biopsy is looked at, and two
      of the three diagnosis counts are null for these rows.

    One pass over procedures and visits: the two ways in, and the refusal, are decided
    from a single summary row per person and site. Conditions are read a second time
    for the few that name a visit to look up.
    """
    summary = _diagnosis_summary(
        cdm,
        disease_codes,
        nephrology_specialties,
        other_code_required,
        nephrology_required,
        age_bound_years,
        first_day,
        last_day,
    )
    firsts = earliest_biopsy_and_transplant(
        cdm.procedure_occurrence,
        biopsy_codes,
        guidance_codes,
        transplant_codes,
        age_bound_years=age_bound_years,
        evidence=evidence,
        counter_evidence=counter_evidence,
    )

    # A person has one summary row per site, so these groups are as small as the
    # number of sites. Refusal compares counts across a person's sites.
    person = Window.partitionBy("person_id")
    two_dates = F.col("n_glomerular_dx_dates") >= 2
    restricted = F.col("n_other_code_req")
    refused = F.arrays_overlap(
        F.collect_set(F.when(restricted > 0, restricted)).over(person),
        F.collect_set(F.when(two_dates, F.col("n_distinct_glomerular_dx"))).over(person),
    )
    entered_by_codes = (F.col("_has_two_dates")) & ~F.col("_refused")
    by_biopsy = _biopsy_before_transplant() & within("min_biopsy_date", first_day, last_day)
    by_codes = F.col("entry") == "two_codes"
    return (
        summary.select(
            "*",
            F.max(two_dates).over(person).alias("_has_two_dates"),
            refused.alias("_refused"),
        )
        .join(firsts, "person_id", "left")
        .withColumn(
            "entry",
            F.when(entered_by_codes & two_dates, "two_codes").when(
                ~entered_by_codes & by_biopsy, "one_code_w_biopsy"
            ),
        )
        .where(F.col("entry").isNotNull())
        .select(
            "person_id",
            "site",
            "entry",
            F.when(by_codes, F.col("n_glomerular_dx")).alias("n_glomerular_dx"),
            F.when(by_codes, F.col("n_distinct_glomerular_dx")).alias("n_distinct_glomerular_dx"),
            "n_glomerular_dx_dates",
        )
    )


def biopsy_before_transplant(
    cohort: DataFrame,
    procedures: DataFrame,
    biopsy_codes: Codes,
    guidance_codes: Codes,
    transplant_codes: Codes,
    *,
    age_bound_years: int = AGE_BOUND_YEARS,
    evidence: Sequence[str] = KIDNEY_TEXT_OR_CODE,
    counter_evidence: Sequence[str] = NOT_KIDNEY_TEXT,
) -> DataFrame:
    """Distinct cohort rows of persons whose first biopsy precedes any transplant.

    Adds ``min_biopsy_date`` and ``min_transplant_date`` (null without transplant).
    """
    firsts = earliest_biopsy_and_transplant(
        procedures,
        biopsy_codes,
        guidance_codes,
        transplant_codes,
        age_bound_years=age_bound_years,
        evidence=evidence,
        counter_evidence=counter_evidence,
    ).where(_biopsy_before_transplant())
    return (
        cohort.distinct()
        .join(firsts, "person_id")
        .select(*cohort.columns, "min_biopsy_date", "min_transplant_date")
    )


def dominant_category_subcohort(
    cohort: DataFrame, conditions: DataFrame, nephrotic_codes: Codes, nephritic_codes: Codes
) -> DataFrame:
    """Cohort persons with more distinct nephrotic than nephritic diagnosis dates.

    Counts all dates on record: no window, no age. A code may be in both lists.
    """
    dated = conditions.where(F.col("condition_start_date").isNotNull())
    counts = (
        flagged(dated, "condition_concept_id", nephrotic=nephrotic_codes, nephritic=nephritic_codes)
        .groupBy("person_id", "condition_start_date")
        .agg(F.max("nephrotic").alias("nephrotic"), F.max("nephritic").alias("nephritic"))
        .groupBy("person_id")
        .agg(
            F.count_if("nephrotic").alias("n_nephrotic_dx"),
            F.count_if("nephritic").alias("n_nephritic_dx"),
        )
        .where(F.col("n_nephrotic_dx") > F.col("n_nephritic_dx"))
    )
    return of_persons(counts, cohort)


def _biopsy_before_transplant() -> Column:
    biopsy, transplant = F.col("min_biopsy_date"), F.col("min_transplant_date")
    return biopsy.isNotNull() & (transplant.isNull() | (biopsy < transplant))


def _diagnosis_summary(
    cdm: Cdm,
    disease_codes: Codes,
    nephrology_specialties: Codes,
    other_code_required: Codes,
    nephrology_required: Codes,
    age_bound_years: int,
    first_day: dt.date,
    last_day: dt.date,
) -> DataFrame:
    """Distinct dates, occurrences and codes of counting diagnoses per person and site."""
    counting = cdm.condition_occurrence.where(
        (F.col("condition_start_age_in_months") < 12 * age_bound_years)
        & within("condition_start_date", first_day, last_day)
    )
    diagnoses = (
        flagged(
            counting,
            "condition_concept_id",
            listed=disease_codes,
            other_code_req=other_code_required,
            neph_req=nephrology_required,
        )
        .where("listed")
        .select(
            "person_id",
            "site",
            "visit_occurrence_id",
            "condition_occurrence_id",
            "condition_concept_id",
            "condition_start_date",
            "other_code_req",
            "neph_req",
        )
    )
    # Only diagnoses that need a visit carry its id into the join, and only their visits are looked
    # up. The others go by person; they can't meet a visit, as ``_gated`` differs.
    gate = F.when(F.col("neph_req"), F.col("visit_occurrence_id")).otherwise(F.col("person_id"))
    gated_visits = (
        diagnoses.where("neph_req AND visit_occurrence_id IS NOT NULL")
        .select("visit_occurrence_id")
        .distinct()
    )
    nephrology_visits = at_specialty(
        cdm.visit_occurrence.select("visit_occurrence_id", "provider_id", "care_site_id").join(
            own_shuffle(gated_visits, "visit_occurrence_id"), "visit_occurrence_id", "left_semi"
        ),
        cdm.provider,
        cdm.care_site,
        nephrology_specialties,
    ).select(F.col("visit_occurrence_id").alias("_visit"), F.lit(True).alias("_gated"))
    at_nephrology = (F.col("_gate") == F.col("_visit")) & (F.col("neph_req") == F.col("_gated"))
    return (
        diagnoses.withColumn("_gate", gate)
        .join(nephrology_visits, at_nephrology, "left")
        .where(~F.col("neph_req") | F.col("_gated"))
        .groupBy("person_id", "site")
        .agg(
            F.countDistinct("condition_start_date").alias("n_glomerular_dx_dates"),
            F.countDistinct("condition_occurrence_id").alias("n_glomerular_dx"),
            F.countDistinct("condition_concept_id").alias("n_distinct_glomerular_dx"),
            F.countDistinct(F.when(F.col("other_code_req"), F.col("condition_concept_id"))).alias(
                "n_other_code_req"
            ),
        )
    )
