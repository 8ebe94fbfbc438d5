"""Inclusion, exclusion and exposure."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortry.functions import Codes, add_site, in_any_codes, in_codes, marks, of_persons, without_persons
from cohortry.operators.specialty import persons_with_eligible_visits
from cohortry.sources.results import Keep, keep_aside

CONDITION_ROW = [
    "condition_occurrence_id",
    "person_id",
    "site",
    "visit_occurrence_id",
    "condition_concept_id",
    "condition_concept_name",
    "condition_type_concept_id",
    "condition_start_date",
    "condition_source_value",
]


def incl_excl_conditions(
    conditions: DataFrame, included: Codes, excluded: Codes, *, keep: Keep | None = keep_aside
) -> DataFrame:
    """Distinct rows of included conditions, for persons with no excluded one ever.

    Rows of either list are found in one pass and stored by ``keep``. Without it, as for conditions
    that are stored and few already, these are read twice.
    """
    if keep:
        listed = in_any_codes(conditions, condition_concept_id=[included, excluded])
        conditions = keep(listed.select(*CONDITION_ROW, *marks(included, excluded)), "listed_conditions")
    rows = in_codes(conditions, "condition_concept_id", included).select(*CONDITION_ROW)
    barred = in_codes(conditions, "condition_concept_id", excluded)
    return without_persons(rows, barred).distinct()


def conditions_with_eligible_visits(
    conditions: DataFrame,
    visits: DataFrame,
    provider: DataFrame,
    care_site: DataFrame,
    specialties: Codes,
    visit_types: Codes,
    *,
    min_visits: int = 2,
) -> DataFrame:
    """Distinct condition rows of persons with enough visits of a listed type and specialty.

    Only visits of the rows' persons are looked up, so the rows are read twice.
    """
    theirs = of_persons(visits, conditions)
    persons = persons_with_eligible_visits(
        theirs, provider, care_site, specialties, visit_types, min_visits=min_visits
    )
    return of_persons(conditions.select(*CONDITION_ROW), persons).distinct()


def persons_with_any_code(
    cohort: DataFrame, conditions: DataFrame, person: DataFrame, codeset: Codes
) -> DataFrame:
    """Cohort persons with any listed condition, and their site."""
    found = in_codes(conditions, "condition_concept_id", codeset).select("person_id").distinct()
    return add_site(of_persons(found, cohort), person)


def persons_exposed_to_drug(cohort: DataFrame, drugs: DataFrame, drug_codes: Codes) -> DataFrame:
    """Cohort persons with any exposure to a listed drug."""
    exposed = in_codes(drugs, "drug_concept_id", drug_codes).select("person_id").distinct()
    return of_persons(exposed, cohort)


def cohort_of(rows: DataFrame) -> DataFrame:
    """The persons, with site, of any rows that carry both."""
    return rows.select("person_id", "site").distinct()
