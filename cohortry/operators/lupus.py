"""Lupus and lupus nephritis cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cohortry.defaults import GUIDED_BIOPSY, KIDNEY_BIOPSY, KIDNEY_TEXT
from cohortry.functions import Codes, add_site
from cohortry.operators.events import biopsy_by_literal_codes
from cohortry.operators.membership import persons_exposed_to_drug
from cohortry.operators.spacing import followup_at_least, three_codes_spaced
from cohortry.sources import Cdm


def sle_cohort(
    cdm: Cdm,
    sle_conditions: DataFrame,
    drug_codes: Codes,
    *,
    biopsy_codes: Codes = KIDNEY_BIOPSY,
    guidance_codes: Codes = GUIDED_BIOPSY,
    evidence: Sequence[str] = KIDNEY_TEXT,
    gap_days: int = 30,
    followup_days: int = 60,
    biopsies: DataFrame | None = None,
) -> DataFrame:
    """Persons, with site, who took a listed drug and meet one of two rules.

    Either three lupus codes spaced by ``gap_days``, or any lupus code, a kidney
    biopsy and ``followup_days`` between first and last visit. Follow-up is asked
    for in the second case only.
    """
    return ln_cohort(
        cdm,
        sle_conditions,
        sle_conditions,
        drug_codes,
        biopsy_codes=biopsy_codes,
        guidance_codes=guidance_codes,
        evidence=evidence,
        gap_days=gap_days,
        followup_days=followup_days,
        biopsies=biopsies,
    )


def sle_cohort_no_biopsy(
    cdm: Cdm, sle_conditions: DataFrame, drug_codes: Codes, *, gap_days: int = 30
) -> DataFrame:
    """Persons, with site, who took a listed drug and have three spaced lupus codes."""
    spaced = three_codes_spaced(sle_conditions, gap_days=gap_days)
    return add_site(persons_exposed_to_drug(spaced, cdm.drug_exposure, drug_codes), cdm.person)


def ln_cohort(
    cdm: Cdm,
    nephritis_conditions: DataFrame,
    sle_persons: DataFrame,
    drug_codes: Codes,
    *,
    biopsy_codes: Codes = KIDNEY_BIOPSY,
    guidance_codes: Codes = GUIDED_BIOPSY,
    evidence: Sequence[str] = KIDNEY_TEXT,
    gap_days: int = 30,
    followup_days: int = 60,
    biopsies: DataFrame | None = None,
) -> DataFrame:
    """As :func:`sle_cohort`, with the persons of the biopsy rule given separately.

    ``biopsies``, if given, are those of ``sle_persons``, found before. Stored, their size is known when
    the visits of their persons are picked.
    """
    spaced = three_codes_spaced(nephritis_conditions, gap_days=gap_days)
    if biopsies is None:
        biopsies = biopsy_by_literal_codes(
            cdm.procedure_occurrence, sle_persons, biopsy_codes, guidance_codes, evidence=evidence
        )
    followed = followup_at_least(cdm.visit_occurrence, biopsies, min_days=followup_days)
    either = spaced.select("person_id").union(followed.select("person_id"))
    return add_site(persons_exposed_to_drug(either, cdm.drug_exposure, drug_codes), cdm.person)


def ln_cohort_no_biopsy(
    cdm: Cdm, nephritis_conditions: DataFrame, drug_codes: Codes, *, gap_days: int = 30
) -> DataFrame:
    """As :func:`sle_cohort_no_biopsy`, on lupus nephritis conditions."""
    return sle_cohort_no_biopsy(cdm, nephritis_conditions, drug_codes, gap_days=gap_days)
