"""Every operator and study step as a query on the commerce tables."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions import add_site, in_codes
from cohortry.operators import disease, events, lupus, membership, pairing, spacing, specialty
from cohortry.plans import TransplantStudy
from cohortry.plans.transplant_study import ATTRITION, STEPS, worth_keeping
from cohortry.session import configure
from cohortry.sources import Cdm, Workspace, codes_where, load_codeset
from cohortry.sources.schema import CDM_COLUMNS
from testkit import commerce
from testkit.commerce import PARAMETERS

Query = Callable[[SparkSession, str], DataFrame]

_WINDOW = {"first_day": PARAMETERS.first_day, "last_day": PARAMETERS.last_day}
_BIOPSY_TEXT = {
    "evidence": PARAMETERS.biopsy_evidence,
    "counter_evidence": PARAMETERS.biopsy_counter_evidence,
}

# Steps registered under the name of their operator.
_NOT_LISTED = {
    "sle_conditions",
    "sle_conditions_w_elig_visits",
    "coded_conditions",
    "coded_procedures",
    "specialty_visits",
    "sle_biopsies",
}

def queries() -> dict[str, Query]:
    return {
        **{name: _operator(name) for name in _OPERATORS},
        "codeset_load": codeset_load,
        "disease_code_flags": disease_code_flags,
        "result_round_trip": result_round_trip,
        **{name: _step(name) for name in STEPS if name not in _NOT_LISTED},
        "attrition": attrition,
    }


def _operator(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _OPERATORS[name](_study(spark, sf_dir, ()))

    return query


def _step(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _study(spark, sf_dir, worth_keeping(name)).table(name)

    return query


def attrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _study(spark, sf_dir, worth_keeping(*ATTRITION)).attrition()


def _study(spark: SparkSession, sf_dir: str, kept: Collection[str]) -> TransplantStudy:
    """The study on the commerce tables, storing the ``kept`` steps.

    Where both kinds of coded events are stored, both are joined to one stored table of visits.
    """
    configure(spark)
    workspace = Workspace(spark) if kept else None
    events = {"coded_conditions", "coded_procedures"} <= set(kept)
    return TransplantStudy(
        commerce.clinical_tables(spark, sf_dir, workspace if events else None),
        commerce.codes(spark, sf_dir),
        PARAMETERS,
        keep=workspace.keep if workspace else None,
        kept=kept,
    )


def codeset_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The disease list written as CSV and read back by the code list reader."""
    workspace = Workspace(spark)
    commerce.disease_list(spark, sf_dir).write.csv(
        f"{workspace.root}/disease.csv", header=True, quote='"', escape='"'
    )
    return load_codeset(spark, workspace.root, "disease", "icccicii")


def disease_code_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id lists a study takes from the disease list, one row per id and list."""
    codeset = commerce.disease_list(spark, sf_dir)
    picked = {
        "other_code_req": codes_where(codeset, "other_code_req"),
        "neph_req": codes_where(codeset, "neph_req"),
        "nephrotic": codes_where(codeset, "codeset_category_code", 1),
        "nephritic": codes_where(codeset, "codeset_category_code", 2),
    }
    tagged = [ids.select(F.lit(name).alias("flag"), "concept_id") for name, ids in picked.items()]
    return tagged[0].union(tagged[1]).union(tagged[2]).union(tagged[3])


def result_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result table written with a sort hint and read back."""
    workspace = Workspace(spark)
    visits = commerce.clinical_tables(spark, sf_dir).visit_occurrence
    workspace.write(visits, "visits", sort_by=["person_id", "visit_occurrence_id"])
    return workspace.read("visits")


def _read_from_folder(name: str) -> Callable[[TransplantStudy], DataFrame]:
    """A clinical table written to a folder and read as users read theirs."""

    def read(s: TransplantStudy) -> DataFrame:
        table = getattr(s.cdm, name)
        workspace = Workspace(table.sparkSession)
        workspace.write(table, name)
        return getattr(Cdm.from_folder(table.sparkSession, workspace.root), name)

    return read


# Cohorts the operators are shown on.


def _biopsied(s: TransplantStudy) -> DataFrame:
    """Persons with a biopsy code, once per biopsy."""
    return in_codes(s.cdm.procedure_occurrence, "procedure_concept_id", s.codes.biopsy)


def _sle_rows(s: TransplantStudy) -> DataFrame:
    return s.table("sle_conditions")


def _seen_sle_rows(s: TransplantStudy) -> DataFrame:
    return s.table("sle_conditions_w_elig_visits")


def _pair_list(s: TransplantStudy) -> DataFrame:
    """Kidney-related and lupus codes, each marked with 0/1."""
    kidney = s.codes.disease.select("concept_id", F.lit(1).alias("kidney_related"))
    sle = s.codes.sle_included.select("concept_id", F.lit(1).alias("sle"))
    return kidney.join(sle, "concept_id", "full").fillna(0)


def _nephritis_rows(s: TransplantStudy) -> DataFrame:
    return pairing.same_date_pair_for_cohort(
        _seen_sle_rows(s), s.cdm.condition_occurrence, _pair_list(s)
    )


_OPERATORS: dict[str, Callable[[TransplantStudy], DataFrame]] = {
    **{f"cdm_{name}": _read_from_folder(name) for name in CDM_COLUMNS},
    "add_site": lambda s: add_site(_biopsied(s), s.cdm.person),
    "spaced_specialty_visits": lambda s: spacing.spaced_specialty_visits(
        s.cdm.visit_occurrence,
        s.cdm.provider,
        s.cdm.care_site,
        s.codes.rheumatology_nephrology,
        s.codes.in_person_expanded,
        min_visits=4,
        gap_days=30,
        **_WINDOW,
    ),
    "specialty_events": lambda s: specialty.specialty_events(
        s.cdm.visit_occurrence, s.cdm.provider, s.cdm.care_site, s.codes.nephrology
    ),
    "procedures_in_codeset": lambda s: events.procedures_in_codeset(
        s.cdm.procedure_occurrence, s.cdm.person, s.codes.transplant_procedures, _biopsied(s)
    ),
    "conditions_in_codeset": lambda s: events.conditions_in_codeset(
        s.cdm.condition_occurrence, s.cdm.person, s.codes.transplant_broad
    ),
    "disease_cohort": lambda s: disease.disease_cohort(
        s.cdm,
        s.codes.disease,
        s.codes.biopsy,
        s.codes.biopsy_guidance,
        s.codes.transplant_procedures,
        s.codes.rheumatology_nephrology,
        other_code_required=codes_where(s.codes.disease, "other_code_req"),
        nephrology_required=codes_where(s.codes.disease, "neph_req"),
        age_bound_years=25,
        **_WINDOW,
        **_BIOPSY_TEXT,
    ),
    "biopsy_before_transplant": lambda s: disease.biopsy_before_transplant(
        s.cdm.person.select("person_id", "site"),
        s.cdm.procedure_occurrence,
        s.codes.biopsy,
        s.codes.biopsy_guidance,
        s.codes.transplant_procedures,
        **_BIOPSY_TEXT,
    ),
    "biopsy_procedures": lambda s: events.biopsy_procedures(
        s.cdm.procedure_occurrence, _sle_rows(s), s.codes.biopsy, s.codes.biopsy_guidance,
        **_BIOPSY_TEXT,
    ),
    "transplant_events": lambda s: events.transplant_events(
        s.cdm.condition_occurrence,
        s.cdm.procedure_occurrence,
        s.cdm.person,
        _biopsied(s),
        s.codes.transplant_broad,
        **_WINDOW,
    ),
    "dominant_category_subcohort": lambda s: disease.dominant_category_subcohort(
        _biopsied(s),
        s.cdm.condition_occurrence,
        codes_where(s.codes.disease, "codeset_category_code", 1),
        codes_where(s.codes.disease, "codeset_category_code", 2),
    ),
    "incl_excl_conditions": _sle_rows,
    "visits_with_specialty": lambda s: specialty.visits_with_specialty(
        s.cdm.visit_occurrence, _sle_rows(s), s.cdm.provider, s.cdm.care_site
    ),
    "visit_table_specialty": lambda s: specialty.visit_table_specialty(
        s.cdm.visit_occurrence, _biopsied(s), s.cdm.provider, s.cdm.care_site
    ),
    "eligible_visits": lambda s: specialty.eligible_visits(
        s.cdm.visit_occurrence,
        _sle_rows(s),
        s.cdm.provider,
        s.cdm.care_site,
        s.codes.rheumatology_nephrology,
        s.codes.in_person,
    ),
    "conditions_with_eligible_visits": _seen_sle_rows,
    "two_codes_spread": lambda s: spacing.two_codes_spread(_seen_sle_rows(s)),
    "three_codes_spaced": lambda s: spacing.three_codes_spaced(
        _seen_sle_rows(s)
    ),
    "biopsy_by_literal_codes": lambda s: events.biopsy_by_literal_codes(
        s.cdm.procedure_occurrence,
        _seen_sle_rows(s),
        s.codes.sle_biopsy,
        s.codes.sle_biopsy_guidance,
        evidence=PARAMETERS.sle_biopsy_evidence,
    ),
    "same_date_pair": lambda s: pairing.same_date_pair(
        s.cdm.condition_occurrence, _pair_list(s)
    ),
    "same_date_pair_for_cohort": _nephritis_rows,
    "persons_with_any_code": lambda s: membership.persons_with_any_code(
        _biopsied(s), s.cdm.condition_occurrence, s.cdm.person, s.codes.disease
    ),
    "population_eligible_visits": lambda s: specialty.population_eligible_visits(
        s.cdm.visit_occurrence,
        s.cdm.provider,
        s.cdm.care_site,
        s.codes.rheumatology_nephrology,
        s.codes.in_person,
    ),
    "followup_at_least": lambda s: spacing.followup_at_least(
        s.cdm.visit_occurrence, _biopsied(s)
    ),
    "persons_exposed_to_drug": lambda s: membership.persons_exposed_to_drug(
        _sle_rows(s), s.cdm.drug_exposure, s.codes.sle_drugs
    ),
    "sle_cohort_no_biopsy": lambda s: lupus.sle_cohort_no_biopsy(
        s.cdm, _seen_sle_rows(s), s.codes.sle_drugs
    ),
    "ln_cohort": lambda s: lupus.ln_cohort(
        s.cdm,
        _nephritis_rows(s),
        membership.persons_with_any_code(
            _seen_sle_rows(s), s.cdm.condition_occurrence, s.cdm.person, s.codes.sle_included
        ),
        s.codes.sle_drugs,
        biopsy_codes=s.codes.sle_biopsy,
        guidance_codes=s.codes.sle_biopsy_guidance,
        evidence=PARAMETERS.sle_biopsy_evidence,
    ),
    "ln_cohort_no_biopsy": lambda s: lupus.ln_cohort_no_biopsy(
        s.cdm, _nephritis_rows(s), s.codes.sle_drugs
    ),
}
