"""Nephrotic syndrome patients with a kidney transplant who do not have lupus."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections import Counter
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cohortry import defaults
from cohortry.functions import (
    Codes,
    Marked,
    in_any_codes,
    in_codes,
    mark_codes,
    of_persons,
    within,
    without_persons,
)
from cohortry.operators.attrition import attrition, counted
from cohortry.operators.disease import disease_cohort, dominant_category_subcohort
from cohortry.operators.events import biopsy_by_literal_codes, transplant_events
from cohortry.operators.lupus import sle_cohort
from cohortry.operators.membership import (
    cohort_of,
    conditions_with_eligible_visits,
    incl_excl_conditions,
)
from cohortry.operators.spacing import spaced_visits
from cohortry.operators.specialty import at_specialty
from cohortry.sources import Cdm, ResultStore, TableStore, Workspace, codes_where, load_codeset
from cohortry.sources.lazy import OpenedOnUse
from cohortry.sources.results import Keep, keep_aside


class StudyCodes(OpenedOnUse[Codes]):
    """The code lists of the study; ``disease`` carries category and rule columns."""

    nephrology: Codes
    rheumatology_nephrology: Codes
    in_person: Codes
    in_person_expanded: Codes
    disease: DataFrame
    biopsy: Codes
    biopsy_guidance: Codes
    transplant_procedures: Codes
    transplant_broad: Codes
    sle_included: Codes
    sle_excluded: Codes
    sle_drugs: Codes
    transplant_source: Codes
    sle_biopsy: Codes
    sle_biopsy_guidance: Codes

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str) -> StudyCodes:
        """Read the lists from CSV files of their customary names."""

        def open_list(name: str) -> Codes:
            if name in LITERAL_LISTS:
                return LITERAL_LISTS[name]
            file, col_types = LIST_FILES[name]
            return load_codeset(spark, folder, file, col_types)

        return cls(open_list)


# File name and column types of each code list.
LIST_FILES: dict[str, tuple[str, str | None]] = {
    "nephrology": ("nephrology_specialty", None),
    "rheumatology_nephrology": ("codeset_rheum_nephr_spec", None),
    "in_person": ("in_person", None),
    "in_person_expanded": ("in_person_exp", None),
    "disease": ("glomerular_disease", "icccicii"),
    "biopsy": ("kidney_biopsy_proc", None),
    "biopsy_guidance": ("biopsy_proc", None),
    "transplant_procedures": ("kidney_transplant_proc", None),
    "transplant_broad": ("kidney_transplant_broad", "icccc"),
    "sle_included": ("codeset_sle_incl", None),
    "sle_excluded": ("codeset_sle_excl", None),
    "sle_drugs": ("codeset_hydroxychloroquine", None),
}

# Lists the study states as literal concept ids.
LITERAL_LISTS: dict[str, Codes] = {
    "transplant_source": defaults.TRANSPLANT_SOURCE_CONCEPTS,
    "sle_biopsy": defaults.KIDNEY_BIOPSY,
    "sle_biopsy_guidance": defaults.GUIDED_BIOPSY,
}


@dataclass(frozen=True)
class StudyParameters:
    """Dates, ages, spacings and text patterns of the study."""

    first_day: dt.date = defaults.WINDOW_START
    last_day: dt.date = defaults.WINDOW_END
    age_bound_years: int = defaults.AGE_BOUND_YEARS
    min_visits: int = 3
    visit_gap_days: int = 7
    min_specialty_visits: int = 2
    code_gap_days: int = 30
    followup_days: int = 60
    biopsy_evidence: Sequence[str] = defaults.KIDNEY_TEXT_OR_CODE
    biopsy_counter_evidence: Sequence[str] = defaults.NOT_KIDNEY_TEXT
    sle_biopsy_evidence: Sequence[str] = defaults.KIDNEY_TEXT


_log = logging.getLogger(__name__)

Keep = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Step:
    """A step of the study and the steps it builds on.

    ``build`` receives the study and the tables of ``inputs``, and reads each of
    these once, or as often as ``passes`` says. A step that is ``cheap`` to derive is never stored; one that is
    ``decisive`` always is, as large tables are joined by what it turns out to be.
    """

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    passes: Mapping[str, int] = field(default_factory=dict)
    cheap: bool = False
    decisive: bool = False


class TransplantStudy:
    """The steps of the study, each a lazy DataFrame built on first use.

    Steps named in ``kept`` are passed through ``keep``, which may write them to
    storage and return the stored table. Without ``keep`` every step stays lazy.
    """

    def __init__(
        self,
        cdm: Cdm,
        codes: StudyCodes,
        parameters: StudyParameters = StudyParameters(),
        keep: Keep | None = None,
        kept: Collection[str] = (),
    ) -> None:
        self.cdm = cdm
        self.codes = codes
        self.parameters = parameters
        self._keep = keep
        self._kept = kept if keep else ()
        self._tables: dict[str, DataFrame] = {}

    def plan(self, name: str) -> DataFrame:
        """The lazy definition of a step, on its inputs as they are kept."""
        step = STEPS[name]
        return step.build(self, *(self.table(i) for i in step.inputs))

    def table(self, name: str) -> DataFrame:
        """A step, built once, and kept if it is to be."""
        if name not in self._tables:
            df = self.plan(name)
            self._tables[name] = self._keep(df, name) if name in self._kept else df
        return self._tables[name]

    def storing(self, name: str) -> Keep | None:
        """How an operator on a step stores rows that it reads twice: not at all if the step is kept."""
        return None if name in self._kept else keep_aside

    def listed(self, name: str, *steps: str) -> Codes:
        """A list to pick from coded steps by: the mark their rows carry if all of them are kept."""
        return Marked(_mark(name)) if all(step in self._kept for step in steps) else CODED_BY[name](self.codes)

    def attrition(self) -> DataFrame:
        """Persons left after each step, in one aggregation."""
        return attrition({name: self.table(name) for name in ATTRITION})


def worth_keeping(*wanted: str) -> frozenset[str]:
    """Steps read more than once, and not cheap, when the wanted steps are computed.

    Reading a cheap step means reading its inputs. Decisive steps are kept if read at all, and so are
    their inputs if something else reads these too.
    """
    reads = Counter(wanted)
    for name in reversed(STEPS):  # every step comes after its inputs
        step = STEPS[name]
        times = reads[name] if step.cheap else min(reads[name], 1)
        for i in step.inputs:
            reads[i] += times * step.passes.get(i, 1)
    return frozenset(
        n for n, step in STEPS.items() if not step.cheap and reads[n] > (0 if step.decisive else 1)
    )


def _mark(name: str) -> str:
    return f"_in_{name}"


#: The lists that coded rows are picked by.
CODED_BY: dict[str, Callable[[StudyCodes], Codes]] = {
    "disease": lambda c: c.disease,
    "other_code_required": lambda c: codes_where(c.disease, "other_code_req"),
    "nephrology_required": lambda c: codes_where(c.disease, "neph_req"),
    "nephrotic": lambda c: codes_where(c.disease, "codeset_category_code", 1),
    "nephritic": lambda c: codes_where(c.disease, "codeset_category_code", 2),
    "transplant_broad": lambda c: c.transplant_broad,
    "transplant_source": lambda c: c.transplant_source,
    "sle_included": lambda c: c.sle_included,
    "sle_excluded": lambda c: c.sle_excluded,
    "biopsy": lambda c: c.biopsy,
    "biopsy_guidance": lambda c: c.biopsy_guidance,
    "transplant_procedures": lambda c: c.transplant_procedures,
    "sle_biopsy": lambda c: c.sle_biopsy,
    "sle_biopsy_guidance": lambda c: c.sle_biopsy_guidance,
}


def _coded(s: TransplantStudy, step: str, rows: DataFrame, **lists: Sequence[str]) -> DataFrame:
    """Rows of any of the lists; where they are stored, with a mark per list."""
    named = {column: {_mark(n): CODED_BY[n](s.codes) for n in names} for column, names in lists.items()}
    if step in s._kept:
        return mark_codes(rows, **named)
    return in_any_codes(rows, **{column: list(codes.values()) for column, codes in named.items()})


def _coded_conditions(s: TransplantStudy) -> DataFrame:
    """Conditions of any list. All rules on conditions look at listed ones only."""
    of_disease = ["disease", "other_code_required", "nephrology_required", "nephrotic", "nephritic"]
    return _coded(
        s,
        "coded_conditions",
        s.cdm.condition_occurrence,
        condition_concept_id=[*of_disease, "transplant_broad", "sle_included", "sle_excluded"],
        condition_source_concept_id=["transplant_source"],
    )


def _coded_procedures(s: TransplantStudy) -> DataFrame:
    """Procedures of any list."""
    lists = ["biopsy", "biopsy_guidance", "transplant_procedures", "transplant_broad"]
    return _coded(
        s,
        "coded_procedures",
        s.cdm.procedure_occurrence,
        procedure_concept_id=[*lists, "sle_biopsy", "sle_biopsy_guidance"],
    )


def _specialty_visits(s: TransplantStudy) -> DataFrame:
    """Visits in the window, at nephrology, of a type of either list."""
    p = s.parameters
    typed = in_any_codes(
        s.cdm.visit_occurrence.where(within("visit_start_date", p.first_day, p.last_day)),
        visit_concept_id=[s.codes.in_person, s.codes.in_person_expanded],
    )
    return at_specialty(typed, s.cdm.provider, s.cdm.care_site, s.codes.nephrology)


def _nephrology_visits(s: TransplantStudy, visits: DataFrame, visit_types: Codes) -> DataFrame:
    p = s.parameters
    typed = in_codes(visits, "visit_concept_id", visit_types)
    return spaced_visits(typed, min_visits=p.min_visits, gap_days=p.visit_gap_days)


def _glomerular_disease_cohort(
    s: TransplantStudy, conditions: DataFrame, procedures: DataFrame
) -> DataFrame:
    p = s.parameters
    return disease_cohort(
        s.cdm.replacing(condition_occurrence=conditions, procedure_occurrence=procedures),
        s.listed("disease", "coded_conditions"),
        s.listed("biopsy", "coded_procedures"),
        s.listed("biopsy_guidance", "coded_procedures"),
        s.listed("transplant_procedures", "coded_procedures"),
        s.codes.nephrology,
        other_code_required=s.listed("other_code_required", "coded_conditions"),
        nephrology_required=s.listed("nephrology_required", "coded_conditions"),
        age_bound_years=p.age_bound_years,
        first_day=p.first_day,
        last_day=p.last_day,
        evidence=p.biopsy_evidence,
        counter_evidence=p.biopsy_counter_evidence,
    )


def _nephrotic_subcohort(
    s: TransplantStudy, cohort: DataFrame, conditions: DataFrame
) -> DataFrame:
    return dominant_category_subcohort(
        cohort,
        conditions,
        s.listed("nephrotic", "coded_conditions"),
        s.listed("nephritic", "coded_conditions"),
    )


def _nephrotic_kt(
    s: TransplantStudy, cohort: DataFrame, conditions: DataFrame, procedures: DataFrame
) -> DataFrame:
    p = s.parameters
    return transplant_events(
        conditions,
        procedures,
        s.cdm.person,
        cohort,
        s.listed("transplant_broad", "coded_conditions", "coded_procedures"),
        age_bound_years=p.age_bound_years,
        first_day=p.first_day,
        last_day=p.last_day,
    )


def _nephrotic_kt_src(s: TransplantStudy, cohort: DataFrame, conditions: DataFrame) -> DataFrame:
    source = s.listed("transplant_source", "coded_conditions")
    rows = in_codes(conditions, "condition_source_concept_id", source)
    return of_persons(rows.select(*s.cdm.condition_occurrence.columns), cohort)  # without marks


def _sle_conditions(s: TransplantStudy, conditions: DataFrame) -> DataFrame:
    return incl_excl_conditions(
        conditions,
        s.listed("sle_included", "coded_conditions"),
        s.listed("sle_excluded", "coded_conditions"),
        keep=s.storing("coded_conditions"),
    )


def _sle_conditions_w_elig_visits(s: TransplantStudy, conditions: DataFrame) -> DataFrame:
    return conditions_with_eligible_visits(
        conditions,
        s.cdm.visit_occurrence,
        s.cdm.provider,
        s.cdm.care_site,
        s.codes.rheumatology_nephrology,
        s.codes.in_person,
        min_visits=s.parameters.min_specialty_visits,
    )


def _sle_biopsies(s: TransplantStudy, conditions: DataFrame, procedures: DataFrame) -> DataFrame:
    return biopsy_by_literal_codes(
        procedures,
        conditions,
        s.listed("sle_biopsy", "coded_procedures"),
        s.listed("sle_biopsy_guidance", "coded_procedures"),
        evidence=s.parameters.sle_biopsy_evidence,
    )


def _sle_cohort(s: TransplantStudy, conditions: DataFrame, biopsies: DataFrame) -> DataFrame:
    p = s.parameters
    return sle_cohort(
        s.cdm,
        conditions,
        s.codes.sle_drugs,
        biopsies=biopsies,
        gap_days=p.code_gap_days,
        followup_days=p.followup_days,
    )


def _final_cohort(
    s: TransplantStudy, coded: DataFrame, source_coded: DataFrame, seen: DataFrame
) -> DataFrame:
    return of_persons(coded.union(source_coded).distinct(), seen)


def _cohort_of(rows: str, cheap: bool = True) -> Step:
    return Step((rows,), lambda s, rows: cohort_of(rows), cheap=cheap)


def _seen_by_nephrology(cohort: str) -> Step:
    inputs = (cohort, "nephrology_visit_cohort")
    return Step(inputs, lambda s, cohort, seen: of_persons(cohort, seen))


def _without_sle(cohort: str) -> Step:
    inputs = (cohort, "sle_cohort")
    return Step(inputs, lambda s, cohort, sle: without_persons(cohort, sle))


# Names of the steps whose rows are results.
STEPS: dict[str, Step] = {
    "coded_conditions": Step((), _coded_conditions),
    "coded_procedures": Step((), _coded_procedures),
    "specialty_visits": Step((), _specialty_visits),
    "nephrology_visits": Step(
        ("specialty_visits",),
        lambda s, v: _nephrology_visits(s, v, s.codes.in_person),
        passes={"specialty_visits": 2},
    ),
    "nephrology_visit_cohort": _cohort_of("nephrology_visits", cheap=False),
    "nephrology_visits_exp": Step(
        ("specialty_visits",),
        lambda s, v: _nephrology_visits(s, v, s.codes.in_person_expanded),
        passes={"specialty_visits": 2},
    ),
    "nephrology_visit_cohort_exp": _cohort_of("nephrology_visits_exp", cheap=False),
    "glomerular_disease_cohort": Step(
        ("coded_conditions", "coded_procedures"),
        _glomerular_disease_cohort,
        passes={"coded_conditions": 2},
    ),
    "glomerular_disease_cohort_w_neph": _seen_by_nephrology("glomerular_disease_cohort"),
    "nephrotic_subcohort": Step(
        ("glomerular_disease_cohort", "coded_conditions"), _nephrotic_subcohort
    ),
    "nephrotic_subcohort_w_neph": _seen_by_nephrology("nephrotic_subcohort"),
    "nephrotic_kt": Step(
        ("nephrotic_subcohort", "coded_conditions", "coded_procedures"), _nephrotic_kt
    ),
    "nephrotic_kt_cohort": _cohort_of("nephrotic_kt"),
    "nephrotic_kt_cohort_w_neph": _seen_by_nephrology("nephrotic_kt_cohort"),
    "nephrotic_kt_src": Step(("nephrotic_subcohort", "coded_conditions"), _nephrotic_kt_src),
    "nephrotic_kt_src_cohort": _cohort_of("nephrotic_kt_src"),
    "nephrotic_kt_src_cohort_w_neph": _seen_by_nephrology("nephrotic_kt_src_cohort"),
    "sle_conditions": Step(
        ("coded_conditions",), _sle_conditions, passes={"coded_conditions": 2}
    ),
    "sle_i_e_pats": _cohort_of("sle_conditions"),
    "sle_conditions_w_elig_visits": Step(
        ("sle_conditions",), _sle_conditions_w_elig_visits, passes={"sle_conditions": 2}
    ),
    "sle_i_e_pats_w_elig_visits": _cohort_of("sle_conditions_w_elig_visits"),
    "sle_biopsies": Step(
        ("sle_conditions_w_elig_visits", "coded_procedures"), _sle_biopsies, decisive=True
    ),
    "sle_cohort": Step(("sle_conditions_w_elig_visits", "sle_biopsies"), _sle_cohort),
    "nephrotic_kt_no_sle": _without_sle("nephrotic_kt_cohort"),
    "nephrotic_kt_src_no_sle": _without_sle("nephrotic_kt_src_cohort"),
    "final_cohort": Step(
        ("nephrotic_kt_no_sle", "nephrotic_kt_src_no_sle", "nephrology_visit_cohort_exp"),
        _final_cohort,
    ),
}

# Result tables in the order they are written, with the columns they are
# sorted by.
RESULTS: dict[str, tuple[str, ...]] = {
    "nephrology_visits": ("person_id", "visit_start_date"),
    "nephrology_visit_cohort": ("person_id",),
    "nephrology_visits_exp": ("person_id", "visit_start_date"),
    "nephrology_visit_cohort_exp": ("person_id",),
    "glomerular_disease_cohort": ("person_id",),
    "glomerular_disease_cohort_w_neph": ("person_id",),
    "nephrotic_subcohort": ("person_id",),
    "nephrotic_subcohort_w_neph": ("person_id",),
    "nephrotic_kt": ("person_id", "occurrence_id"),
    "nephrotic_kt_cohort": ("person_id",),
    "nephrotic_kt_cohort_w_neph": ("person_id",),
    "nephrotic_kt_src": ("person_id", "condition_occurrence_id"),
    "nephrotic_kt_src_cohort": ("person_id",),
    "nephrotic_kt_src_cohort_w_neph": ("person_id",),
    "sle_cohort": ("person_id",),
    "nephrotic_kt_no_sle": ("person_id",),
    "nephrotic_kt_src_no_sle": ("person_id",),
    "final_cohort": ("person_id",),
}

# Steps counted in the attrition table, in order.
ATTRITION = (
    "nephrology_visit_cohort",
    "nephrology_visit_cohort_exp",
    "glomerular_disease_cohort",
    "glomerular_disease_cohort_w_neph",
    "nephrotic_subcohort",
    "nephrotic_subcohort_w_neph",
    "nephrotic_kt",
    "nephrotic_kt_cohort_w_neph",
    "nephrotic_kt_src_cohort",
    "nephrotic_kt_src_cohort_w_neph",
    "sle_i_e_pats",
    "sle_i_e_pats_w_elig_visits",
    "sle_cohort",
    "nephrotic_kt_no_sle",
    "nephrotic_kt_src_no_sle",
)


def run_study(
    cdm: Cdm,
    codes: StudyCodes,
    results: ResultStore | TableStore,
    parameters: StudyParameters = StudyParameters(),
) -> DataFrame:
    """Write every result table and the attrition table; return the latter.

    Each step reads the stored results of earlier ones. What is stored but is no result goes to a
    work folder that is removed at the end. The attrition table is written anew whenever
    a counted step ends, so that a run that breaks off leaves the counts so far; with it a table
    ``timing`` of the seconds that each step took, in order, with what was stored for it.
    """
    cdm.open_all()
    codes.open_all()
    spark = results.spark
    work = Workspace(spark)

    def keep(df: DataFrame, name: str) -> DataFrame:
        if name in RESULTS:
            return results.write(df, name, RESULTS[name])
        return work.keep(df, name)

    kept = worth_keeping(*RESULTS, *ATTRITION) | set(RESULTS)
    study = TransplantStudy(cdm, codes, parameters, keep=keep, kept=kept)
    persons: dict[str, int] = {}
    timing: list[tuple[int, str, float]] = []
    try:
        for name in (n for n in STEPS if n in RESULTS or n in ATTRITION):
            _log.info("step %s", name)
            started = time.monotonic()
            rows = study.table(name)
            if name in ATTRITION:
                persons[name] = rows.select("person_id").distinct().count()
            timing.append((len(timing) + 1, name, time.monotonic() - started))
            _log.info("%s: %.1f seconds", name, timing[-1][-1])
            if name in ATTRITION:
                _log.info("%s: %d persons", name, persons[name])
                log = results.write(counted(spark, persons), "attrition")
                seconds = spark.createDataFrame(timing, "step_no int, step string, seconds double")
                results.write(seconds.coalesce(1), "timing")
        return log
    finally:
        work.close()
