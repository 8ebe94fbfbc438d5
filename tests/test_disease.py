import datetime as dt

import pytest

from cohortry.operators import disease
from tests.tables import NEPHROLOGY, cdm, day, persons, rows_of

# Codes: 100 and 101 plain, 110 and 111 need another code, 120 needs a nephrology visit.
CODES = [100, 101, 110, 111, 120]


def _cohort(tables):
    return disease.disease_cohort(
        tables,
        CODES,
        [500],
        [600],
        [700],
        NEPHROLOGY,
        other_code_required=[110, 111],
        nephrology_required=[120],
    )


def _entries(tables):
    return rows_of(_cohort(tables), "person_id", "site", "entry")


def dx(person, n, code=100, **columns):
    return dict(
        person_id=person, condition_start_date=day(n), condition_concept_id=code, **columns
    )


def px(person, n, code=500, **columns):
    return dict(person_id=person, procedure_date=day(n), procedure_concept_id=code, **columns)


def test_two_dates(spark):
    tables = cdm(spark, condition_occurrence=[dx(1, 0), dx(1, 1), dx(2, 0), dx(2, 0)])
    assert rows_of(_cohort(tables)) == [(1, "A", "two_codes", 2, 1, 2)]


def test_restricted_codes_alone_are_refused(spark):
    tables = cdm(
        spark,
        condition_occurrence=[
            dx(1, 0, 110),
            dx(1, 1, 111),
            # An unrestricted code on one of the same dates lifts the refusal.
            dx(2, 0, 110),
            dx(2, 1, 111),
            dx(2, 1, 100),
        ],
    )
    assert _entries(tables) == [(2, "A", "two_codes")]


def test_refused_person_can_enter_by_biopsy(spark):
    tables = cdm(
        spark,
        condition_occurrence=[dx(1, 0, 110), dx(1, 1, 110), dx(2, 0, 110), dx(2, 1, 110)],
        procedure_occurrence=[px(1, 5), px(1, 9, 700), px(2, 9), px(2, 5, 700)],
    )
    assert rows_of(_cohort(tables)) == [(1, "A", "one_code_w_biopsy", None, None, 2)]


@pytest.mark.parametrize("biopsy, transplant, enters", [(5, 5, False), (4, 5, True), (6, 5, False)])
def test_biopsy_before_transplant(spark, biopsy, transplant, enters):
    tables = cdm(
        spark,
        condition_occurrence=[dx(1, 0)],
        procedure_occurrence=[px(1, biopsy), px(1, transplant, 700)],
    )
    assert bool(_entries(tables)) == enters


def test_only_the_earliest_biopsy_is_looked_at(spark):
    early = dict(person_id=1, procedure_concept_id=500, procedure_date=dt.date(2008, 12, 31))
    tables = cdm(
        spark, condition_occurrence=[dx(1, 0)], procedure_occurrence=[early, px(1, 5)]
    )
    assert _entries(tables) == []


def test_one_code_without_biopsy_is_not_enough(spark):
    assert _entries(cdm(spark, condition_occurrence=[dx(1, 0)])) == []


def test_biopsy_alone_is_not_enough(spark):
    assert _entries(cdm(spark, procedure_occurrence=[px(1, 0)])) == []


def test_nephrology_required(spark):
    tables = cdm(
        spark,
        visit_occurrence=[
            dict(person_id=1, visit_occurrence_id=1, provider_id=10),
            dict(person_id=2, visit_occurrence_id=2, provider_id=20),
        ],
        condition_occurrence=[
            dx(1, 0, 120, visit_occurrence_id=1),
            dx(1, 1, 120, visit_occurrence_id=1),
            dx(2, 0, 120, visit_occurrence_id=2),
            dx(2, 1, 120, visit_occurrence_id=2),
            dx(3, 0, 120, visit_occurrence_id=None),
            dx(3, 1, 100, visit_occurrence_id=None),
        ],
    )
    assert _entries(tables) == [(1, "A", "two_codes")]


def test_age_and_window(spark):
    tables = cdm(
        spark,
        condition_occurrence=[
            dx(1, 0, condition_start_age_in_months=359.0),
            dx(1, 1, condition_start_age_in_months=359.0),
            dx(2, 0, condition_start_age_in_months=359.0),
            dx(2, 1, condition_start_age_in_months=360.0),
            dx(3, 0),
            dict(person_id=3, condition_start_date=dt.date(2021, 1, 1)),
            dx(4, 0),
            dict(person_id=4, condition_start_date=dt.date(2021, 1, 2)),
        ],
    )
    assert _entries(tables) == [(1, "A", "two_codes"), (3, "A", "two_codes")]


def test_sites_are_counted_apart(spark):
    tables = cdm(
        spark,
        condition_occurrence=[dx(1, 0, site="A"), dx(1, 1, site="B")],
        procedure_occurrence=[px(1, 5)],
    )
    assert _entries(tables) == [
        (1, "A", "one_code_w_biopsy"),
        (1, "B", "one_code_w_biopsy"),
    ]


def test_entry_by_codes_at_one_site_bars_the_biopsy_way_at_another(spark):
    tables = cdm(
        spark,
        condition_occurrence=[dx(1, 0, site="A"), dx(1, 1, site="A"), dx(1, 2, site="B")],
        procedure_occurrence=[px(1, 5)],
    )
    assert _entries(tables) == [(1, "A", "two_codes")]


def test_refusal_compares_counts_across_sites(spark):
    # Site A: one restricted code. Site B: two dates of a single plain code.
    # The counts are equal, and persons are matched without regard to site.
    tables = cdm(
        spark,
        condition_occurrence=[dx(1, 0, 110, site="A"), dx(1, 1, site="B"), dx(1, 2, site="B")],
    )
    assert _entries(tables) == []


def test_default_restrictions(spark):
    tables = cdm(
        spark,
        condition_occurrence=[
            dx(1, 0, 261071),
            dx(1, 1, 261071),
            dx(2, 0, 435308),
            dx(2, 1, 259070),
            dx(3, 0),
            dx(3, 1),
        ],
    )
    found = disease.disease_cohort(
        tables, [100, 261071, 435308, 259070], [500], [600], [700], NEPHROLOGY
    )
    assert rows_of(found, "person_id") == [(3,)]


def test_biopsy_operator_keeps_cohort_columns(spark):
    tables = cdm(spark, procedure_occurrence=[px(1, 5), px(2, 5), px(2, 4, 700), px(3, 1, 700)])
    cohort = spark.createDataFrame(
        [(1, "A", 7), (1, "B", 8), (1, "A", 7), (2, "A", 9), (3, "A", 9)],
        "person_id bigint, site string, n int",
    )
    found = disease.biopsy_before_transplant(
        cohort, tables.procedure_occurrence, [500], [600], [700]
    )
    assert rows_of(found) == [(1, "A", 7, day(5), None), (1, "B", 8, day(5), None)]


def _dominant(spark, *rows, cohort=(1,)):
    conditions = cdm(spark, condition_occurrence=list(rows)).condition_occurrence
    found = disease.dominant_category_subcohort(
        persons(spark, *cohort), conditions, [100, 102], [101, 102]
    )
    return rows_of(found)


def test_dominant_category(spark):
    assert _dominant(spark, dx(1, 0), dx(1, 1), dx(1, 0, 101), dx(1, 1, 101)) == []
    assert _dominant(spark, dx(1, 0), dx(1, 1), cohort=(1, 1)) == [(1, 2, 0)]
    assert _dominant(spark, dx(1, 0), dx(1, 0), dx(1, 1), dx(1, 5, 101)) == [(1, 2, 1)]


def test_code_in_both_categories_counts_in_both(spark):
    assert _dominant(spark, dx(1, 0, 102)) == []
    assert _dominant(spark, dx(1, 0, 102), dx(1, 1)) == [(1, 2, 1)]


def test_cohort_member_without_diagnosis_is_not_dominant(spark):
    assert _dominant(spark, dx(2, 0)) == []
