import datetime as dt

import pytest

from cohortry.operators import spacing
from tests.tables import NEPHROLOGY, cdm, day, ids_of, persons, rows_of


def _visits(spark, days_by_person, **columns):
    return cdm(
        spark,
        visit_occurrence=[
            dict(person_id=p, visit_start_date=d if isinstance(d, dt.date) else day(d), **columns)
            for p, days in days_by_person.items()
            for d in days
        ],
    )


def _spaced(tables, **options):
    return spacing.spaced_specialty_visits(
        tables.visit_occurrence, tables.provider, tables.care_site, NEPHROLOGY, [9202], **options
    )


def test_middle_visit_needs_the_gap_on_both_sides(spark):
    tables = _visits(spark, {1: [0, 6, 13], 2: [0, 7, 14], 3: [0, 7, 13]})
    assert ids_of(_spaced(tables)) == [2]


def test_three_visits_on_two_dates_are_not_enough(spark):
    assert ids_of(_spaced(_visits(spark, {1: [0, 30, 30]}))) == []


def test_only_one_middle_date_needs_spacing(spark):
    # Four dates asked for; three of them lie close together.
    tables = _visits(spark, {1: [0, 1, 10, 20]})
    assert rows_of(_spaced(tables, min_visits=4), "person_id", "distinct_dates") == [(1, 4)] * 4


def test_zero_gap_still_excludes_the_ends(spark):
    assert ids_of(_spaced(_visits(spark, {1: [0, 5]}), min_visits=2, gap_days=0)) == []


def test_window_ends_are_included(spark):
    first, last = dt.date(2009, 1, 1), dt.date(2021, 1, 1)
    before, after = first - dt.timedelta(1), last + dt.timedelta(1)
    middle = dt.date(2015, 1, 1)
    tables = _visits(spark, {1: [first, middle, last], 2: [before, middle, last]})
    assert ids_of(_spaced(tables)) == [1]
    tables = _visits(spark, {1: [first, middle, after], 2: [first, middle, last, after]})
    assert rows_of(_spaced(tables), "person_id") == [(2,)] * 3


def test_other_specialty_and_type_do_not_count(spark):
    tables = _visits(spark, {1: [0, 7, 14]}, provider_id=20)
    assert ids_of(_spaced(tables)) == []
    tables = _visits(spark, {1: [0, 7, 14]}, visit_concept_id=1)
    assert ids_of(_spaced(tables)) == []


def test_all_visit_columns_come_back(spark):
    tables = _visits(spark, {1: [0, 7, 14]})
    found = _spaced(tables)
    assert found.columns[:3] == ["person_id", "visit_occurrence_id", "distinct_dates"]
    assert set(found.columns) == {*tables.visit_occurrence.columns, "distinct_dates"}


def test_sites_are_not_told_apart_for_visits(spark):
    tables = cdm(
        spark,
        visit_occurrence=[
            dict(person_id=1, site=s, visit_start_date=day(d))
            for s, d in (("A", 0), ("B", 7), ("A", 14))
        ],
    )
    assert _spaced(tables).count() == 3


def _codes(spark, days, site="A"):
    return cdm(
        spark,
        condition_occurrence=[
            dict(person_id=1, site=site, condition_start_date=day(d)) for d in days
        ],
    ).condition_occurrence


@pytest.mark.parametrize(
    "days, spaced", [([0, 29, 59], []), ([0, 30, 60], [30]), ([0, 30, 59], [])]
)
def test_three_codes_spaced(spark, days, spaced):
    found = spacing.three_codes_spaced(_codes(spark, days))
    assert rows_of(found) == [(1, "A", day(d)) for d in spaced]


@pytest.mark.parametrize("last, dates", [(59, 0), (60, 3)])
def test_two_codes_spread(spark, last, dates):
    assert spacing.two_codes_spread(_codes(spark, [0, 5, 5, last])).count() == dates


def test_codes_are_counted_per_site(spark):
    conditions = _codes(spark, [0, 60]).union(_codes(spark, [30], site="B"))
    assert rows_of(spacing.three_codes_spaced(conditions)) == []
    assert rows_of(spacing.two_codes_spread(conditions), "site") == [("A",), ("A",)]


@pytest.mark.parametrize("last, found", [(59, []), (60, [1])])
def test_followup(spark, last, found):
    tables = _visits(spark, {1: [0, 3, last], 2: [0, 100]}, visit_concept_id=77, provider_id=None)
    followed = spacing.followup_at_least(tables.visit_occurrence, persons(spark, 1, 1))
    assert ids_of(followed) == found
    if found:
        assert rows_of(followed) == [(1, day(60), day(0), 60)]
