import datetime as dt

from cohortry.operators import events
from tests.tables import cdm, day, ids_of, persons, rows_of


def test_age_in_days_and_cohort(spark):
    birth = dt.date(2010, 3, 1)
    tables = cdm(
        spark,
        person=[dict(person_id=1, birth_date=birth), dict(person_id=2)],
        procedure_occurrence=[
            dict(person_id=1, procedure_date=birth + dt.timedelta(10)),
            dict(person_id=1, procedure_concept_id=501),
            dict(person_id=2),
            dict(person_id=3),
        ],
        condition_occurrence=[dict(person_id=1, condition_start_date=birth)],
    )
    procedures = events.procedures_in_codeset(
        tables.procedure_occurrence, tables.person, [500], persons(spark, 1, 1)
    )
    assert rows_of(procedures, "person_id", "birth_date", "procedure_age_days") == [(1, birth, 10)]
    everyone = events.procedures_in_codeset(tables.procedure_occurrence, tables.person, [500])
    assert ids_of(everyone) == [1, 2]  # person 3 has no birth date on record
    conditions = events.conditions_in_codeset(tables.condition_occurrence, tables.person, [100])
    assert rows_of(conditions, "condition_age_days") == [(0,)]


def test_transplant_events_union_both_kinds(spark):
    birth = dt.date(1985, 1, 1)
    last_ok = birth + dt.timedelta(10957)
    tables = cdm(
        spark,
        person=[dict(person_id=1, birth_date=birth), dict(person_id=2)],
        condition_occurrence=[
            dict(person_id=1, condition_occurrence_id=7, condition_start_date=last_ok),
            dict(
                person_id=1,
                condition_occurrence_id=8,
                condition_start_date=last_ok + dt.timedelta(1),
            ),
        ],
        procedure_occurrence=[
            dict(person_id=1, procedure_occurrence_id=7, procedure_date=last_ok),
            dict(person_id=2, procedure_occurrence_id=9),
        ],
    )
    found = events.transplant_events(
        tables.condition_occurrence,
        tables.procedure_occurrence,
        tables.person,
        persons(spark, 1, 1),
        [100, 500],
    )
    assert rows_of(found, "table_name", "approach", "occurrence_id", "age_in_days") == [
        ("condition", "cond", 7, 10957),
        ("procedure", "proc", 7, 10957),
    ]


def test_transplant_window_is_closed(spark):
    tables = cdm(
        spark,
        person=[dict(person_id=1)],
        condition_occurrence=[
            dict(person_id=1, condition_occurrence_id=i, condition_start_date=d)
            for i, d in enumerate(
                (
                    dt.date(2008, 12, 31),
                    dt.date(2009, 1, 1),
                    dt.date(2021, 1, 1),
                    dt.date(2021, 1, 2),
                )
            )
        ],
    )
    found = events.transplant_events(
        tables.condition_occurrence,
        tables.procedure_occurrence,
        tables.person,
        persons(spark, 1),
        [100],
    )
    assert ids_of(found, "occurrence_id") == [1, 2]


TEXTS = {
    1: "Adrenal mass",
    2: "RENAL bx",
    3: None,
    4: "55123",  # matches 55.23 read as a pattern
    5: "kidney and adrenal",
    6: "liver",
    7: "x 50200 x",
}


def _guided(spark):
    return cdm(
        spark,
        procedure_occurrence=[
            dict(person_id=i, procedure_source_value=t, procedure_concept_id=600)
            for i, t in TEXTS.items()
        ]
        + [dict(person_id=8, procedure_source_value=None, procedure_concept_id=500)],
    ).procedure_occurrence


def test_guided_biopsy_needs_text(spark):
    found = events.biopsy_procedures(_guided(spark), persons(spark, *range(9)), [500], [600])
    assert ids_of(found) == [2, 4, 7, 8]
    assert found.columns == [
        "person_id",
        "occurrence_id",
        "concept_id",
        "concept_name",
        "biopsy_date",
        "source_value",
        "table_name",
        "approach",
    ]


def test_code_in_both_lists_needs_no_text(spark):
    found = events.biopsy_procedures(_guided(spark), persons(spark, 3), [600], [600])
    assert ids_of(found) == [3]


def test_literal_codes_accept_adrenal(spark):
    found = events.biopsy_by_literal_codes(
        _guided(spark), persons(spark, *range(9), 2), [500], [600]
    )
    assert rows_of(found, "person_id") == [(1,), (2,), (5,), (8,)]


def test_default_literal_codes(spark):
    procedures = cdm(
        spark,
        procedure_occurrence=[
            dict(person_id=1, procedure_concept_id=2109566),
            dict(person_id=2, procedure_concept_id=2003589),
            dict(person_id=3, procedure_concept_id=2211783, procedure_source_value="Kidney"),
            dict(person_id=4, procedure_concept_id=2211783, procedure_source_value="50200"),
        ],
    ).procedure_occurrence
    found = events.biopsy_by_literal_codes(procedures, persons(spark, 1, 2, 3, 4))
    assert ids_of(found) == [1, 3]


def test_earliest_of_each_kind(spark):
    procedures = cdm(
        spark,
        procedure_occurrence=[
            dict(person_id=1, procedure_concept_id=500, procedure_date=day(5)),
            dict(person_id=1, procedure_concept_id=500, procedure_date=day(3)),
            dict(
                person_id=1,
                procedure_concept_id=500,
                procedure_date=day(1),
                procedure_age_in_months=360.0,
            ),
            dict(person_id=1, procedure_concept_id=700, procedure_date=day(4)),
            dict(person_id=2, procedure_concept_id=700, procedure_date=day(4)),
        ],
    ).procedure_occurrence
    found = events.earliest_biopsy_and_transplant(procedures, [500], [600], [700])
    assert rows_of(found) == [(1, day(3), day(4)), (2, None, day(4))]
