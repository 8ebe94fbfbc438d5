from cohortry.functions import add_site
from cohortry.operators import lupus, membership, pairing
from cohortry.operators.attrition import attrition
from tests.tables import NEPHROLOGY, cdm, day, ids_of, persons, rows_of


def dx(person, n, code=100, **columns):
    return dict(
        person_id=person, condition_start_date=day(n), condition_concept_id=code, **columns
    )


def test_one_excluded_code_ever_removes_the_person(spark):
    conditions = cdm(
        spark, condition_occurrence=[dx(1, 0), dx(1, 900, 200), dx(2, 0), dx(2, 0, 300)]
    ).condition_occurrence
    found = membership.incl_excl_conditions(conditions, [100], [200])
    assert rows_of(found, "person_id", "condition_concept_id") == [(2, 100)]
    assert found.columns == membership.CONDITION_ROW


def test_empty_exclusion_list(spark):
    conditions = cdm(spark, condition_occurrence=[dx(1, 0)]).condition_occurrence
    assert membership.incl_excl_conditions(conditions, [100], []).count() == 1


def test_conditions_of_persons_with_two_visits(spark):
    tables = cdm(
        spark,
        visit_occurrence=[
            dict(person_id=1),
            dict(person_id=1),
            dict(person_id=2),
            dict(person_id=3, provider_id=20),
            dict(person_id=3, provider_id=20),
        ],
        condition_occurrence=[dx(1, 0), dx(2, 0), dx(3, 0)],
    )
    conditions = tables.condition_occurrence
    found = membership.conditions_with_eligible_visits(
        conditions.union(conditions),
        tables.visit_occurrence,
        tables.provider,
        tables.care_site,
        NEPHROLOGY,
        [9202],
    )
    assert rows_of(found, "person_id") == [(1,)]


def test_persons_with_any_code_and_site(spark):
    tables = cdm(
        spark,
        person=[dict(person_id=1, site="A"), dict(person_id=2, site="B")],
        condition_occurrence=[dx(1, 0), dx(1, 1), dx(2, 0)],
    )
    found = membership.persons_with_any_code(
        persons(spark, 1, 1), tables.condition_occurrence, tables.person, [100]
    )
    assert rows_of(found) == [(1, "A")]


def test_add_site_drops_unknown_persons(spark):
    tables = cdm(spark, person=[dict(person_id=1, site="A")])
    assert rows_of(add_site(persons(spark, 1, 2), tables.person)) == [(1, "A")]


def test_exposure(spark):
    tables = cdm(
        spark,
        drug_exposure=[
            dict(person_id=1),
            dict(person_id=1),
            dict(person_id=2, drug_concept_id=901),
            dict(person_id=3),
        ],
    )
    found = membership.persons_exposed_to_drug(
        persons(spark, 1, 2, 1), tables.drug_exposure, [900]
    )
    assert rows_of(found) == [(1,)]


def _flags(spark):
    return spark.createDataFrame(
        [(100, 1, 0), (200, 0, 1), (300, 1, 1), (400, 0, 0)],
        "concept_id bigint, kidney_related int, sle int",
    )


def test_same_date_pair(spark):
    conditions = cdm(
        spark,
        condition_occurrence=[
            dx(1, 0, 100),
            dx(1, 0, 200, site="B"),
            dx(1, 0, 400),
            dx(1, 0, 999),
            dx(2, 0, 100),
            dx(2, 1, 200),
            dx(3, 0, 300),
        ],
    ).condition_occurrence
    found = pairing.same_date_pair(conditions, _flags(spark))
    assert rows_of(found, "person_id", "condition_concept_id", "kidney_related_and_sle") == [
        (1, 100, 1),
        (1, 200, 1),
        (1, 400, 1),
        (3, 300, 1),
    ]
    some = pairing.same_date_pair_for_cohort(persons(spark, 3, 3), conditions, _flags(spark))
    assert ids_of(some) == [3]


def _lupus_tables(spark):
    return cdm(
        spark,
        person=[dict(person_id=i, site=f"S{i}") for i in range(1, 6)],
        visit_occurrence=[
            dict(person_id=p, visit_start_date=day(d))
            for p, days in {2: (0, 60), 3: (0, 59), 4: (0, 60), 5: (0, 60)}.items()
            for d in days
        ],
        condition_occurrence=[
            dx(1, 0), dx(1, 30), dx(1, 60), dx(2, 0), dx(3, 0), dx(4, 0), dx(5, 0, 101)
        ],
        procedure_occurrence=[
            dict(person_id=p, procedure_concept_id=2109566) for p in (2, 3, 4, 5)
        ],
        drug_exposure=[dict(person_id=p) for p in (1, 2, 3, 5)],
    )


def test_lupus_by_codes_or_biopsy_with_followup(spark):
    tables = _lupus_tables(spark)
    rows = tables.condition_occurrence.where("condition_concept_id = 100")
    # 1 by codes without any visit; 2 by biopsy; 3 lacks follow-up; 4 lacks the drug.
    assert rows_of(lupus.sle_cohort(tables, rows, [900])) == [(1, "S1"), (2, "S2")]
    assert rows_of(lupus.sle_cohort_no_biopsy(tables, rows, [900])) == [(1, "S1")]


def test_nephritis_takes_biopsy_persons_separately(spark):
    tables = _lupus_tables(spark)
    rows = tables.condition_occurrence.where("person_id = 1")
    found = lupus.ln_cohort(tables, rows, persons(spark, 5), [900])
    assert rows_of(found) == [(1, "S1"), (5, "S5")]
    assert rows_of(lupus.ln_cohort_no_biopsy(tables, rows, [900])) == [(1, "S1")]


def test_attrition_counts_persons_and_reports_empty_steps(spark):
    log = attrition(
        {"all": persons(spark, 1, 2, 2), "none": persons(spark), "one": persons(spark, 9)}
    )
    assert [tuple(r) for r in log.collect()] == [
        (0, "start", 0),
        (1, "all", 2),
        (2, "none", 0),
        (3, "one", 1),
    ]


def test_a_null_date_is_a_date_of_its_own(spark):
    from cohortry.operators.pairing import same_date_pair, same_date_pair_for_cohort

    tables = cdm(
        spark,
        condition_occurrence=[
            dict(person_id=1, condition_concept_id=1, condition_start_date=None),
            dict(person_id=2, condition_concept_id=2, condition_start_date=None),
            dict(person_id=2, condition_concept_id=3, condition_start_date=None),
            dict(person_id=3, condition_concept_id=2, condition_start_date=None),
        ],
    )
    flags = spark.createDataFrame(
        [(1, 1, 1), (2, 1, 0), (3, 0, 1)], "concept_id long, kidney_related int, sle int"
    )
    found = same_date_pair(tables.condition_occurrence, flags)
    assert sorted(r["person_id"] for r in found.collect()) == [1, 2, 2]
    cohort = spark.createDataFrame([(2,)], "person_id long")
    found = same_date_pair_for_cohort(cohort, tables.condition_occurrence, flags)
    assert sorted(r["person_id"] for r in found.collect()) == [2, 2]


def _codes(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "concept_id long")


def test_marked_rows_are_picked_as_by_their_lists(spark):
    from cohortry.functions import Marked, flagged, in_any_codes, in_codes, mark_codes

    rows = spark.createDataFrame(
        [(n, c, s) for n, (c, s) in enumerate((c, s) for c in (1, 2, 3, 4, None) for s in (2, 7, None))],
        "id int, code long, source long",
    )
    a, b, c = _codes(spark, [1, 2, 2]), [2, 3], _codes(spark, [7, None])
    marked = mark_codes(rows, code={"_a": a, "_b": b, "_none": []}, source={"_c": c})
    listed = in_any_codes(rows, code=[a, b], source=[c])
    assert rows_of(marked.select(*rows.columns)) == rows_of(listed)
    assert marked.where("_a IS NULL OR _b IS NULL OR _c IS NULL OR _none").isEmpty()
    for mark, column, codes in (("_a", "code", a), ("_b", "code", b), ("_c", "source", c)):
        picked = in_codes(marked, column, Marked(mark))
        assert rows_of(picked.select(*rows.columns)) == rows_of(in_codes(rows, column, codes))
    expected = rows_of(flagged(rows, "code", a=a, b=b))
    for lists in ({"a": Marked("_a"), "b": Marked("_b")}, {"a": Marked("_a"), "b": b}):
        assert rows_of(flagged(marked, "code", **lists).select(*rows.columns, "a", "b")) == expected
    either = in_any_codes(marked, code=[Marked("_a")], source=[c])
    assert rows_of(either.select(*rows.columns)) == rows_of(in_any_codes(rows, code=[a], source=[c]))


def test_incl_excl_by_marks(spark):
    from cohortry.functions import Marked, mark_codes

    conditions = cdm(
        spark,
        condition_occurrence=[
            dict(person_id=p, condition_concept_id=c)
            for p, c in ((1, 100), (1, 101), (2, 100), (2, 200), (3, 200), (4, 999), (5, 101), (5, None))
        ],
    ).condition_occurrence
    marked = mark_codes(conditions, condition_concept_id={"_in": [100, 101], "_ex": [200]})
    expected = rows_of(membership.incl_excl_conditions(conditions, [100, 101], [200]))
    assert {r[1] for r in membership.incl_excl_conditions(conditions, [100, 101], [200]).collect()} == {1, 5}
    for keep in ({}, {"keep": None}):
        assert rows_of(membership.incl_excl_conditions(marked, Marked("_in"), Marked("_ex"), **keep)) == expected
