"""Every registered query against its SQL, and properties of the study's cohorts."""

import datetime as dt
import re

import duckdb
import pytest

import __spark_entry__ as contract
from cohortry.plans import TransplantStudy
from cohortry.plans.transplant_study import ATTRITION, STEPS, worth_keeping
from cohortry.sources import ResultStore
from testkit import commerce, queries as registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(registry.queries()) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", registry.queries())
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    relation = db.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: SPARK_TO_DUCKDB[t] for c, t in df.dtypes} == expected_types
    expected = sorted(map(repr, relation.project(", ".join(columns)).fetchall()))
    assert found == expected
    assert found, "the scenario has become empty"

    execution = df._jdf.queryExecution()
    physical, analyzed = execution.executedPlan().toString(), execution.analyzed().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoop|Python|Pandas|Arrow", physical)
    assert "ResolvedHint" not in analyzed
    # Windows are always partitioned.
    assert name == "attrition" or "Exchange SinglePartition" not in physical


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["person_id", "site"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def study(spark):
    from cohortry.sources import Workspace

    workspace = Workspace(spark)
    return TransplantStudy(
        commerce.clinical_tables(spark, SF_DIR, workspace),
        commerce.codes(spark, SF_DIR),
        commerce.PARAMETERS,
        keep=workspace.keep,
        kept=set(STEPS),
    )


def _persons(study, step):
    return {r[0] for r in study.table(step).select("person_id").distinct().collect()}


def test_cohorts_nest(study):
    chain = [
        "nephrotic_kt_cohort_w_neph",
        "nephrotic_kt_cohort",
        "nephrotic_subcohort",
        "glomerular_disease_cohort",
    ]
    for inner, outer in zip(chain, chain[1:]):
        assert _persons(study, inner) <= _persons(study, outer)
    assert _persons(study, "nephrology_visit_cohort") <= _persons(
        study, "nephrology_visit_cohort_exp"
    )
    assert not _persons(study, "nephrotic_kt_no_sle") & _persons(study, "sle_cohort")
    final = _persons(study, "final_cohort")
    assert final <= _persons(study, "nephrology_visit_cohort_exp")
    assert final <= _persons(study, "nephrotic_subcohort")


def test_three_spaced_codes_imply_a_spread_of_two(study):
    from cohortry.operators.spacing import three_codes_spaced, two_codes_spread

    rows = study.table("sle_conditions_w_elig_visits")
    spaced = {r[0] for r in three_codes_spaced(rows).collect()}
    assert spaced and spaced <= {r[0] for r in two_codes_spread(rows).collect()}


def test_order_partitioning_and_repeats_of_cohorts_do_not_matter(study):
    from cohortry.operators.disease import dominant_category_subcohort
    from cohortry.operators.events import transplant_events
    from tests.tables import rows_of

    cohort = study.table("glomerular_disease_cohort")
    shuffled = cohort.union(cohort).repartition(7)
    lists = [commerce.codes(cohort.sparkSession, SF_DIR).biopsy, study.codes.transplant_broad]
    conditions = study.cdm.condition_occurrence
    assert rows_of(dominant_category_subcohort(cohort, conditions, *lists)) == rows_of(
        dominant_category_subcohort(shuffled, conditions, *lists)
    )
    events = [
        transplant_events(
            conditions, study.cdm.procedure_occurrence, study.cdm.person, c, lists[1]
        )
        for c in (cohort, shuffled)
    ]
    assert rows_of(events[0]) == rows_of(events[1])


def test_attrition_counts_the_cohorts(study):
    log = study.attrition().collect()
    assert [tuple(r) for r in log[:1]] == [(0, "start", 0)]
    assert [r.cohort for r in log[1:]] == list(ATTRITION)
    for row in log[1:]:
        assert row.persons == len(_persons(study, row.cohort))


def test_steps_come_after_their_inputs():
    seen = set()
    for name, step in STEPS.items():
        assert set(step.inputs) <= seen
        seen.add(name)


def test_what_is_kept_depends_on_what_is_wanted():
    assert worth_keeping("nephrology_visit_cohort") == {"specialty_visits"}
    lupus = {"coded_conditions", "sle_conditions", "sle_conditions_w_elig_visits", "sle_biopsies"}
    assert worth_keeping("sle_cohort") == lupus
    assert worth_keeping("final_cohort") == lupus | {
        "coded_procedures",
        "specialty_visits",
        "nephrotic_subcohort",
        "sle_cohort",
    }


def test_run_study_writes_every_result(spark, study, tmp_path):
    from cohortry.plans import run_study
    from cohortry.plans.transplant_study import RESULTS

    store = ResultStore(spark, str(tmp_path / "results"))
    log = run_study(study.cdm, study.codes, store, commerce.PARAMETERS)
    persons = {r.cohort: r.persons for r in log.collect()}
    for name in RESULTS:
        stored = {r[0] for r in store.read(name).select("person_id").distinct().collect()}
        assert stored == _persons(study, name)
        if name in persons and name in ATTRITION:
            assert persons[name] == len(stored)
    assert store.read("attrition").count() == len(ATTRITION) + 1
    assert {p.name for p in (tmp_path / "results").iterdir()} == {*RESULTS, "attrition", "timing"}
    timing = store.read("timing").orderBy("step_no").collect()
    steps = [name for name in STEPS if name in RESULTS or name in ATTRITION]
    counted = [n for n, name in enumerate(steps, 1) if name in ATTRITION]
    assert [r.step for r in timing] == steps[: counted[-1]] and all(r.seconds > 0 for r in timing)
    assert [r.cohort for r in log.orderBy("step_no").collect()] == ["start", *ATTRITION]


def test_every_line_item_is_an_event(spark):
    kinds = ("condition_occurrence", "procedure_occurrence", "drug_exposure")
    tables = commerce.clinical_tables(spark, SF_DIR)
    events = sum(getattr(tables, kind).count() for kind in kinds)
    assert events == commerce.read(spark, SF_DIR, "lineitem").count()


def test_command_line(spark, study, tmp_path, capsys, monkeypatch):
    from cohortry import __main__ as command

    study.cdm.person.write.parquet(str(tmp_path / "cdm" / "person"))
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists" / "in_person.csv").write_text("concept_id\n9201\n")
    seen = {}

    def run(cdm, codes, results):
        seen.update(persons=cdm.person.count(), types=codes.in_person.count(), root=results.root)
        return spark.sql("SELECT 0 AS step_no, 'start' AS cohort, 0 AS persons")

    monkeypatch.setattr(command, "run_study", run)
    folders = {"--cdm": "cdm", "--codesets": "lists", "--results": "out"}
    command.main([a for option, f in folders.items() for a in (option, str(tmp_path / f))])
    assert seen == {"persons": 150, "types": 1, "root": str(tmp_path / "out")}
    assert "start" in capsys.readouterr().out


def test_default_parameters():
    from cohortry.plans import StudyParameters

    p = StudyParameters()
    assert (p.first_day, p.last_day) == (dt.date(2009, 1, 1), dt.date(2021, 1, 1))
    assert (p.age_bound_years, p.min_visits, p.visit_gap_days) == (30, 3, 7)
