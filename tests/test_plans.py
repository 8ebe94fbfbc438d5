"""What reaches the scans, and how often each table is read."""

import re

import pytest

from cohortry.operators import disease, events, membership, pairing, spacing, specialty
from cohortry.operators.attrition import attrition
from cohortry.sources import Cdm, Workspace
from cohortry.sources.schema import CDM_COLUMNS
from tests.tables import NEPHROLOGY, cdm, persons


@pytest.fixture(scope="module")
def stored(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    workspace = Workspace(spark)
    tables = cdm(
        spark,
        person=[dict(person_id=1)],
        visit_occurrence=[dict(person_id=1)],
        condition_occurrence=[dict(person_id=1)],
        procedure_occurrence=[dict(person_id=1)],
        drug_exposure=[dict(person_id=1)],
    )
    for name in CDM_COLUMNS:
        workspace.write(getattr(tables, name), name)
    yield Cdm.from_folder(spark, workspace.root)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def _scans(df, table):
    """(pushed filters, columns read) of every scan of a table."""
    found = []
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    for line in plan.splitlines():
        if "FileScan parquet" in line and re.search(rf"paths\)\[[^\]]*/{table}\]", line):
            columns = re.search(r"FileScan parquet \[([^\]]*)\]", line)[1]
            pushed = re.search(r"PushedFilters: \[(.*)\], ReadSchema", line)[1]
            found.append((pushed, set(re.sub(r"#\d+L?", "", columns).split(","))))
    return found


def test_window_reaches_the_only_visit_scan(spark, stored, kept):
    df = spacing.spaced_specialty_visits(
        stored.visit_occurrence, stored.provider, stored.care_site, NEPHROLOGY, [9202]
    )
    ((pushed, _),) = [scan for d in [*kept, df] for scan in _scans(d, "visit_occurrence")]
    assert "GreaterThanOrEqual(visit_start_date,2009-01-01)" in pushed
    assert "LessThanOrEqual(visit_start_date,2021-01-01)" in pushed


def test_spacing_shuffles_days_once(spark, stored):
    """One exchange gathers a person's days; the join needs one for each side."""
    plan = spacing.spaced_visits(stored.visit_occurrence)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan.split("== Initial Plan ==")[-1])) <= 3
    assert "Window" not in plan


FLAGGED = "concept_id long, kidney_related int, sle int"
READ_ONCE = {
    "eligible_visits": lambda s, spark: specialty.eligible_visits(
        s.visit_occurrence, persons(spark, 1), s.provider, s.care_site, NEPHROLOGY, [9202]
    ),
    "population_eligible_visits": lambda s, spark: specialty.population_eligible_visits(
        s.visit_occurrence, s.provider, s.care_site, NEPHROLOGY, [9202]
    ),
    "incl_excl_conditions": lambda s, spark: membership.incl_excl_conditions(
        s.condition_occurrence, [100], [200]
    ),
    "same_date_pair": lambda s, spark: pairing.same_date_pair(
        s.condition_occurrence, spark.createDataFrame([(100, 1, 1)], FLAGGED)
    ),
    "same_date_pair_for_cohort": lambda s, spark: pairing.same_date_pair_for_cohort(
        persons(spark, 1), s.condition_occurrence, spark.createDataFrame([(100, 1, 1)], FLAGGED)
    ),
}


@pytest.mark.parametrize("name", READ_ONCE)
def test_tables_are_read_once(spark, stored, kept, name):
    df = READ_ONCE[name](stored, spark)
    reads = [t for t in CDM_COLUMNS for d in [*kept, df] for _ in _scans(d, t)]
    assert {"visit_occurrence", "condition_occurrence"} & set(reads)
    assert len(reads) == len(set(reads))


def _shuffled(df):
    """Rows that each exchange of an executed plan wrote."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_attrition_shuffles_a_row_per_person(spark):
    """Twenty cohorts of the same thousand persons, in two tasks: not twenty rows per person."""
    everyone = Workspace(spark).keep(spark.range(1000).selectExpr("id AS person_id"), "everyone")
    cohorts = {f"c{no}": everyone.where(f"person_id % {no + 1} = 0") for no in range(70)}
    log = attrition({**cohorts, "none": everyone.where("person_id < 0")})
    rows = [tuple(r) for r in log.collect()]
    assert rows[0] == (0, "start", 0) and rows[-1] == (71, "none", 0)
    assert [r[2] for r in rows[1:-1]] == [-(-1000 // (no + 1)) for no in range(70)]
    # A person per cohort and task at most before they are merged, one row per task after.
    assert log.columns == ["step_no", "cohort", "persons"]
    assert sum(_shuffled(log)) <= sum(r[2] for r in rows) + 100


def test_disease_cohort_scans(spark, stored):
    df = disease.disease_cohort(stored, [100], [500], [600], [700], NEPHROLOGY)
    condition_scans = _scans(df, "condition_occurrence")
    assert len(condition_scans) == 2  # the second for diagnoses that name a visit
    for pushed, _ in condition_scans:
        assert "LessThan(condition_start_age_in_months,360.0)" in pushed
        assert "GreaterThanOrEqual(condition_start_date,2009-01-01)" in pushed
    (procedure_scan,) = _scans(df, "procedure_occurrence")
    assert "LessThan(procedure_age_in_months,360.0)" in procedure_scan[0]
    (visit_scan,) = _scans(df, "visit_occurrence")
    assert visit_scan[1] == {"visit_occurrence_id", "provider_id", "care_site_id"}


def test_only_gated_diagnoses_look_up_visits(spark, stored):
    df = disease.disease_cohort(stored, [100], [500], [600], [700], NEPHROLOGY)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # Visits are narrowed before their provider and care site are looked up.
    order = re.findall(r"Join \w+, .*?(visit_occurrence_id|provider_id|care_site_id|_gate)#", plan)
    assert order.index("_gate") < order.index("care_site_id") < order.index("provider_id")
    assert order.index("provider_id") < order.index("visit_occurrence_id")


def test_followup_aggregates_the_cohort_only(spark, stored):
    df = spacing.followup_at_least(stored.visit_occurrence, persons(spark, 1))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[person_id.*\n.*Join LeftSemi", plan)


def test_eligible_visits_are_of_the_cohort(spark, stored):
    df = membership.conditions_with_eligible_visits(
        stored.condition_occurrence, stored.visit_occurrence, stored.provider, stored.care_site,
        NEPHROLOGY, [9202],
    )
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    order = re.findall(r"Join \w+, .*?(person_id|provider_id|care_site_id)#", plan)
    assert order[-1] == "person_id" and {"provider_id", "care_site_id"} <= set(order[:-1])


def test_reads_of_a_whole_study(spark, tmp_path):
    """The clinical tables are read few times, whatever the number of steps."""
    from cohortry.plans import TransplantStudy
    from cohortry.plans.transplant_study import ATTRITION, RESULTS, STEPS, worth_keeping
    from testkit import commerce

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    source = commerce.clinical_tables(spark, "/root/testdata/sf0.001")
    for name in CDM_COLUMNS:
        getattr(source, name).write.parquet(str(tmp_path / name))
    work, reads = Workspace(spark), dict.fromkeys(CDM_COLUMNS, 0)

    def count(df):
        for name in reads:
            reads[name] += len(_scans(df, name))

    def keep(df, name):
        count(df)
        return work.keep(df, name)

    study = TransplantStudy(
        Cdm.from_folder(spark, str(tmp_path)), commerce.codes(spark, "/root/testdata/sf0.001"),
        commerce.PARAMETERS, keep=keep, kept=worth_keeping(*RESULTS, *ATTRITION) | set(RESULTS),
    )
    for name in STEPS:
        if name in RESULTS:
            study.table(name)
    work.close()
    assert reads["visit_occurrence"] <= 4
    assert reads["condition_occurrence"] <= 2
    assert reads["procedure_occurrence"] <= 1


def test_transplant_window_is_pushed_below_the_union(spark, stored):
    df = events.transplant_events(
        stored.condition_occurrence,
        stored.procedure_occurrence,
        stored.person,
        persons(spark, 1),
        [100],
    )
    (conditions,) = _scans(df, "condition_occurrence")
    (procedures,) = _scans(df, "procedure_occurrence")
    assert "GreaterThanOrEqual(condition_start_date,2009-01-01)" in conditions[0]
    assert "GreaterThanOrEqual(procedure_date,2009-01-01)" in procedures[0]


def test_specialty_and_origin_in_one_pass(spark, stored):
    df = specialty.visits_with_specialty(
        stored.visit_occurrence, persons(spark, 1), stored.provider, stored.care_site
    )
    assert len(_scans(df, "visit_occurrence")) == 1


def test_codes_filter_before_persons(spark, stored):
    """The person join of biopsies sits above the code join, not below it."""
    df = events.biopsy_procedures(stored.procedure_occurrence, persons(spark, 1), [500], [600])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [re.search(r"(\w+)#\d+L = ", line)[1] for line in re.findall(r"Join .*", plan)]
    assert joins.index("person_id") < joins.index("procedure_concept_id")


def test_literal_codes_reach_the_scan(spark, stored):
    df = membership.persons_exposed_to_drug(persons(spark, 1), stored.drug_exposure, [900, 901])
    assert "In(drug_concept_id, [900,901])" in _scans(df, "drug_exposure")[0][0]


@pytest.fixture(scope="module")
def steps_of_attrition(spark):
    """What the attrition query stores, by name, and how often the clinical tables' sources are scanned."""
    from cohortry.plans import TransplantStudy
    from cohortry.plans.transplant_study import ATTRITION, worth_keeping
    from testkit import commerce

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    sf_dir, work, found = "/root/testdata/sf0.001", Workspace(spark), {}

    def keep(df, name):
        found[name] = df
        return work.keep(df, name)

    study = TransplantStudy(
        commerce.clinical_tables(spark, sf_dir, work), commerce.codes(spark, sf_dir),
        commerce.PARAMETERS, keep=keep, kept=worth_keeping(*ATTRITION),
    )
    study.attrition()
    yield found
    work.close()
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_stored_rows_carry_their_lists(steps_of_attrition):
    """Code lists, parts here, are joined to the coded rows once, and not in every step that picks from them."""
    for name in (
        "glomerular_disease_cohort",
        "nephrotic_subcohort",
        "nephrotic_kt",
        "nephrotic_kt_src",
        "sle_conditions",
        "sle_biopsies",
    ):
        assert _scans(steps_of_attrition[name], "coded_(conditions|procedures)")
        assert not _scans(steps_of_attrition[name], "part.parquet"), name
    assert not [c for c in steps_of_attrition["nephrotic_kt_src"].columns if c.startswith("_in_")]


@pytest.mark.parametrize("name, kind", [("coded_conditions", "R"), ("coded_procedures", "A")])
def test_events_join_the_stored_visits(steps_of_attrition, name, kind):
    """Line items of the wanted kind alone are read, and not joined to orders and customers again."""
    ((pushed, _),) = _scans(steps_of_attrition[name], "lineitem.parquet")
    assert f"EqualTo(l_returnflag,{kind})" in pushed
    assert len(_scans(steps_of_attrition[name], "visits")) == 1
    assert not _scans(steps_of_attrition[name], "(orders|customer).parquet")
