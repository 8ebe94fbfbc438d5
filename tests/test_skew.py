"""A third of all rows on one person, provider, visit and code: joins must split them."""

import re

import pytest
from pyspark.sql import functions as F

from cohortry.functions import in_any_codes
from cohortry.operators import disease, events, lupus, membership, pairing, spacing, specialty
from cohortry.session import configure
from cohortry.sources import Cdm, Workspace

ROWS = 90_000
PERSONS = 8_000

# Small enough for the test data to count as skewed; no side may be broadcast.
SMALL_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "64",
}


@pytest.fixture(scope="module")
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_SCALE}
    workspace = Workspace(spark)

    def spread(n, salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))

    def date(salt):
        return F.date_add(F.to_date(F.lit("2012-01-01")), spread(1500, salt).cast("int"))

    rows = spark.range(0, ROWS, 1, 16)
    third = F.col("id") % 3
    person_id = F.when(third == 0, 7).otherwise(spread(PERSONS, 1))
    code = F.when(third == 1, 5).otherwise(spread(50, 2))
    tables = {
        "person": spark.range(PERSONS).select(
            F.col("id").alias("person_id"),
            F.lit("A").alias("site"),
            F.to_date(F.lit("1995-01-01")).alias("birth_date"),
        ),
        "visit_occurrence": rows.select(
            F.col("id").alias("visit_occurrence_id"),
            person_id.alias("person_id"),
            F.lit("A").alias("site"),
            date(3).alias("visit_start_date"),
            F.lit(1).alias("visit_concept_id"),
            F.lit("x").alias("visit_concept_name"),
            F.when(third == 1, 3).when(third == 2, spread(500, 4)).alias("provider_id"),
            F.when(third == 0, 2).otherwise(spread(100, 5)).alias("care_site_id"),
        ),
        "condition_occurrence": rows.select(
            F.col("id").alias("condition_occurrence_id"),
            person_id.alias("person_id"),
            F.lit("A").alias("site"),
            F.when(third == 0, 4242).otherwise(F.col("id")).alias("visit_occurrence_id"),
            code.alias("condition_concept_id"),
            F.lit("n").alias("condition_concept_name"),
            F.lit(1).alias("condition_type_concept_id"),
            date(6).alias("condition_start_date"),
            F.lit("v").alias("condition_source_value"),
            code.alias("condition_source_concept_id"),
            F.lit("s").alias("condition_source_concept_name"),
            F.lit(100).alias("condition_start_age_in_months"),
        ),
        "procedure_occurrence": rows.select(
            F.col("id").alias("procedure_occurrence_id"),
            person_id.alias("person_id"),
            F.lit("A").alias("site"),
            code.alias("procedure_concept_id"),
            F.lit("n").alias("procedure_concept_name"),
            date(7).alias("procedure_date"),
            F.lit("renal").alias("procedure_source_value"),
            F.lit(100).alias("procedure_age_in_months"),
        ),
        "drug_exposure": rows.select(person_id.alias("person_id"), code.alias("drug_concept_id")),
        "provider": spark.range(500).selectExpr(
            "id AS provider_id", "id % 10 AS specialty_concept_id"
        ),
        "care_site": spark.range(100).selectExpr(
            "id AS care_site_id", "id % 10 AS specialty_concept_id"
        ),
    }
    stored = {name: workspace.write(df, name) for name, df in tables.items()}

    class Skewed:
        cdm = Cdm.of(**stored)
        codes = workspace.keep(spark.range(40).selectExpr("id AS concept_id"), "codes")
        few = workspace.keep(spark.range(4).selectExpr("id AS concept_id"), "few")
        flags = workspace.keep(
            spark.range(50).selectExpr(
                "id AS concept_id",
                "CAST(id % 2 AS INT) AS kidney_related",
                "CAST(id % 3 = 0 AS INT) AS sle",
            ),
            "flags",
        )
        cohort = workspace.keep(
            spark.range(PERSONS).where("id % 2 = 1").selectExpr("id AS person_id"), "cohort"
        )

    configure(spark)
    yield Skewed, spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _visit_args(s):
    return s.cdm.visit_occurrence, s.cdm.provider, s.cdm.care_site, s.few


# Operator, and the keys whose hot rows its joins must split.
CASES = {
    "spaced_specialty_visits": (
        lambda s: spacing.spaced_specialty_visits(*_visit_args(s), [1]),
        {"person_id", "provider_id", "care_site_id"},
    ),
    "specialty_events": (
        lambda s: specialty.specialty_events(*_visit_args(s)),
        {"provider_id", "care_site_id"},
    ),
    "visits_with_specialty": (
        lambda s: specialty.visits_with_specialty(
            s.cdm.visit_occurrence, s.cohort, s.cdm.provider, s.cdm.care_site
        ),
        {"person_id", "provider_id", "care_site_id"},
    ),
    "eligible_visits": (
        lambda s: specialty.eligible_visits(
            s.cdm.visit_occurrence, s.cohort, s.cdm.provider, s.cdm.care_site, s.few, [1]
        ),
        {"person_id", "provider_id", "care_site_id"},
    ),
    "population_eligible_visits": (
        lambda s: specialty.population_eligible_visits(*_visit_args(s), [1]),
        {"person_id", "provider_id", "care_site_id"},
    ),
    "conditions_in_codeset": (
        lambda s: events.conditions_in_codeset(
            s.cdm.condition_occurrence, s.cdm.person, s.codes, s.cohort
        ),
        {"person_id", "condition_concept_id"},
    ),
    "transplant_events": (
        lambda s: events.transplant_events(
            s.cdm.condition_occurrence,
            s.cdm.procedure_occurrence,
            s.cdm.person,
            s.cohort,
            s.codes,
        ),
        {"person_id", "condition_concept_id", "procedure_concept_id"},
    ),
    "biopsy_procedures": (
        lambda s: events.biopsy_procedures(s.cdm.procedure_occurrence, s.cohort, s.few, s.codes),
        {"person_id", "procedure_concept_id"},
    ),
    "disease_cohort": (
        lambda s: disease.disease_cohort(
            s.cdm, s.codes, s.few, s.codes, [9], s.few,
            other_code_required=[1, 2, 3], nephrology_required=[4, 5, 6],
        ),
        {"condition_concept_id", "_gate", "procedure_concept_id"},
    ),
    "dominant_category_subcohort": (
        lambda s: disease.dominant_category_subcohort(
            s.cohort, s.cdm.condition_occurrence, [1, 2, 3, 5], [4]
        ),
        {"condition_concept_id"},
    ),
    "incl_excl_conditions": (
        lambda s: membership.incl_excl_conditions(s.cdm.condition_occurrence, s.codes, [49]),
        {"person_id", "condition_concept_id"},
    ),
    "conditions_with_eligible_visits": (
        lambda s: membership.conditions_with_eligible_visits(
            s.cdm.condition_occurrence, *_visit_args(s), [1]
        ),
        {"person_id", "provider_id", "care_site_id"},
    ),
    "same_date_pair_for_cohort": (
        lambda s: pairing.same_date_pair_for_cohort(
            s.cohort, s.cdm.condition_occurrence, s.flags
        ),
        {"person_id", "condition_concept_id"},
    ),
    "sle_cohort": (
        lambda s: lupus.sle_cohort(s.cdm, s.cdm.condition_occurrence, s.codes),
        {"drug_concept_id"},
    ),
    "followup_at_least": (
        lambda s: spacing.followup_at_least(s.cdm.visit_occurrence, s.cohort),
        {"person_id"},
    ),
    "biopsy_by_literal_codes": (
        lambda s: events.biopsy_by_literal_codes(
            s.cdm.procedure_occurrence, s.cohort, s.few, s.codes
        ),
        {"person_id", "procedure_concept_id"},
    ),
    "persons_with_any_code": (
        lambda s: membership.persons_with_any_code(
            s.cohort, s.cdm.condition_occurrence, s.cdm.person, s.codes
        ),
        {"condition_concept_id"},
    ),
    "procedures_in_codeset": (
        lambda s: events.procedures_in_codeset(
            s.cdm.procedure_occurrence, s.cdm.person, s.codes, s.cohort
        ),
        {"person_id", "procedure_concept_id"},
    ),
    "visit_table_specialty": (
        lambda s: specialty.visit_table_specialty(
            s.cdm.visit_occurrence, s.cohort, s.cdm.provider, s.cdm.care_site
        ),
        {"person_id", "provider_id", "care_site_id"},
    ),
    "biopsy_before_transplant": (
        lambda s: disease.biopsy_before_transplant(
            s.cohort, s.cdm.procedure_occurrence, s.few, s.codes, [9]
        ),
        {"procedure_concept_id"},
    ),
    "rows_with_any_code": (
        lambda s: in_any_codes(
            s.cdm.condition_occurrence,
            condition_concept_id=[s.few, [5, 6]],
            condition_source_concept_id=[s.codes],
        ),
        {"condition_concept_id", "condition_source_concept_id"},
    ),
    "spaced_visits": (
        lambda s: spacing.spaced_visits(s.cdm.visit_occurrence),
        {"person_id"},
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_hot_keys_are_split(skewed, name, kept):
    tables, spark = skewed
    operator, hot_keys = CASES[name]

    def summary():
        df = operator(tables)
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64(*sorted(df.columns)))).collect()

    for key in SMALL_SCALE:
        spark.conf.unset(key)
    usual = summary()  # small sides are broadcast: nothing is shuffled by a hot key
    for key, value in SMALL_SCALE.items():
        spark.conf.set(key, value)
    assert summary() == usual

    kept.clear()
    df = operator(tables)
    df.collect()
    plan = "".join(
        d._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0] for d in [*kept, df]
    )
    assert "Broadcast" not in plan
    split = re.findall(r"Join\(skew=true\) \[([a-z_]+)#", plan)
    assert hot_keys <= set(split), plan


def test_windows_see_one_row_per_person_and_day(skewed):
    tables, spark = skewed
    found = spacing.two_codes_spread(tables.cdm.condition_occurrence)
    days = found.groupBy("person_id").count().agg(F.max("count")).collect()[0][0]
    assert days <= 1500
