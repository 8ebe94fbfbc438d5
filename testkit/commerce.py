"""Clinical tables, code lists and parameters derived from the commerce tables.

The mapping is described in FIXTURES.md; Spark derives everything from the given
tables, so all of it grows with them.
"""

from __future__ import annotations

import datetime as dt
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cohortry.functions import Codes
from cohortry.plans import StudyCodes, StudyParameters
from cohortry.sources import Cdm, Workspace
from cohortry.sources.schema import conform

PARAMETERS = StudyParameters(
    first_day=dt.date(1996, 1, 1),
    last_day=dt.date(2000, 12, 31),
    biopsy_evidence=("ring", "widget"),
    biopsy_counter_evidence=("red",),
    sle_biopsy_evidence=("ring", "widget"),
)

_BIRTH_DATE = "date_add(DATE'1970-01-01', CAST((c_custkey * 37) % 9000 AS INT))"
# Room for 1,024 suppliers, 1,048,576 parts and 8 lines an order.
_LINE_ID = "(o_orderkey * 8 + l_linenumber) * 1073741824 + p_partkey * 1024 + l_suppkey"
_IS_SLE = "p_type IN ('PROMO', 'LARGE')"

_schemas: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A commerce table; its schema is looked up in the files only once per process."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def clinical_tables(spark: SparkSession, sf_dir: str, workspace: Workspace | None = None) -> Cdm:
    """The clinical tables; with a workspace, visits are written once, and events join the stored visits.

    The events aren't stored: each kind is a table of its own, and a study reads each but once, with the
    columns it needs. What they share, the visits and their persons, is joined to orders and not to line items.
    """

    @cache
    def visits() -> DataFrame:
        df = _visits(spark, sf_dir)
        return workspace.keep(df, "visits") if workspace else df

    @cache
    def events() -> DataFrame:
        return _events(spark, sf_dir, visits() if workspace else _orders(spark, sf_dir))

    tables = {
        "person": lambda: read(spark, sf_dir, "customer").selectExpr(
            "c_custkey AS person_id", "c_mktsegment AS site", f"{_BIRTH_DATE} AS birth_date"
        ),
        "visit_occurrence": lambda: visits().drop("birth_date"),
        "condition_occurrence": lambda: (
            events()
            .where("kind = 'R'")
            .selectExpr(
                "id AS condition_occurrence_id",
                "person_id",
                "site",
                "visit_occurrence_id",
                "concept_id AS condition_concept_id",
                "concept_name AS condition_concept_name",
                "type_concept_id AS condition_type_concept_id",
                "event_date AS condition_start_date",
                "source_value AS condition_source_value",
                "source_concept_id AS condition_source_concept_id",
                "source_concept_name AS condition_source_concept_name",
                "age_in_months AS condition_start_age_in_months",
            )
        ),
        "procedure_occurrence": lambda: (
            events()
            .where("kind = 'A'")
            .selectExpr(
                "id AS procedure_occurrence_id",
                "person_id",
                "site",
                "concept_id AS procedure_concept_id",
                "concept_name AS procedure_concept_name",
                "event_date AS procedure_date",
                "source_value AS procedure_source_value",
                "age_in_months AS procedure_age_in_months",
            )
        ),
        "drug_exposure": lambda: (
            events().where("kind = 'N'").selectExpr("person_id", "concept_id AS drug_concept_id")
        ),
        "provider": lambda: read(spark, sf_dir, "supplier").selectExpr(
            "s_suppkey AS provider_id", "CAST(s_nationkey AS BIGINT) AS specialty_concept_id"
        ),
        "care_site": lambda: read(spark, sf_dir, "nation").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS care_site_id",
            "CAST(n_nationkey AS BIGINT) AS specialty_concept_id",
        ),
    }
    return Cdm(lambda name: conform(tables[name](), name))


def codes(spark: SparkSession, sf_dir: str) -> StudyCodes:
    nations = {
        "nephrology": "n_regionkey = 0",
        "rheumatology_nephrology": "n_regionkey IN (0, 1)",
    }
    parts = {
        "biopsy": "p_brand IN ('Brand#1', 'Brand#2')",
        "biopsy_guidance": "p_brand IN ('Brand#3', 'Brand#4', 'Brand#5')",
        "transplant_procedures": "p_brand = 'Brand#10'",
        "transplant_broad": "p_brand IN ('Brand#10', 'Brand#11')",
        "sle_included": _IS_SLE,
        "sle_excluded": "p_brand = 'Brand#25' AND p_size >= 25",
        "sle_drugs": "p_type = 'ECONOMY'",
        "sle_biopsy": "p_brand IN ('Brand#1', 'Brand#2')",
        "sle_biopsy_guidance": "p_brand = 'Brand#3'",
    }
    literals = {
        "in_person": (1, 2, 3),
        "in_person_expanded": (1, 2, 3, 4),
        "transplant_source": (11, 22, 33),
    }

    def open_list(name: str) -> Codes:
        if name == "disease":
            return disease_list(spark, sf_dir)
        if name in literals:
            return literals[name]
        if name in nations:
            return (
                read(spark, sf_dir, "nation")
                .where(nations[name])
                .selectExpr("CAST(n_nationkey AS BIGINT) AS concept_id")
            )
        return read(spark, sf_dir, "part").where(parts[name]).selectExpr("p_partkey AS concept_id")

    return StudyCodes(open_list)


def disease_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "part")
        .where("p_size <= 15")
        .selectExpr(
            "p_partkey AS concept_id",
            "p_name || ' ' || p_type AS concept_name",
            "p_size || '.' || p_partkey % 100 AS concept_code",
            "p_brand AS vocabulary_id",
            "CASE p_size % 3 WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 3 END AS codeset_category_code",
            "CASE p_size % 3 WHEN 1 THEN 'nephrotic' WHEN 0 THEN 'nephritic' ELSE 'broad' END"
            " AS codeset_category_name",
            "CAST(p_size BETWEEN 1 AND 5 AS INT) AS other_code_req",
            "CAST(p_size IN (6, 12) AS INT) AS neph_req",
        )
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as visits without provider, with the customer's site and birth date."""
    customer = read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS o_custkey", "c_mktsegment AS site", f"{_BIRTH_DATE} AS birth_date"
    )
    return (
        read(spark, sf_dir, "orders")
        .join(customer, "o_custkey")
        .selectExpr(
            "o_orderkey AS visit_occurrence_id",
            "o_custkey AS person_id",
            "site",
            "CAST(o_orderdate AS DATE) AS visit_start_date",
            "CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS visit_concept_id",
            "o_orderpriority AS visit_concept_name",
            "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey % 25 END AS care_site_id",
            "birth_date",
        )
    )


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as visits; the smallest supplier among the line items is the provider."""
    provider = (
        read(spark, sf_dir, "lineitem")
        .selectExpr("l_orderkey AS visit_occurrence_id", "l_suppkey AS provider_id")
        .groupBy("visit_occurrence_id")
        .agg({"provider_id": "min"})
        .withColumnRenamed("min(provider_id)", "provider_id")
    )
    return (
        _orders(spark, sf_dir)
        .join(provider, "visit_occurrence_id", "left")
        .select(
            "visit_occurrence_id",
            "person_id",
            "site",
            "visit_start_date",
            "visit_concept_id",
            "visit_concept_name",
            "provider_id",
            "care_site_id",
            "birth_date",
        )
    )


def _events(spark: SparkSession, sf_dir: str, visits: DataFrame) -> DataFrame:
    """Every line item as an event of the visit's person.

    Order and line number alone don't identify a line item here, so its id is made of part and supplier
    too. Two line items that agree in all four share an id.
    """
    lines = read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey",
        "l_linenumber",
        "l_partkey AS p_partkey",
        "l_suppkey",
        "l_returnflag AS kind",
        "CAST(l_shipdate AS DATE) AS event_date",
    )
    persons = visits.selectExpr("visit_occurrence_id AS o_orderkey", "person_id", "site", "birth_date")
    return (
        lines.join(persons, "o_orderkey")
        .join(read(spark, sf_dir, "part"), "p_partkey")
        .selectExpr(
            f"{_LINE_ID} AS id",
            "person_id",
            "site",
            "o_orderkey AS visit_occurrence_id",
            "p_partkey AS concept_id",
            "p_name || ' ' || p_type AS concept_name",
            "CAST(l_linenumber AS BIGINT) AS type_concept_id",
            "event_date",
            "p_brand || ' ' || p_name AS source_value",
            "p_partkey % 97 AS source_concept_id",
            "p_brand AS source_concept_name",
            "CAST(floor(datediff(event_date, birth_date) / 30.4375D) AS DOUBLE) AS age_in_months",
            "kind",
        )
    )
