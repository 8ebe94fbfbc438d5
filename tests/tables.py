"""Hand-written clinical tables: rows as keyword dicts, everything else defaulted."""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.sql import DataFrame, SparkSession

from cohortry.sources import Cdm
from cohortry.sources.schema import CDM_COLUMNS

DAY0 = dt.date(2015, 1, 1)

# Specialty 1 is listed; provider and care site 10 have it, 20 have another.
NEPHROLOGY = [1]
PROVIDERS = [
    {"provider_id": 10, "specialty_concept_id": 1},
    {"provider_id": 20, "specialty_concept_id": 2},
]
CARE_SITES = [
    {"care_site_id": 10, "specialty_concept_id": 1},
    {"care_site_id": 20, "specialty_concept_id": 2},
]

_DEFAULTS = {
    "person": {"site": "A", "birth_date": dt.date(2005, 1, 1)},
    "visit_occurrence": {
        "site": "A",
        "visit_start_date": DAY0,
        "visit_concept_id": 9202,
        "visit_concept_name": "Outpatient Visit",
        "provider_id": 10,
    },
    "condition_occurrence": {
        "site": "A",
        "condition_concept_id": 100,
        "condition_concept_name": "c",
        "condition_type_concept_id": 1,
        "condition_start_date": DAY0,
        "condition_source_value": "s",
        "condition_source_concept_id": 0,
        "condition_source_concept_name": "sc",
        "condition_start_age_in_months": 120.0,
    },
    "procedure_occurrence": {
        "site": "A",
        "procedure_concept_id": 500,
        "procedure_concept_name": "p",
        "procedure_date": DAY0,
        "procedure_source_value": "s",
        "procedure_age_in_months": 120.0,
    },
    "drug_exposure": {"drug_concept_id": 900},
    "provider": {},
    "care_site": {},
}


def day(n: int) -> dt.date:
    return DAY0 + dt.timedelta(days=n)


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    columns = CDM_COLUMNS[name]
    ids = itertools.count(1)
    own_id = f"{name}_id"
    filled = []
    for row in rows:
        assert set(row) <= set(columns), row
        full = {c: None for c in columns} | _DEFAULTS[name] | row
        if own_id in columns and full[own_id] is None:
            full[own_id] = next(ids)
        filled.append(tuple(full[c] for c in columns))
    return spark.createDataFrame(filled, ", ".join(f"{c} {t}" for c, t in columns.items()))


def cdm(spark: SparkSession, **rows: list[dict]) -> Cdm:
    rows = {"provider": PROVIDERS, "care_site": CARE_SITES} | rows
    return Cdm(lambda name: table(spark, name, rows.get(name, [])))


def persons(spark: SparkSession, *ids: int) -> DataFrame:
    return spark.createDataFrame([(i,) for i in ids], "person_id bigint")


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples of the given columns, or of all."""
    out = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in out.collect()), key=repr)


def ids_of(df: DataFrame, column: str = "person_id") -> list[int]:
    return sorted({r[0] for r in df.select(column).collect()})
