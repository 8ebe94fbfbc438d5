"""Columns the operators rely on, per clinical table; other columns pass through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CDM_COLUMNS: dict[str, dict[str, str]] = {
    "person": {
        "person_id": "bigint",
        "site": "string",
        "birth_date": "date",
    },
    "visit_occurrence": {
        "visit_occurrence_id": "bigint",
        "person_id": "bigint",
        "site": "string",
        "visit_start_date": "date",
        "visit_concept_id": "bigint",
        "visit_concept_name": "string",
        "provider_id": "bigint",
        "care_site_id": "bigint",
    },
    "condition_occurrence": {
        "condition_occurrence_id": "bigint",
        "person_id": "bigint",
        "site": "string",
        "visit_occurrence_id": "bigint",
        "condition_concept_id": "bigint",
        "condition_concept_name": "string",
        "condition_type_concept_id": "bigint",
        "condition_start_date": "date",
        "condition_source_value": "string",
        "condition_source_concept_id": "bigint",
        "condition_source_concept_name": "string",
        "condition_start_age_in_months": "double",
    },
    "procedure_occurrence": {
        "procedure_occurrence_id": "bigint",
        "person_id": "bigint",
        "site": "string",
        "procedure_concept_id": "bigint",
        "procedure_concept_name": "string",
        "procedure_date": "date",
        "procedure_source_value": "string",
        "procedure_age_in_months": "double",
    },
    "drug_exposure": {
        "person_id": "bigint",
        "drug_concept_id": "bigint",
    },
    "provider": {
        "provider_id": "bigint",
        "specialty_concept_id": "bigint",
    },
    "care_site": {
        "care_site_id": "bigint",
        "specialty_concept_id": "bigint",
    },
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast the known columns of a clinical table; raise if one is missing."""
    wanted = CDM_COLUMNS[table]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"table {table!r} lacks column(s) {', '.join(missing)}")
    return df.select(
        *(F.col(c).cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns)
    )
