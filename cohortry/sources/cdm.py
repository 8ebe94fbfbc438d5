"""The clinical tables a study reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortry.sources.lazy import OpenedOnUse
from cohortry.sources.schema import CDM_COLUMNS, conform


class Cdm(OpenedOnUse[DataFrame]):
    """Clinical tables, each opened when first used."""

    person: DataFrame
    visit_occurrence: DataFrame
    condition_occurrence: DataFrame
    procedure_occurrence: DataFrame
    drug_exposure: DataFrame
    provider: DataFrame
    care_site: DataFrame

    @classmethod
    def of(cls, **tables: DataFrame) -> Cdm:
        """Tables given as DataFrames."""
        return cls(lambda name: conform(tables[name], name))

    def replacing(self, **tables: DataFrame) -> Cdm:
        """The same tables but for the given ones."""
        return Cdm(lambda name: tables[name] if name in tables else getattr(self, name))

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str, fmt: str = "parquet") -> Cdm:
        """One sub-folder or file set per table, ``<folder>/<table>``."""
        root = folder.rstrip("/")
        return cls(lambda name: conform(spark.read.format(fmt).load(f"{root}/{name}"), name))

    @classmethod
    def from_database(cls, spark: SparkSession, database: str) -> Cdm:
        """Tables of a catalog database."""
        return cls(lambda name: conform(spark.table(f"{database}.{name}"), name))


assert set(Cdm.__annotations__) == set(CDM_COLUMNS)
