"""Visits, or other events, at a provider or care site of a listed specialty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions import Codes, in_codes, of_persons, own_shuffle
from cohortry.sources.results import Keep, keep_aside

_VISIT_SPECIALTY = [
    "person_id",
    "site",
    "visit_occurrence_id",
    "visit_start_date",
    "specialty_concept_id",
    "spec_flag",
    "visit_concept_id",
]


def at_specialty(
    rows: DataFrame, provider: DataFrame, care_site: DataFrame, specialties: Codes
) -> DataFrame:
    """Rows whose provider or care site has a listed specialty, each as often as given.

    One pass over ``rows``. The two look-ups are outer joins rather than EXISTS
    tests because Spark splits a hot key (or the many null ids) only in the former.
    """
    by_provider = _listed_ids(provider, "provider_id", specialties)
    by_care_site = _listed_ids(care_site, "care_site_id", specialties)
    return (
        rows.join(by_provider.withColumn("_at_provider", F.lit(True)), "provider_id", "left")
        .join(by_care_site.withColumn("_at_care_site", F.lit(True)), "care_site_id", "left")
        .where(F.col("_at_provider") | F.col("_at_care_site"))
        .select(*rows.columns)
    )


def specialty_events(
    rows: DataFrame, provider: DataFrame, care_site: DataFrame, specialties: Codes
) -> DataFrame:
    """Distinct rows whose provider or care site has a listed specialty."""
    return at_specialty(rows, provider, care_site, specialties).distinct()


def visits_with_specialty(
    visits: DataFrame, cohort: DataFrame, provider: DataFrame, care_site: DataFrame
) -> DataFrame:
    """One row per visit of the cohort, specialty, and origin of that specialty.

    ``spec_flag`` tells the origin: "provider" or "care_site".
    """
    return (
        _specialty_origins(of_persons(visits, cohort), provider, care_site)
        .select(*_VISIT_SPECIALTY)
        .distinct()
    )


def visit_table_specialty(
    visits: DataFrame, cohort: DataFrame, provider: DataFrame, care_site: DataFrame
) -> DataFrame:
    """As :func:`visits_with_specialty`, carrying the name of the visit type too."""
    return (
        _specialty_origins(of_persons(visits, cohort), provider, care_site)
        .select(*_VISIT_SPECIALTY, "visit_concept_name")
        .distinct()
    )


def eligible_visits(
    visits: DataFrame,
    cohort: DataFrame,
    provider: DataFrame,
    care_site: DataFrame,
    specialties: Codes,
    visit_types: Codes,
    *,
    min_visits: int = 2,
    keep: Keep = keep_aside,
) -> DataFrame:
    """Cohort visits of a listed type and specialty, for persons with enough of them.

    Adds ``n_visits``, the person's distinct visits. The visits found are stored by ``keep`` before they
    are counted, so that visits are read and looked up once.
    """
    found = (
        _specialty_origins(
            of_persons(in_codes(visits, "visit_concept_id", visit_types), cohort),
            in_codes(provider, "specialty_concept_id", specialties),
            in_codes(care_site, "specialty_concept_id", specialties),
        )
        .select(
            "person_id",
            "site",
            "visit_occurrence_id",
            "specialty_concept_id",
            "spec_flag",
            "visit_concept_id",
        )
        .distinct()
    )
    return _with_visit_count(keep(found, "eligible_visits"), min_visits)


def population_eligible_visits(
    visits: DataFrame,
    provider: DataFrame,
    care_site: DataFrame,
    specialties: Codes,
    visit_types: Codes,
    *,
    min_visits: int = 2,
    keep: Keep = keep_aside,
) -> DataFrame:
    """All visits of a listed type and specialty, for persons with enough of them.

    One row per visit and origin; keeps the provider and care site ids. Stored as in
    :func:`eligible_visits`.
    """
    columns = [
        "person_id",
        "visit_start_date",
        "visit_occurrence_id",
        "visit_concept_id",
        "provider_id",
        "care_site_id",
        "spec_flag",
    ]
    found = (
        _specialty_origins(
            in_codes(visits, "visit_concept_id", visit_types),
            in_codes(provider, "specialty_concept_id", specialties),
            in_codes(care_site, "specialty_concept_id", specialties),
        )
        .select(*columns, "specialty_concept_id")
        .distinct()
        .select(*columns)
    )
    return _with_visit_count(keep(found, "population_eligible_visits"), min_visits)


def persons_with_eligible_visits(
    visits: DataFrame,
    provider: DataFrame,
    care_site: DataFrame,
    specialties: Codes,
    visit_types: Codes,
    *,
    min_visits: int = 2,
) -> DataFrame:
    """Persons with enough visits of a listed type and specialty, with ``n_visits``."""
    found = at_specialty(
        in_codes(visits, "visit_concept_id", visit_types), provider, care_site, specialties
    )
    return _visit_counts(found, min_visits)


def _listed_ids(table: DataFrame, id_column: str, specialties: Codes) -> DataFrame:
    listed = (
        in_codes(table, "specialty_concept_id", specialties)
        .where(F.col(id_column).isNotNull())
        .select(id_column)
        .distinct()
    )
    return own_shuffle(listed, id_column)


def _specialty_origins(visits: DataFrame, provider: DataFrame, care_site: DataFrame) -> DataFrame:
    """``visits`` once per specialty found through the provider and the care site.

    Both look-ups attach to the same pass over the visits; the matches are then
    unfolded, instead of reading the visits once per origin.
    """

    def lookup(table: DataFrame, id_column: str, origin: str) -> DataFrame:
        return table.where(F.col(id_column).isNotNull()).select(
            id_column,
            F.struct("specialty_concept_id", F.lit(origin).alias("spec_flag")).alias(f"_{origin}"),
        )

    return (
        visits.join(lookup(provider, "provider_id", "provider"), "provider_id", "left")
        .join(lookup(care_site, "care_site_id", "care_site"), "care_site_id", "left")
        .withColumn("_origins", F.array_compact(F.array("_provider", "_care_site")))
        .select(*visits.columns, F.inline("_origins"))
    )


def _visit_counts(rows: DataFrame, min_visits: int) -> DataFrame:
    return (
        rows.groupBy("person_id")
        .agg(F.countDistinct("visit_occurrence_id").alias("n_visits"))
        .where(F.col("n_visits") >= min_visits)
    )


def _with_visit_count(rows: DataFrame, min_visits: int) -> DataFrame:
    counts = own_shuffle(_visit_counts(rows, min_visits), "person_id")
    return rows.join(counts, "person_id").select(*rows.columns, "n_visits")
