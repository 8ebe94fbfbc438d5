"""Rules on how far apart a person's visits or diagnoses lie."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.defaults import WINDOW_END, WINDOW_START
from cohortry.functions import (
    Codes,
    days_between,
    in_codes,
    is_middle_date,
    of_persons,
    own_shuffle,
    within,
)
from cohortry.operators.specialty import at_specialty
from cohortry.sources.results import Keep, keep_aside


def spaced_specialty_visits(
    visits: DataFrame,
    provider: DataFrame,
    care_site: DataFrame,
    specialties: Codes,
    visit_types: Codes,
    *,
    first_day: dt.date = WINDOW_START,
    last_day: dt.date = WINDOW_END,
    min_visits: int = 3,
    gap_days: int = 7,
    keep: Keep = keep_aside,
) -> DataFrame:
    """Specialty visits of persons who were seen often and spaced out enough.

    A person qualifies with at least ``min_visits`` distinct visit dates, one of
    which is neither the first nor the last and at least ``gap_days`` from both;
    dates beyond the third need no spacing of their own. Returns all columns of
    the person's visits in the window, of a listed type, at a listed specialty,
    and ``distinct_dates``. Rows come in no order; a result table is sorted where it is written.
    The specialty visits of the window are stored by ``keep``, so that visits are read and looked up once.
    """
    in_window = in_codes(
        visits.where(within("visit_start_date", first_day, last_day)),
        "visit_concept_id",
        visit_types,
    )
    found = keep(at_specialty(in_window, provider, care_site, specialties), "specialty_visits")
    return spaced_visits(found, min_visits=min_visits, gap_days=gap_days)


def spaced_visits(visits: DataFrame, *, min_visits: int = 3, gap_days: int = 7) -> DataFrame:
    """:func:`spaced_specialty_visits` on visits known to be in the window, of type and specialty.

    Reads ``visits`` twice, so they are better stored. A person's days are gathered as a set, which is no
    longer than the calendar, however many visits there are; the rule is then put to the set.
    """
    days = visits.groupBy("person_id").agg(F.array_sort(F.collect_set("visit_start_date")).alias("_days"))
    days = days.where(F.size("_days") >= min_visits)
    days = days.withColumns({"_first": F.get("_days", F.lit(0)), "_last": F.element_at("_days", -1)})

    def is_middle(day: Column) -> Column:
        return (F.datediff(day, "_first") >= gap) & (F.datediff("_last", day) >= gap)

    gap = max(gap_days, 1)  # neither the first nor the last day
    seen = days.where(F.exists("_days", is_middle))
    seen = own_shuffle(seen.select("person_id", F.size("_days").cast("bigint").alias("distinct_dates")), "person_id")
    return visits.join(seen, "person_id").select(
        "person_id",
        "visit_occurrence_id",
        "distinct_dates",
        *(c for c in visits.columns if c not in ("person_id", "visit_occurrence_id")),
    )


def two_codes_spread(conditions: DataFrame, *, min_days: int = 60) -> DataFrame:
    """Distinct (person, site, date) where first and last date are far enough apart."""
    return (
        _date_spans(conditions, ["person_id", "site"], "condition_start_date")
        .where(days_between("first_date", "last_date") >= min_days)
        .select("person_id", "site", "condition_start_date")
    )


def three_codes_spaced(conditions: DataFrame, *, gap_days: int = 30) -> DataFrame:
    """Distinct (person, site, date) lying at least ``gap_days`` from first and last date.

    Having such a date means having three codes each that far apart.
    """
    return (
        _date_spans(conditions, ["person_id", "site"], "condition_start_date")
        .where(is_middle_date("condition_start_date", "first_date", "last_date", gap_days))
        .select("person_id", "site", "condition_start_date")
    )


def followup_at_least(visits: DataFrame, cohort: DataFrame, *, min_days: int = 60) -> DataFrame:
    """Cohort persons whose first and last visit, of any type, are far enough apart.

    Only the cohort's visits are aggregated.
    """
    return (
        of_persons(visits.select("person_id", "visit_start_date"), cohort)
        .groupBy("person_id")
        .agg(
            F.max("visit_start_date").alias("max_date"),
            F.min("visit_start_date").alias("min_date"),
        )
        .withColumn("days_sep", days_between("min_date", "max_date"))
        .where(F.col("days_sep") >= min_days)
    )


def _date_spans(rows: DataFrame, by: list[str], date: str) -> DataFrame:
    """One row per group and distinct date, with the group's first and last date and count.

    The window sees at most one row per calendar day of a group, however many rows
    the group has. It has no ordering: with one, first and last would be running values.
    """
    group = Window.partitionBy(*by)
    return (
        rows.select(*by, date)
        .distinct()
        .select(
            *by,
            date,
            F.min(date).over(group).alias("first_date"),
            F.max(date).over(group).alias("last_date"),
            F.count(date).over(group).alias("distinct_dates"),
        )
    )
