"""Date rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start: str | Column, end: str | Column) -> Column:
    """Whole days from ``start`` to ``end``."""
    return F.datediff(end, start)


def within(date: str, first: dt.date, last: dt.date) -> Column:
    """``date`` lies in the window, both ends included."""
    return F.col(date).between(F.lit(first), F.lit(last))


def is_middle_date(date: str, first: str, last: str, gap_days: int) -> Column:
    """``date`` is neither end and at least ``gap_days`` from both."""
    return (
        (F.col(date) != F.col(first))
        & (F.col(date) != F.col(last))
        & (days_between(first, date) >= gap_days)
        & (days_between(date, last) >= gap_days)
    )
