from cohortry.functions.codes import (
    Codes,
    Marked,
    flag_codes,
    flagged,
    in_any_codes,
    in_codes,
    mark_codes,
    marks,
)
from cohortry.functions.dates import days_between, is_middle_date, within
from cohortry.functions.persons import add_site, join_persons, of_persons, without_persons
from cohortry.functions.skew import own_shuffle
from cohortry.functions.text import mentions

__all__ = [
    "Codes",
    "Marked",
    "add_site",
    "days_between",
    "flag_codes",
    "flagged",
    "in_any_codes",
    "in_codes",
    "is_middle_date",
    "join_persons",
    "mark_codes",
    "marks",
    "mentions",
    "of_persons",
    "own_shuffle",
    "within",
    "without_persons",
]
