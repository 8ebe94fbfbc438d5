"""Fixed values of the study: dates, ages and literal concept ids."""

from __future__ import annotations

import datetime as dt

# The study window, both days included.
WINDOW_START = dt.date(2009, 1, 1)
WINDOW_END = dt.date(2021, 1, 1)

# Fixed value: age bound in years, exclusive.
AGE_BOUND_YEARS = 30

# Fixed value: mean length of a year in days, for ages counted in days.
DAYS_PER_YEAR = 365.25

# Diagnoses that count only next to a more specific one.
OTHER_CODE_REQUIRED = (261071,)

# Diagnoses that count only when made at a nephrology visit.
NEPHROLOGY_REQUIRED = (435308, 259070)

# Kidney biopsy procedures.
#   2109566   renal biopsy, percutaneous, by trocar or needle
#   2003588   closed percutaneous needle biopsy of kidney
#   35608187  closed renal biopsy
#   36717689  evaluation of kidney biopsy specimen
KIDNEY_BIOPSY = (2109566, 2003588, 35608187, 36717689)

# Procedures that are a kidney biopsy only if their source text says so.
#   2211783   ultrasonic guidance for needle placement
GUIDED_BIOPSY = (2211783,)

# Patterns searched in the lower-case source text of a guided biopsy.
# They are regular expressions, in which a dot stands for any character.
KIDNEY_TEXT = ("renal", "kidney")
KIDNEY_TEXT_OR_CODE = ("kidney", "renal", "50200", "50205", "55.23", "55.24")
NOT_KIDNEY_TEXT = ("adrenal",)

# Source concepts that record a kidney transplant.
TRANSPLANT_SOURCE_CONCEPTS = (44821546, 35225404, 45595522)
