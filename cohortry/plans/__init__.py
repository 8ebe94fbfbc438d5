from cohortry.plans.transplant_study import (
    StudyCodes,
    StudyParameters,
    TransplantStudy,
    run_study,
)

__all__ = ["StudyCodes", "StudyParameters", "TransplantStudy", "run_study"]
