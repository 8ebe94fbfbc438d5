"""Cohort operators.

Conventions:

- Operators are lazy; none runs a job.
- A cohort argument counts each person once, however often it lists them.
- Groups are reduced before rows meet: per-person facts are aggregated first and
  only then joined, so a person with very many rows is split over all tasks that
  read them and arrives at a join as one row.
- Windows run only over rows already reduced to one per person and day, or one
  per person and site.
"""
