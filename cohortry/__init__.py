"""Clinical cohort selection as Spark DataFrame operators.

``sources``    CDM tables, code lists, result tables, the shared work folder
``functions``  column and join building blocks
``operators``  the cohort operators, each a function ``DataFrame... -> DataFrame``
``plans``      the kidney transplant study composed from the operators
"""
