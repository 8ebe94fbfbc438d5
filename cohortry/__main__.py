"""Run the study: ``spark-submit``-able, or ``python -m cohortry --help``."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from cohortry.plans import StudyCodes, run_study
from cohortry.session import configure
from cohortry.sources import Cdm, ResultStore, TableStore


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cohortry", description="Run the transplant study.")
    clinical = parser.add_mutually_exclusive_group(required=True)
    clinical.add_argument("--cdm", help="folder with one data set per clinical table")
    clinical.add_argument("--cdm-database", help="catalog database with the clinical tables")
    parser.add_argument("--cdm-format", default="parquet", help="file format below --cdm")
    parser.add_argument("--codesets", required=True, help="folder with the code list CSV files")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--results", help="folder for the result tables")
    target.add_argument("--results-database", help="catalog database for the result tables")
    parser.add_argument("--buckets", type=int, default=0, help="bucket result tables by person")
    options = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    spark = configure(SparkSession.builder.appName("cohortry").getOrCreate())
    if options.cdm:
        cdm = Cdm.from_folder(spark, options.cdm, options.cdm_format)
    else:
        cdm = Cdm.from_database(spark, options.cdm_database)
    if options.results:
        results = ResultStore(spark, options.results)
    else:
        results = TableStore(spark, options.results_database, options.buckets)
    codes = StudyCodes.from_folder(spark, options.codesets)
    run_study(cdm, codes, results).orderBy("step_no").show(truncate=False)


if __name__ == "__main__":
    main()
