"""What several operators share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.sources.results import Workspace

#: Rows and bytes handed to Python at once; a longer row goes alone.
ROWS_PER_BATCH, BYTES_PER_BATCH = 1000, 8 << 20

_shipped: set[str] = set()


def prepared(spark: SparkSession) -> Workspace:
    """A folder for stored intermediates, in a session set up for long texts."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return Workspace(spark)


def _ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application; they needn't have it installed."""
    context = spark.sparkContext
    package = Path(__file__).parents[1]
    if context.applicationId in _shipped or not package.is_dir():
        return
    # Executors fetch the file from the driver when they first need it, so it stays until the end.
    folder = tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    own = Path(folder, "files", package.name)
    shutil.copytree(package, own, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", own.parent))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(text: str | Column) -> Column:
    """The text's bytes; a null text has none."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` with only the named columns under the operator's own names.

    Operators work on these, so columns of the caller cannot clash with theirs.
    """
    return df.select(*(F.col(_quoted(there)).alias(here) for here, there in columns.items()))


def _quoted(name: str) -> str:
    return "`" + re.sub("`", "``", name) + "`"


def fresh(name: str) -> str:
    """A column name that no caller uses."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"
