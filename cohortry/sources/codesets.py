"""Code lists: small CSV files naming the concepts a definition is made of."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns with a fixed type wherever they occur; every other column stays text,
# so that codes such as "55.23" keep their spelling.
_KNOWN_TYPES = {
    "concept_id": "bigint",
    "codeset_category_code": "int",
    "other_code_req": "int",
    "neph_req": "int",
    "kidney_related": "int",
    "sle": "int",
}

# Letters of a compact column type string.
_LETTER_TYPES = {
    "c": "string",
    "i": "int",
    "d": "double",
    "n": "double",
    "l": "boolean",
    "D": "date",
    "T": "timestamp",
    "t": "string",
}
_GUESS, _SKIP = "?", "_-"
#: Unreadable cells that an error names.
_SHOWN = 5


def load_codeset(
    spark: SparkSession,
    folder: str,
    name: str,
    col_types: str | None = None,
    *,
    allow_unreadable: bool = False,
) -> DataFrame:
    """Read ``<folder>/<name>.csv`` with a header line.

    All columns are read as text and cast **by name**: files order their columns
    differently, and a schema given to the reader would be applied by position.
    ``col_types`` optionally gives one letter per column in file order (letters
    beyond the last column are ignored); ids are 64-bit in any case. ``_`` and ``-`` leave a
    column out, ``?`` gives it its usual type; a time of day stays text.

    A cell that can't be read as its column's type would be null, match nothing and shrink the list
    without a word; so it is an error that names such cells, unless ``allow_unreadable``.
    :func:`unreadable_cells` lists them all.
    """
    raw, types = _opened(spark, folder, name, col_types)
    if not allow_unreadable:
        found = _unreadable(raw, types).limit(_SHOWN + 1).collect()
        if found:
            cells = ", ".join(f"{r['value']!r} in {r['column']}" for r in found[:_SHOWN])
            more = " and others" if len(found) > _SHOWN else ""
            raise ValueError(f"code list {name!r} has unreadable cells: {cells}{more}")
    return raw.select(*(F.col(f"`{c}`").try_cast(kind).alias(c) for c, kind in types.items()))


def unreadable_cells(
    spark: SparkSession, folder: str, name: str, col_types: str | None = None
) -> DataFrame:
    """``(concept, column, type, value)`` per cell of the list that can't be read as its column's type.

    ``concept`` is the row's concept id as it is written.
    """
    return _unreadable(*_opened(spark, folder, name, col_types))


def _unreadable(raw: DataFrame, types: dict[str, str]) -> DataFrame:
    cells = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(kind).alias("type"),
            F.col(f"`{column}`").alias("value"),
            F.col(f"`{column}`").try_cast(kind).isNull().alias("lost"),
        )
        for column, kind in types.items()
    ]
    rows = raw.select(F.col("concept_id").alias("concept"), F.inline(F.array(*cells)))
    return rows.where("value IS NOT NULL AND lost").drop("lost")


def _opened(
    spark: SparkSession, folder: str, name: str, col_types: str | None
) -> tuple[DataFrame, dict[str, str]]:
    """The list as text, and the type of each column that is wanted."""
    path = f"{folder.rstrip('/')}/{name}.csv"
    try:
        raw = spark.read.csv(path, header=True, quote='"', escape='"', encoding="UTF-8")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(
            f"code list {name!r} not found at {path}; code lists are supplied by the user"
        ) from e

    types = dict(_KNOWN_TYPES)
    skipped = set()
    for column, letter in zip(raw.columns, col_types or ""):
        if letter in _SKIP:
            skipped.add(column)
        elif letter == _GUESS:
            continue
        elif letter not in _LETTER_TYPES:
            raise ValueError(f"unknown column type letter {letter!r} in {col_types!r}")
        elif column != "concept_id":
            types[column] = _LETTER_TYPES[letter]
    if "concept_id" not in set(raw.columns) - skipped:
        raise ValueError(f"code list {name!r} has no concept_id column")
    return raw, {c: types.get(c, "string") for c in raw.columns if c not in skipped}


def codes_where(codeset: DataFrame, column: str, value: int = 1) -> DataFrame:
    """Concept ids of the list entries whose ``column`` equals ``value``."""
    return codeset.where(F.col(column) == value).select("concept_id")


def inline_codes(spark: SparkSession, ids: Iterable[int]) -> DataFrame:
    """A code list made of literal concept ids."""
    rows = ", ".join(f"({int(i)}L)" for i in ids)
    if not rows:
        return spark.sql("SELECT CAST(NULL AS BIGINT) AS concept_id WHERE false")
    return spark.sql(f"SELECT concept_id FROM VALUES {rows} AS codes(concept_id)")
