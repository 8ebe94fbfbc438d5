"""How many persons are left after each step."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cohorts that a mask of 64 bits has room for.
_BITS = 62


def counted(spark: SparkSession, persons: Mapping[str, int], *, start: str = "start") -> DataFrame:
    """The rows of :func:`attrition` for numbers known already."""
    rows = [(no, name, n) for no, (name, n) in enumerate({start: 0, **persons}.items())]
    return spark.createDataFrame(rows, "step_no int, cohort string, persons bigint").coalesce(1)


def attrition(cohorts: Mapping[str, DataFrame], *, start: str = "start") -> DataFrame:
    """One row (step_no, cohort, persons) per cohort, in order, after a seed row of 0.

    Each person gets a mask with a bit per cohort, so one row per person is shuffled, and not one per
    person and cohort; the bits are then counted. An empty cohort counts 0, a row without person nothing.
    """
    words = -(-len(cohorts) // _BITS)

    def masks(no: int) -> list[Column]:
        """A mask of as many words as it takes, with the cohort's bit set."""
        bits = (1 << no % _BITS if no // _BITS == word else 0 for word in range(words))
        return [F.lit(bit).cast("bigint").alias(f"_{word}") for word, bit in enumerate(bits)]

    tagged = reduce(
        DataFrame.union,
        (df.select("person_id", *masks(no)) for no, df in enumerate(cohorts.values())),
    )
    persons = (
        tagged.where("person_id IS NOT NULL")
        .groupBy("person_id")
        .agg(*(F.bit_or(f"_{word}").alias(f"_{word}") for word in range(words)))
    )
    has = (F.col(f"_{no // _BITS}").bitwiseAND(F.lit(1 << no % _BITS)) != 0 for no in range(len(cohorts)))
    counts = persons.agg(F.array(F.lit(0).cast("bigint"), *(F.count_if(bit) for bit in has)).alias("persons"))
    names = F.array(F.lit(start), *(F.lit(name) for name in cohorts))
    rows = counts.select(F.posexplode(F.arrays_zip(names.alias("cohort"), "persons")).alias("step_no", "row"))
    return rows.select("step_no", F.col("row.cohort").alias("cohort"), F.col("row.persons").alias("persons"))
