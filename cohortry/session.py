"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Spark decides per join, from measured sizes, whether a side is broadcast
# (autoBroadcastJoinThreshold); nothing in this package carries a broadcast hint.
# Every larger join is a shuffled one whose hot partitions Spark splits at run
# time. Forcing the split lets it happen also where a later step would have
# reused the join's partitioning and now needs its own shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session; all of them may change at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
