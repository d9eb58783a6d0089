"""Settings that the plans run well with. None of them changes a result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    # Split the partitions of hot keys even where the next step then needs a shuffle of its own.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile larger methods; wide selects are faster in several smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # One run has more generated classes than the cache keeps by default.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Skips looking up the call site of every column function while the plan is built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shuffle_partitions(df: DataFrame) -> int:
    """Partitions of a shuffle as the session has them, before adaptive execution joins small ones."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# Partitions, at least, of rows that a task sorts or holds several times over, or that grow in it.
SPREAD = 192


def spread_partitions(df: DataFrame) -> int:
    """Partitions to deal such rows to: a session with few shuffle partitions would fill each of its tasks."""
    return max(shuffle_partitions(df), SPREAD)
