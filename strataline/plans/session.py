"""Session builder with the settings the operators were designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution; ``master`` stays unset on a cluster, where spark-submit names it."""
    builder = SparkSession.builder.appName("strataline")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
