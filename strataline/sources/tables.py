"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data set, columns and filters pushed down by the optimizer."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
