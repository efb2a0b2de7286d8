"""Cutting lineage through the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors reach.

    A local one is made only where the setting is absent and driver and executors are one process; on a cluster the
    absence is an error, for files written to each executor's own disk are lost with it.
    """
    sc = spark.sparkContext
    named = spark.conf.get(_KEY, None) or sc.getConf().get(_KEY, None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"set {_KEY} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="strataline-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def _scratch(spark: SparkSession) -> str:
    """A folder for the staged tables of this application, removed when it ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/staged-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from there.

    Executors can be lost afterwards without recomputing what lies before. Readers take only the columns they need, and
    the planner knows the size.
    """
    path = f"{_scratch(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "lz4").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_partitioned(df: DataFrame) -> DataFrame:
    """As :func:`stage` by a checkpoint, which keeps the partitioning, so that joins on it need no shuffle."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
