"""Incremental forms: windows, deduplication within a watermark, and appends without repeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import append_distinct, delta


def windowed_counts(events: DataFrame, time: str, width: str, slide: str | None = None, late: str = "2 days", by: tuple[str, ...] = ()) -> DataFrame:
    """Counts per window and key of a stream or a table; rows later than ``late`` are left out of a stream."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    w = F.window("_t", width, slide) if slide else F.window("_t", width)
    return timed.groupBy(w.alias("window"), *by).agg(F.count(F.lit(1)).alias("n"))


def sessions(events: DataFrame, time: str, gap: str, by: str, late: str = "2 days") -> DataFrame:
    """Counts per session of a key."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return timed.groupBy(F.session_window("_t", gap).alias("session"), by).agg(F.count(F.lit(1)).alias("n"))


def first_arrivals(stream: DataFrame, key: str, time: str, late: str = "2 days") -> DataFrame:
    """Each key once within the watermark, so a replay of an overlapping window adds nothing."""
    return stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late).dropDuplicatesWithinWatermark([key]).drop("_t")


def append_new(target: str, key: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that appends the rows whose key the Parquet table ``target`` lacks.

    A batch that is replayed finds its own rows and adds nothing; an empty batch writes nothing.
    """

    def sink(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            fresh, _known = delta(fresh, spark.read.parquet(target), key)
        if not fresh.isEmpty():
            fresh.write.mode("append").parquet(target)

    return sink


def snapshot(deltas: list[DataFrame], key: str) -> DataFrame:
    """The union of deltas in order, each key from the first that holds it."""
    out = deltas[0].dropDuplicates([key])
    for d in deltas[1:]:
        out = append_distinct(out, d, key)
    return out
