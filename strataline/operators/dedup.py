"""Exact duplicates, keyed states and deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Adds ``representative`` (the least ``order`` of the key) and ``is_kept``; null keys are kept and stand alone.

    The least order per key combines before the shuffle, and only (key, order) travels with it.
    """
    keyed = df.withColumn("_key", key)
    first = keyed.where("_key is not null").groupBy("_key").agg(F.min(order).alias("representative"))
    return keyed.join(first, "_key", "left").withColumn("representative", F.coalesce("representative", F.col(order))).withColumn("is_kept", F.col("representative") == F.col(order)).drop("_key")


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, that of the greatest ``order``; equal orders fall to the greatest row."""
    rest = [c for c in df.columns if c not in (key, order)]
    best = df.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_s"))
    return best.select(key, F.col(f"_s.{order}").alias(order), *[F.col(f"_s.{c}").alias(c) for c in rest])


def priority_union(frames: list[DataFrame], key: str) -> DataFrame:
    """The rows of several frames, one per key; a later frame overrides an earlier one."""
    tagged = [f.withColumn("_rank", F.lit(k)) for k, f in enumerate(frames)]
    all_ = tagged[0]
    for f in tagged[1:]:
        all_ = all_.unionByName(f, allowMissingColumns=True)
    return last_wins(all_, key, "_rank").drop("_rank")


def delta(new: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with an unknown key, rows with a known key)."""
    keys = known.select(key).distinct()
    return new.join(keys, key, "left_anti"), new.join(keys, key, "left_semi")


def append_distinct(known: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``known`` and the rows of ``new`` whose key it lacks, each key once."""
    fresh, _ = delta(new, known, key)
    return known.unionByName(fresh.dropDuplicates([key]))


def upsert_status(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, status): new, changed, unchanged or missing after replacing ``old`` by ``new``."""
    a = old.select(key, F.col(value).alias("_old"), F.lit(True).alias("_a"))
    b = new.select(key, F.col(value).alias("_new"), F.lit(True).alias("_b"))
    return a.join(b, key, "full_outer").select(
        key,
        F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "missing").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("changed").alias("status"),
    )


def full_cover(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has; empty if both cover the same keys."""
    a, b = left.select(key).distinct().withColumn("in_left", F.lit(1)), right.select(key).distinct().withColumn("in_right", F.lit(1))
    return a.join(b, key, "full_outer").where("in_left is null or in_right is null").select(key, F.col("in_left").isNotNull().alias("in_left"))


def first_success(df: DataFrame, partition: list[str], order: list[Column], ok: Column) -> DataFrame:
    """The first row of each partition, in order, that satisfies ``ok``."""
    ranked = df.where(ok).withColumn("_rn", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")
