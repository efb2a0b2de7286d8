"""Mixtures of intact samples under quotas: ranks and running totals without gathering a group, greedy choice, redistribution, verification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stage import stage

#: Stretches of the hash order that a group is laid on; each is small enough to be summed in one task.
STRETCHES = 4096


def in_hash_order(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Adds ``_order``, the SHA-256 of the key (with the seed, unless it is 0), and ``_stretch``, its leading 12 bits."""
    named = F.col(key).cast("string") if not seed else F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))
    rows = df.withColumn("_order", F.sha2(named, 256))
    return rows.withColumn("_stretch", F.conv(F.substring("_order", 1, 3), 16, 10).cast("int"))


def running_totals(ordered: DataFrame, group: str, size: str) -> DataFrame:
    """Adds ``_before`` (the sizes before a row in its group) and ``_rank`` (its place, from 1) to rows in hash order.

    Sizes are summed by stretch first, and only these sums, at most STRETCHES a group, are windowed over the group; rows
    are windowed within their stretch. Groups are compared null-safe by their text; ties of the order cannot be.
    """
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = ordered.withColumn("_group", g)
    sums = rows.groupBy("_group", "_stretch").agg(F.sum(size).alias("_s"), F.count(F.lit(1)).alias("_n"))
    over = Window.partitionBy("_group").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_group", "_stretch", F.coalesce(F.sum("_s").over(over), F.lit(0)).alias("_s0"), F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_n0"))
    inside = Window.partitionBy("_group", "_stretch").orderBy("_order")
    counted = rows.withColumn("_sum", F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_place", F.row_number().over(inside))
    met = counted.join(bases, ["_group", "_stretch"])
    return met.withColumn("_before", F.col("_s0") + F.col("_sum") - F.col(size)).withColumn("_rank", (F.col("_n0") + F.col("_place")).cast("bigint")).drop("_s0", "_n0", "_sum", "_place", "_group")


def quota_select(df: DataFrame, quotas: DataFrame, group: str, key: str) -> DataFrame:
    """The first ``quota`` rows of each group in hash order, with their ``rank``; groups without a quota give none."""
    ranked = running_totals(in_hash_order(df, key).withColumn("_one", F.lit(1)), group, "_one").withColumn("rank", F.col("_rank"))
    return ranked.join(F.broadcast(quotas), group).where("rank <= quota").drop("_order", "_stretch", "_one", "_before", "_rank")


def _greedy(rows: DataFrame, quotas: DataFrame, group: str, key: str, size: str) -> DataFrame:
    """(key) of the rows that a walk in hash order takes, each if it still fits the quota of its group.

    Each round takes the rows before the first that does not fit, at once; the walk then goes on behind it with the room
    left, in which ever fewer rows fit.
    """
    left = stage(rows.select(key, group, size, "_order", "_stretch").join(quotas.select(group, F.col("quota").alias("_room")), group).where(F.col(size) <= F.col("_room")))
    taken = None
    while not left.isEmpty():
        summed = stage(running_totals(left, group, size))
        stop = summed.where(F.col("_before") + F.col(size) > F.col("_room")).groupBy(group).agg(F.min("_order").alias("_stop"))
        met = stage(summed.join(stop, group, "left"))
        now = met.where(F.col("_stop").isNull() | (F.col("_order") < F.col("_stop")))
        taken = now.select(key) if taken is None else taken.unionByName(now.select(key))
        room = now.groupBy(group).agg(F.sum(size).alias("_used"))
        later = met.where(F.col("_order") > F.col("_stop")).join(room, group, "left").withColumn("_room", F.col("_room") - F.coalesce("_used", F.lit(0)))
        left = stage(later.where(F.col(size) <= F.col("_room")).select(key, group, size, "_order", "_stretch", "_room"))
    return taken if taken is not None else rows.select(key).limit(0)


def mix(records: DataFrame, quotas: DataFrame, group: str, key: str, size: str, *, family: str | None = None, cap: int | None = None, redistribute: bool = False, seed: int = 0) -> DataFrame:
    """Records of a mixture with ``chosen`` (quota or redistributed): intact, without replacement, greedy in hash order.

    A record that is too large for the room left is skipped. With ``cap`` only the first records of a family, in hash
    order over all groups, are eligible. ``redistribute`` fills what is left of the whole budget from the rest of all
    groups that have a quota. Keys must be distinct; rows with a null key, group or size, or a size below 1, are left out.
    """
    usable = records.where(F.col(key).isNotNull() & F.col(group).isNotNull() & (F.col(size) > 0))
    rows = in_hash_order(usable, key, seed)
    if family is not None and cap is not None:
        alone = F.coalesce(F.col(family).cast("string"), F.concat(F.lit("\\x00"), F.col(key).cast("string")))  # a record without family is one by itself
        rows = running_totals(rows.withColumn("_family", alone).withColumn("_one", F.lit(1)), "_family", "_one").where(F.col("_rank") <= cap).drop("_family", "_one", "_before", "_rank")
    rows = stage(rows)
    first = stage(_greedy(rows, quotas, group, key, size).withColumn("chosen", F.lit("quota")))
    if redistribute:
        budget = quotas.agg(F.sum("quota")).first()[0] or 0
        used = rows.join(first, key).agg(F.sum(size)).first()[0] or 0
        rest = rows.join(first, key, "left_anti").join(F.broadcast(quotas.where("quota > 0").select(group)), group, "left_semi").withColumn("_all", F.lit("all"))
        room = rows.sparkSession.createDataFrame([("all", int(budget - used))], "_all string, quota long")
        first = first.unionByName(_greedy(rest, room, "_all", key, size).withColumn("chosen", F.lit("redistributed")))
    return usable.join(first, key)


def mixture_report(records: DataFrame, chosen: DataFrame, quotas: DataFrame, group: str, size: str) -> DataFrame:
    """(group, quota, available, selected, fraction, shortfall) of a mixture."""
    held = records.where(F.col(size) > 0).groupBy(group).agg(F.sum(size).alias("available"))
    used = chosen.groupBy(group).agg(F.sum(size).alias("selected"))
    rows = quotas.select(group, "quota").join(held, group, "left").join(used, group, "left").na.fill(0, ["available", "selected"])
    share = F.col("selected") / F.nullif(F.sum("selected").over(Window.partitionBy()), F.lit(0))  # one row per group
    return rows.select(group, "quota", "available", "selected", F.round(F.coalesce(share, F.lit(0.0)), 6).alias("fraction"), F.greatest(F.col("quota") - F.col("selected"), F.lit(0)).alias("shortfall"))


def mixture_faults(records: DataFrame, chosen: DataFrame, quotas: DataFrame, group: str, key: str, size: str, family: str | None = None, cap: int | None = None) -> DataFrame:
    """(fault, subject) of a mixture that breaks its recipe: unknown or repeated records, groups over the budget, families over the cap."""
    text = lambda c: F.col(c).cast("string").alias("subject")
    out = chosen.join(records.select(key), key, "left_anti").select(F.lit("unknown_record").alias("fault"), text(key))
    out = out.unionByName(chosen.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("repeated_record").alias("fault"), text(key)))
    total = quotas.agg(F.sum("quota").alias("q")).crossJoin(chosen.agg(F.coalesce(F.sum(size), F.lit(0)).alias("s")))  # one row each
    out = out.unionByName(total.where("s > q").select(F.lit("over_budget").alias("fault"), F.col("s").cast("string").alias("subject")))
    own = chosen.where("chosen = 'quota'").groupBy(group).agg(F.sum(size).alias("s")).join(quotas, group, "left")
    out = out.unionByName(own.where("quota is null or s > quota").select(F.lit("over_quota").alias("fault"), text(group)))
    if family is not None and cap is not None:
        out = out.unionByName(chosen.where(F.col(family).isNotNull()).groupBy(family).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap).select(F.lit("over_cap").alias("fault"), text(family)))
    return out
