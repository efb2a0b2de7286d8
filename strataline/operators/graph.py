"""Lineage and families: closures and components by iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.stage import stage


def ancestors(edges: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """(node, ancestor, depth) for every ancestor of the starts (all children by default), each at its least depth.

    ``edges`` has child and parent. Cycles end, for a pair found once is not followed again.
    """
    edges = stage(edges.select("child", "parent").where("child is not null and parent is not null").distinct())
    first = edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"))
    if starts is not None:
        first = first.join(starts.select(F.col(starts.columns[0]).alias("node")).distinct(), "node", "left_semi")
    frontier = stage(first.withColumn("depth", F.lit(1)))
    found = frontier
    while not frontier.isEmpty():
        step = frontier.join(edges, frontier.ancestor == edges.child).select("node", F.col("parent").alias("ancestor"), (F.col("depth") + 1).alias("depth")).distinct()
        frontier = stage(step.join(found.select("node", "ancestor"), ["node", "ancestor"], "left_anti"))
        found = found.unionByName(frontier)
    return found


def cyclic_nodes(edges: DataFrame) -> DataFrame:
    """Nodes that are their own ancestor."""
    return ancestors(edges).where("node = ancestor").select("node").distinct()


def would_cycle(edges: DataFrame, child: str, parent: str) -> bool:
    """Whether an edge from child to parent closes a cycle."""
    if child == parent:
        return True
    spark = edges.sparkSession
    start = spark.createDataFrame([(parent,)], "node string")
    return not ancestors(edges, start).where(F.col("ancestor") == child).isEmpty()


def families(memberships: DataFrame, member: str, group: str) -> DataFrame:
    """(member, family): the least member tied to it through shared groups, directly or through others.

    Labels run between members and groups, each time the least label of the neighbours; the label of a label
    is taken too, which halves the distance left. Members without a group stand alone.
    """
    links = stage(memberships.where(F.col(member).isNotNull() & F.col(group).isNotNull()).select(F.col(member).alias("m"), F.col(group).alias("g")).distinct())
    labels = stage(memberships.where(F.col(member).isNotNull()).select(F.col(member).alias("m")).distinct().withColumn("l", F.col("m")))
    while True:
        by_group = links.join(labels, "m").groupBy("g").agg(F.min("l").alias("l"))
        spread = links.join(by_group, "g").groupBy("m").agg(F.min("l").alias("n"))
        stepped = labels.join(spread, "m", "left").select("m", "l", F.least("l", F.coalesce("n", "l")).alias("n"))
        jump = labels.select(F.col("m").alias("n"), F.col("l").alias("far"))
        new = stage(stepped.join(jump, "n", "left").select("m", "l", F.least("n", F.coalesce("far", "n")).alias("n")))
        done = new.where("l <> n").isEmpty()
        labels = new.select("m", F.col("n").alias("l"))
        if done:
            return labels.select(F.col("m").alias(member), F.col("l").alias("family"))
