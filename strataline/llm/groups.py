"""Splits that keep related records together (problem 1).

Connected components come from a frontier breadth-first search. Adjacency lists lie hash-partitioned by their
node, those of hubs in several parts. Seeds are the nodes that no neighbour outranks by (degree, hash), so hubs
seed and every component has a seed; all seeds expand at once, WAVES steps far. A node reached by several seeds
takes the least label, one not reached seeds itself; edges whose ends carry different labels form the small graph
of seeds, which is searched the same way until no labels collide. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import latest, split_label
from ..plans.stage import stage, stage_partitioned

SPLITS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
RECORDED = ("train", "validation", "test")
#: Resolution of the component hash order.
BUCKETS = 4096
#: A component above this share of all cases is placed on its own; there can be at most 1/HEAVY of them.
HEAVY = 0.02
#: Steps a frontier goes before colliding labels are merged.
WAVES = 2
#: A part of an adjacency list holds about this many neighbours; a hub's list has as many parts as that takes.
PART = 100_000


def _adjacency(edges: DataFrame, part: int) -> tuple[DataFrame, DataFrame]:
    """(src, part, dst) in both directions, and (node, n, parts) with the degree of each node."""
    clean = edges.where("src is not null and dst is not null and src <> dst").select("src", "dst")
    both = clean.unionByName(clean.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    nodes = both.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    nodes = nodes.withColumn("parts", (F.col("n") / part).cast("int") + 1)
    placed = both.join(nodes.withColumnRenamed("node", "src"), "src").select("src", F.pmod(F.xxhash64("dst"), "parts").cast("int").alias("part"), "dst", "n")
    return stage_partitioned(placed.repartition("src", "part")), nodes


def _beside(nodes: DataFrame, lists: DataFrame) -> DataFrame:
    """Rows of ``nodes`` joined to their neighbours, part by part."""
    spread = nodes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumnRenamed("node", "src")
    return spread.join(lists, ["src", "part"])


def components(edges: DataFrame, part: int = PART) -> DataFrame:
    """(node, component) for every node with an edge; ``component`` is one of its nodes.

    Null ends and self-loops are dropped; repeated edges count once; no edges give no rows.
    """
    lists, nodes = _adjacency(edges, part)
    # The greatest rank among the neighbours combines before the shuffle, so a hub gathers no list.
    near = lists.groupBy(F.col("dst").alias("node")).agg(F.max(F.struct("n", F.xxhash64("src").alias("h"), F.col("src").alias("of"))).alias("near"))
    lists = lists.drop("n")
    own = F.struct("n", F.xxhash64("node").alias("h"), F.col("node").alias("of"))
    labels = stage(nodes.join(near, "node").select("node", "parts", F.when(own > F.col("near"), F.col("node")).alias("label"), F.lit(0).alias("wave")))
    for wave in range(1, WAVES + 1):
        front = labels.where((F.col("wave") == wave - 1) & F.col("label").isNotNull()).select("node", "parts", "label")
        reached = _beside(front, lists).groupBy(F.col("dst").alias("node")).agg(F.min("label").alias("found"))
        labels = stage(labels.join(reached, "node", "left").select(
            "node", "parts", F.coalesce("label", "found").alias("label"), F.when(F.col("label").isNull(), wave).otherwise(F.col("wave")).alias("wave")
        ))
    labels = labels.select("node", "parts", F.coalesce("label", "node").alias("label"))
    # A node's neighbours carry few labels; they are made distinct before they meet its own.
    beside = _beside(labels, lists).select(F.col("dst").alias("node"), F.col("label").alias("other")).distinct()
    collisions = stage(beside.join(labels, "node").where("label < other").select(F.col("label").alias("src"), F.col("other").alias("dst")).distinct())
    if collisions.isEmpty():
        return labels.select("node", F.col("label").alias("component"))
    merged = components(collisions, part).select(F.col("node").alias("label"), "component")
    return labels.join(merged, "label", "left").select("node", F.coalesce("component", "label").alias("component"))


def _none(col: Column) -> Column:
    clean = F.lower(F.trim(col))
    return F.when(clean.isin("", "unknown", "n/a"), None).otherwise(clean)


def work_of_group(col: Column) -> Column:
    """The work named by a source group, without case, outer spaces and the prefix ``work-``; null for none."""
    return _none(F.regexp_replace(_none(col), "^work-", ""))


def issuer(col: Column) -> Column:
    """The first six digits in a row of a stock code; null for none and for 000000."""
    code = F.regexp_extract(col, "([0-9]{6})", 1)
    return F.when(code.isin("", "000000"), None).otherwise(code)


def valid_cases(agent_cases: DataFrame) -> DataFrame:
    """The latest state of each case: case_id, split, work, snapshot, evidence_chunks."""
    rows = agent_cases.where("case_id is not null").select(
        "case_id",
        "updated_at",
        split_label(F.col("split")).alias("split"),
        work_of_group(F.col("grouping.source_group")).alias("work"),
        _none(F.col("grouping.base_snapshot_group")).alias("snapshot"),
        "evidence_chunks",
    )
    return latest(rows, "case_id", "updated_at")


def issuers_of_works(local_documents: DataFrame) -> DataFrame:
    """Distinct (work, issuer) over the latest state of each document."""
    states = latest(local_documents.where("document_uid is not null").select("document_uid", "updated_at", "work_uid", "stock_code"), "document_uid", "updated_at")
    return (
        states.select(F.lower(F.trim("work_uid")).alias("work"), issuer(F.col("stock_code")).alias("issuer"))
        .where("work is not null and issuer is not null")
        .distinct()
    )


def case_edges(cases: DataFrame, chunks: DataFrame, issuers: DataFrame) -> DataFrame:
    """(src, dst) from each case to its works and snapshot, and from each work to its issuers, also where no case has the work."""
    evidence = (
        cases.select("case_id", F.explode(F.array_distinct("evidence_chunks")).alias("chunk_version_uid"))
        .join(chunks.select("chunk_version_uid", F.lower(F.trim("work_uid")).alias("work")), "chunk_version_uid")
        .select("case_id", "work")
    )
    works = cases.select("case_id", "work").unionByName(evidence).where("work is not null")
    case, work = F.concat(F.lit("c:"), F.col("case_id")), F.concat(F.lit("w:"), F.col("work"))
    return (
        works.select(case.alias("src"), work.alias("dst"))
        .unionByName(issuers.select(work.alias("src"), F.concat(F.lit("i:"), F.col("issuer")).alias("dst")))
        .unionByName(cases.where("snapshot is not null").select(case.alias("src"), F.concat(F.lit("s:"), F.col("snapshot")).alias("dst")))
    )


def case_components(agent_cases: DataFrame, chunks: DataFrame, local_documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid cases with their component, and the component of every node that has a tie.

    A case without any tie is a component of its own. Cases with a null id are left out; a null split stays null.
    """
    cases = stage(valid_cases(agent_cases))
    nodes = stage(components(case_edges(cases, chunks, issuers_of_works(local_documents))))
    own = nodes.where("node like 'c:%'").select(F.expr("substring(node, 3)").alias("case_id"), "component")
    placed = cases.join(own, "case_id", "left").select("case_id", "split", F.coalesce("component", F.concat(F.lit("c:"), "case_id")).alias("component"))
    return placed, nodes


def split_conflicts(placed: DataFrame) -> DataFrame:
    """Cases whose recorded split is one of three while their component holds another of the three."""
    counted = placed.where(F.col("split").isin(*RECORDED))
    mixed = counted.groupBy("component").agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a <> b").select("component")
    return counted.join(mixed, "component", "left_semi").select("case_id").distinct()


def _shares(total_used: dict[str, float]) -> list[tuple[str, float]]:
    room = [(name, max(0.0, share - total_used.get(name, 0.0))) for name, share in SPLITS]
    whole = sum(x for _, x in room) or 1.0
    return [(name, x / whole) for name, x in room]


def assign_splits(placed: DataFrame) -> DataFrame:
    """(component, assigned): 80/10/10 by cases, whole components only.

    Components above HEAVY of all cases (at most 1/HEAVY rows) go, largest first, where most room is left;
    the others follow the order of their hash, cut where the cumulated bucket sums pass the shares.
    """
    sizes = stage(placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    heavy = sizes.where(F.col("n") > HEAVY * total).orderBy(F.desc("n"), "component").collect() if total else []
    used: dict[str, float] = {}
    fixed = []
    for row in heavy:
        name = max(SPLITS, key=lambda s: s[1] - used.get(s[0], 0.0))[0]
        used[name] = used.get(name, 0.0) + row["n"] / total
        fixed.append((row["component"], name))
    spark = placed.sparkSession
    light = sizes.join(F.broadcast(spark.createDataFrame(fixed, "component string, assigned string")), "component", "left_anti") if fixed else sizes
    bucketed = light.withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(BUCKETS)))
    histogram = bucketed.groupBy("bucket").agg(F.sum("n").alias("n")).orderBy("bucket").collect()  # at most BUCKETS rows
    rest = sum(r["n"] for r in histogram) or 1
    bounds, run = [], 0.0
    for name, share in _shares(used):
        run += share
        bounds.append((name, run))
    cut, done = [], 0
    for r in histogram:
        middle = (done + r["n"] / 2) / rest
        cut.append((r["bucket"], next((name for name, up in bounds if middle < up), bounds[-1][0])))
        done += r["n"]
    by_bucket = spark.createDataFrame(cut, "bucket long, assigned string")
    out = bucketed.join(F.broadcast(by_bucket), "bucket").select("component", "assigned")
    return out.unionByName(spark.createDataFrame(fixed, "component string, assigned string")) if fixed else out


def splits(agent_cases: DataFrame, chunks: DataFrame, local_documents: DataFrame) -> DataFrame:
    """(case_id, component, recorded, assigned, conflict) for every valid case."""
    placed, _ = case_components(agent_cases, chunks, local_documents)
    bad = split_conflicts(placed).withColumn("conflict", F.lit(True))
    return (
        placed.join(assign_splits(placed), "component")
        .join(bad, "case_id", "left")
        .select("case_id", "component", F.col("split").alias("recorded"), "assigned", F.coalesce("conflict", F.lit(False)).alias("conflict"))
    )


def chunk_splits(agent_cases: DataFrame, chunks: DataFrame, local_documents: DataFrame) -> DataFrame:
    """(chunk_version_uid, work_uid, assigned) for every chunk.

    A work takes the split of its component: that of the component's cases, and without a case that of a bucket of
    the component, or of the work where it has no tie. A null work makes each chunk its own.
    """
    placed, nodes = case_components(agent_cases, chunks, local_documents)
    by_work = nodes.where("node like 'w:%'").select(F.expr("substring(node, 3)").alias("work"), "component").join(assign_splits(placed), "component", "left")
    rows = chunks.select("chunk_version_uid", "work_uid", F.lower(F.trim("work_uid")).alias("work")).distinct()
    works = rows.where("work is not null").select("work").distinct().join(by_work, "work", "left")
    spot = F.pmod(F.xxhash64(F.coalesce("component", "work")), F.lit(BUCKETS)) / F.lit(float(BUCKETS))
    hashed = F.when(spot < 0.8, "train").when(spot < 0.9, "validation").otherwise("test")
    works = works.select("work", F.coalesce("assigned", hashed).alias("assigned"))
    alone = F.pmod(F.xxhash64("chunk_version_uid"), F.lit(BUCKETS)) / F.lit(float(BUCKETS))
    return rows.join(works, "work", "left").select(
        "chunk_version_uid",
        "work_uid",
        F.coalesce("assigned", F.when(alone < 0.8, "train").when(alone < 0.9, "validation").otherwise("test")).alias("assigned"),
    )
