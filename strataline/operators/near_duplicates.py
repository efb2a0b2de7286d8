"""Near-duplicates on word shingles, exact at a threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapsed
from ..plans.stage import stage


def with_shingles(df: DataFrame, text: str, size: int = 5) -> DataFrame:
    """Replaces ``text`` by ``s``, the distinct hashes of its runs of ``size`` words; a shorter text is one run.

    The words are a column of their own: inside the lambda the split would run once for every shingle.
    """
    words = df.withColumn("_w", F.split(collapsed(F.col(text)), " ")).drop(text)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w") - size + 1, F.lit(1))), lambda i: F.xxhash64(F.concat_ws(" ", F.slice("_w", i, size))))
    return words.withColumn("s", F.array_distinct(runs)).drop("_w")


def similar_texts(texts: DataFrame, key: str, threshold: float = 0.8, size: int = 5) -> DataFrame:
    """(a, b): all pairs of rows, a < b, whose word shingles have a Jaccard similarity of at least ``threshold``.

    Rows must differ in text (see near_duplicate_classes). Shingles are ordered by their frequency over all rows;
    two similar sets share one of the rarest, so only the prefix that must hold it is joined. Exact, no cap.
    """
    sets = stage(with_shingles(texts.select(F.col(key).alias("k"), "text"), "text", size))
    long = sets.select("k", F.size("s").alias("n"), F.explode("s").alias("h"))
    # A shingle of one row joins nothing, but it takes a place in the order.
    frequency = long.groupBy("h").agg(F.count(F.lit(1)).alias("f"))
    ordered = long.join(frequency, "h").groupBy("k", "n").agg(F.array_sort(F.collect_list(F.struct("f", "h"))).alias("o"))
    prefix = F.slice("o", 1, F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1)
    heads = stage(ordered.select("k", "n", F.explode(F.filter(prefix, lambda x: x["f"] > 1)).alias("x")).select("k", "n", F.col("x.h").alias("h")))
    a, b = heads.alias("a"), heads.alias("b")
    near = F.least("a.n", "b.n") >= threshold * F.greatest("a.n", "b.n") - 1e-9
    pairs = a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.k") < F.col("b.k")) & near).select(F.col("a.k").alias("a"), F.col("b.k").alias("b")).distinct()
    both = pairs.join(sets.select(F.col("k").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("k").alias("b"), F.col("s").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common >= threshold * (F.size("sa") + F.size("sb") - common) - 1e-9).select("a", "b")


def near_duplicate_classes(df: DataFrame, key: str, threshold: float = 0.8) -> DataFrame:
    """(key, class_id, links): the least key with the same normalised text, and how many other texts are similar to it.

    Copies are one text: they share class and links and are never joined with each other. Null texts are left out.
    """
    rows = df.where("text is not null").select(key, "text", F.sha2(collapsed(F.col("text")), 256).alias("_h"))
    classes = stage(rows.groupBy("_h").agg(F.min(key).alias("class_id"), F.first("text").alias("text")))
    pairs = similar_texts(classes.select("class_id", "text"), "class_id", threshold)
    links = pairs.select(F.col("a").alias("class_id")).unionByName(pairs.select(F.col("b").alias("class_id"))).groupBy("class_id").agg(F.count(F.lit(1)).alias("links"))
    members = rows.select(key, "_h").join(classes.select("_h", "class_id"), "_h").select(key, "class_id")
    return members.join(links, "class_id", "left").select(key, "class_id", F.coalesce("links", F.lit(0)).alias("links"))


def greedy_decisions(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(k, keep): in order of k, a row is excluded if and only if an earlier kept row is similar to it.

    ``nodes`` has k; ``pairs`` has a < b. Each round keeps the open rows without an open earlier neighbour and
    excludes the later neighbours of kept rows; similarity is not transitive, so components would be wrong.
    """
    pairs = stage(pairs.select("a", "b").distinct())
    open_ = stage(pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k"))).distinct())
    decided = None
    live = pairs
    while not open_.isEmpty():
        blocked = live.select(F.col("b").alias("k")).distinct()
        kept = stage(open_.join(blocked, "k", "left_anti"))
        out = stage(live.join(kept.withColumnRenamed("k", "a"), "a", "left_semi").select(F.col("b").alias("k")).distinct())
        now = kept.withColumn("keep", F.lit(True)).unionByName(out.withColumn("keep", F.lit(False)))
        decided = now if decided is None else decided.unionByName(now)
        gone = now.select("k")
        open_ = stage(open_.join(gone, "k", "left_anti"))
        live = stage(live.join(gone.withColumnRenamed("k", "a"), "a", "left_anti").join(gone.withColumnRenamed("k", "b"), "b", "left_anti"))
    if decided is None:
        return nodes.select("k", F.lit(True).alias("keep"))
    return nodes.select("k").join(decided, "k", "left").select("k", F.coalesce("keep", F.lit(True)).alias("keep"))
