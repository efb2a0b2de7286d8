"""Mixing sources to target weights (problem 8).

Tokens are summed by source and hash bucket. From the cumulated sums follows, for each source, the bucket in
which its budget runs out; only that bucket is summed again by the next bits of the hash, and so on through
LEVELS nested levels. What remains is a threshold per source, and the mix is a filter on the hash: no sort,
and no more on the driver than sources x buckets sums at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label
from ..plans.stage import stage
from .vocabularies import RANKS, byte_pairs

#: Bits of the hash per level, and levels.
BITS, LEVELS = 10, 4


def with_tokens(rows: DataFrame, vocabulary: str = RANKS) -> DataFrame:
    """Replaces ``text`` by ``tokens``, its count under a byte-level vocabulary; a null text has none."""
    keep = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", tokens bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = byte_pairs(vocabulary)
        for pdf in batches:
            pdf["tokens"] = [len(encoding.encode_ordinary(t)) if t else 0 for t in pdf.pop("text")]
            yield pdf

    return rows.mapInPandas(run, schema)


def sized_texts(documents: DataFrame, vocabulary: str = RANKS) -> DataFrame:
    """(doc_id, key, h, h2, tokens): each document with the clean name of its source and two hashes of its text."""
    rows = documents.select(
        "doc_id",
        label(F.col("source")).alias("key"),
        F.xxhash64("text").alias("h"),
        F.xxhash64(F.lit(1), "text").alias("h2"),
        "text",
    )
    return with_tokens(rows, vocabulary)


def _bucket(level: int) -> F.Column:
    """The ``level``-th group of BITS bits of the hash, from the top, of an unsigned reading."""
    return F.shiftrightunsigned("h", 64 - BITS * (level + 1)).bitwiseAND(F.lit((1 << BITS) - 1))


def _thresholds(texts: DataFrame, budgets: dict[int, tuple[str, float]]) -> dict[int, int]:
    """For each target, of a source, the number of leading hash values, in units of the last level, that its budget covers."""
    spark = texts.sparkSession
    prefix = dict.fromkeys(budgets, 0)
    left = {no: budget for no, (_, budget) in budgets.items()}
    for level in range(LEVELS):
        open_ones = [(budgets[k][0], k, prefix[k]) for k in prefix if left[k] > 0]
        if not open_ones:
            return {k: p << BITS * (LEVELS - level) for k, p in prefix.items()}
        edge = F.broadcast(spark.createDataFrame(open_ones, "key string, target int, prefix long"))  # one row per target
        inside = texts.join(edge, "key")
        if level:
            inside = inside.where(F.shiftrightunsigned("h", 64 - BITS * level) == F.col("prefix"))
        sums: dict[int, dict[int, int]] = {}
        for r in inside.groupBy("target", _bucket(level).alias("b")).agg(F.sum("tokens").alias("n")).collect():  # targets x 2**BITS rows
            sums.setdefault(r["target"], {})[r["b"]] = r["n"]
        for key in prefix:
            here, b = sums.get(key, {}), 0
            if left[key] > 0:
                while b < (1 << BITS) - 1 and here.get(b, 0) <= left[key]:
                    left[key] -= here.get(b, 0)
                    b += 1
            prefix[key] = (prefix[key] << BITS) + b
            if not here:
                left[key] = 0.0
    return prefix


def _targets(mix_targets: DataFrame) -> list[dict]:
    """The rows of the fixed table of targets; nulls count as no share, one use and no size."""
    rows = mix_targets.where("source is not null").select(
        "source", label(F.col("source")).alias("key"), F.coalesce("target_share", F.lit(0.0)).alias("share"),
        F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("uses"), F.coalesce("mix_size_share", F.lit(0.0)).alias("size"),
    )
    return [r.asDict() for r in rows.distinct().toLocalIterator()]


def plan_mix(documents: DataFrame, mix_targets: DataFrame, vocabulary: str = RANKS) -> tuple[DataFrame, list[dict]]:
    """The staged distinct texts of the target sources and the plan of each: whole uses and a hash threshold."""
    sized = stage(sized_texts(documents, vocabulary))
    total = sized.agg(F.sum("tokens")).first()[0] or 0
    plan = _targets(mix_targets)
    names = documents.sparkSession.createDataFrame([(p["key"],) for p in plan], "key string").distinct()
    # A text that a source holds twice is one text of it.
    texts = stage(sized.join(F.broadcast(names), "key").groupBy("key", "h", "h2").agg(F.min("doc_id").alias("doc_id"), F.max("tokens").alias("tokens")))
    held = {r["key"]: r["n"] for r in texts.groupBy("key").agg(F.sum("tokens").alias("n")).collect()}  # one row per target source
    budgets = {}
    for target, p in enumerate(plan):
        p["tokens"] = held.get(p["key"], 0) or 0
        p["wanted"] = p["share"] * p["size"] * total
        p["short"] = p["tokens"] * p["uses"] < p["wanted"]
        p["whole"] = p["uses"] if p["short"] or not p["tokens"] else int(p["wanted"] // p["tokens"])
        p["rest"] = 0.0 if p["short"] else p["wanted"] - p["whole"] * p["tokens"]
        budgets[target] = p["key"], p["rest"] if p["whole"] < p["uses"] else 0.0
    bounds = _thresholds(texts, budgets)
    for target, p in enumerate(plan):
        p["bound"] = bounds[target]
    return texts, plan


def mixture(documents: DataFrame, mix_targets: DataFrame, vocabulary: str = RANKS) -> DataFrame:
    """(doc_id, source, tokens, uses): the texts of the mix, each at most max_repeats times.

    The copies of a text within its source are one text, named by its least doc_id. A source that falls
    short uses all its texts max_repeats times.
    """
    texts, plan = plan_mix(documents, mix_targets, vocabulary)
    table = documents.sparkSession.createDataFrame([(p["key"], p["source"], p["whole"], p["bound"]) for p in plan], "key string, source string, whole int, bound long")
    high = F.shiftrightunsigned("h", 64 - BITS * LEVELS)
    uses = F.col("whole") + (high < F.col("bound")).cast("int")
    return texts.join(F.broadcast(table), "key").select("doc_id", "source", "tokens", uses.alias("uses")).where("uses > 0")


def mixture_report(documents: DataFrame, mix_targets: DataFrame, vocabulary: str = RANKS) -> DataFrame:
    """(source, wanted_tokens, reached_tokens, reached_share, short): one row per target, as written there."""
    texts, plan = plan_mix(documents, mix_targets, vocabulary)
    high = F.shiftrightunsigned("h", 64 - BITS * LEVELS)
    spark = documents.sparkSession
    columns = "key string, source string, wanted double, whole int, bound long, short boolean"
    table = spark.createDataFrame([(p["key"], p["source"], p["wanted"], p["whole"], p["bound"], p["short"]) for p in plan], columns)
    used = texts.join(F.broadcast(table.select("key", "source", "whole", "bound")), "key").select("key", "source", (F.col("tokens") * (F.col("whole") + (high < F.col("bound")).cast("int"))).alias("n"))
    reached = used.groupBy("key", "source").agg(F.sum("n").alias("n"))
    whole_mix = sum(p["wanted"] for p in plan)
    return table.join(F.broadcast(reached), ["key", "source"], "left").select(
        "source",
        F.round("wanted").cast("bigint").alias("wanted_tokens"),
        F.coalesce("n", F.lit(0)).alias("reached_tokens"),
        F.round(F.coalesce("n", F.lit(0)) / F.lit(whole_mix or 1.0), 6).alias("reached_share"),
        "short",
    )
