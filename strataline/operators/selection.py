"""Quotas, ranks and samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries of one block of a vector search.
QUERY_BLOCK = 4096
#: Least planes of the sign hashes for a small set, most bands, and the share of pairs at the threshold that they may lose.
PLANES, BANDS, LOST = 12, 256, 0.001


def largest_remainder(weights: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """(key, quota): ``total`` shared by weight; units left over go by the largest fraction, then by key.

    ``weights`` holds one row per group. Null and negative weights count as none; without any weight all quotas are 0.
    """
    rows = weights.select(key, F.greatest(F.coalesce(weight, F.lit(0.0)), F.lit(0.0)).cast("double").alias("w"))
    whole = rows.agg(F.sum("w").alias("all"), F.lit(1).alias("one"))
    exact = rows.withColumn("one", F.lit(1)).join(F.broadcast(whole), "one").withColumn("exact", F.coalesce(F.col("w") * total / F.nullif("all", F.lit(0.0)), F.lit(0.0)))
    base = exact.select(key, "exact", F.floor("exact").cast("bigint").alias("base"), (F.col("exact") - F.floor("exact")).alias("rest"))
    ordered = Window.orderBy(F.desc(F.round("rest", 9)), key)  # one row per group, not per record
    left = F.lit(total) - F.sum("base").over(Window.partitionBy())
    return base.select(key, (F.col("base") + ((F.row_number().over(ordered) <= left) & (F.sum("exact").over(Window.partitionBy()) > 0)).cast("bigint")).alias("quota"))


def temperature_weights(counts: DataFrame, key: str, n: str, alpha: float) -> DataFrame:
    """(key, weight): sizes raised to ``alpha`` and normalised."""
    rows = counts.select(key, F.pow(F.col(n).cast("double"), F.lit(alpha)).alias("v"))
    return rows.select(key, (F.col("v") / F.sum("v").over(Window.partitionBy())).alias("weight"))


def round_robin(df: DataFrame, stratum: str, order: list[Column], limit: int) -> DataFrame:
    """The first of each stratum, then the second of each, and so on, up to ``limit`` rows."""
    ranked = df.withColumn("turn", F.row_number().over(Window.partitionBy(stratum).orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("turn") <= limit).orderBy("turn", stratum).limit(limit)


def top_by_similarity(queries: DataFrame, items: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, item_id, similarity, rank): the k items most like each query by cosine, the query itself left out.

    ``queries`` is a stated query set; it is carried to the items in blocks and each block keeps k rows per query
    before anything is shuffled. Null vectors and vectors of length zero match nothing.
    """
    import numpy as np
    import pandas as pd

    asked = queries.where(F.col(vector).isNotNull()).select(key, vector)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    known = items.where(F.col(vector).isNotNull()).select(key, vector)
    local = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == block).collect()  # about QUERY_BLOCK rows
        ids = np.array([r[0] for r in rows], np.int64)
        matrix = np.array([r[1] for r in rows], np.float64).reshape(len(rows), -1)
        norms = np.linalg.norm(matrix, axis=1) if len(rows) else np.zeros(0)
        ids, matrix = ids[norms > 0], matrix[norms > 0] / norms[norms > 0, None]

        def best(batches, ids=ids, matrix=matrix):
            for pdf in batches:
                if not len(pdf) or not len(ids):
                    continue
                x = np.stack(pdf[vector].to_numpy()).astype(np.float64)
                norm = np.linalg.norm(x, axis=1)
                x, own = x[norm > 0] / norm[norm > 0, None], pdf[key].to_numpy(np.int64)[norm > 0]
                s = matrix @ x.T
                s[ids[:, None] == own[None, :]] = -np.inf
                m = min(k, s.shape[1])
                if m:
                    order = np.lexsort((np.broadcast_to(own, s.shape), -s.round(12)), axis=1)[:, :m]
                    yield pd.DataFrame({"query_id": np.repeat(ids, m), "item_id": own[order].ravel(), "similarity": np.take_along_axis(s, order, 1).ravel()})

        part = known.mapInPandas(best, "query_id bigint, item_id bigint, similarity double")
        local = part if local is None else local.unionByName(part)
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("similarity", 12)), "item_id")
    return local.where(F.col("similarity") > float("-inf")).withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def greedy_diverse(items: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", score: Column | None = None) -> DataFrame:
    """(key): items from the highest score down, each accepted unless its cosine with an accepted one reaches ``threshold``.

    Equal scores, and all items without ``score``, go by key; a null score comes last. Similar pairs come from sign hashes with exact verification of all pairs that share a band, and the greedy
    order is resolved by rounds over these pairs (see near_duplicates.greedy_decisions).
    """
    from .near_duplicates import greedy_decisions

    rows = items.select(F.col(key).alias("k"), F.col(vector).alias("v"), (score if score is not None else F.lit(0)).alias("s"))
    pairs = cosine_pairs(rows.select("k", "v"), threshold)
    if score is not None:
        sa, sb = rows.select(F.col("k").alias("a"), F.col("s").alias("sa")), rows.select(F.col("k").alias("b"), F.col("s").alias("sb"))
        later = F.col("sb").isNotNull() & (F.col("sa").isNull() | (F.col("sb") > F.col("sa")))
        pairs = pairs.join(sa, "a").join(sb, "b").select(F.when(later, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(later, F.col("a")).otherwise(F.col("b")).alias("b"))
    return greedy_decisions(rows.select("k"), pairs).where("keep").select(F.col("k").alias(key))


def sign_bands(threshold: float, rows: int = 1 << PLANES) -> tuple[int, int]:
    """(planes, bands) of sign hashes that lose a pair at ``threshold`` with a probability of at most LOST.

    A plane has both vectors on one side with 1 - angle / pi. Planes grow with the logarithm of the rows, so that a
    bucket of a band does not grow with them, as far as no more than BANDS bands are needed; no planes are one band of
    all pairs.
    """
    side = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    for planes in range(min(62 - BANDS.bit_length(), max(PLANES, math.ceil(math.log2(max(rows, 2))))), 0, -1):
        agree = side**planes
        bands = 1 if agree == 1 else math.ceil(math.log(LOST) / math.log1p(-agree)) if agree > 1e-9 else BANDS + 1
        if bands <= BANDS:
            return planes, bands
    return 0, 1


def cosine_pairs(rows: DataFrame, threshold: float, planes: int | None = None, bands: int | None = None, seed: int = 3) -> DataFrame:
    """(a, b): pairs with a cosine of at least ``threshold`` that share one of ``bands`` sign hashes of ``planes`` planes.

    Both follow from the threshold (see sign_bands) unless both are given; recall is tested on pairs at the threshold.
    """
    import numpy as np
    import pandas as pd

    if planes is None or bands is None:
        planes, bands = sign_bands(threshold, rows.count())

    def sign(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
            rng = np.random.default_rng(seed)
            p = rng.standard_normal((x.shape[1], planes * bands))
            bits = (x @ p > 0).reshape(len(x), bands, planes)
            keys = bits @ (1 << np.arange(planes, dtype=np.int64)) + (np.arange(bands, dtype=np.int64) << planes)
            yield pd.DataFrame({"k": np.repeat(pdf["k"].to_numpy(np.int64), bands), "band": keys.ravel()})

    keyed = rows.where("v is not null").select("k", "v").mapInPandas(sign, "k bigint, band bigint")
    a, b = keyed.alias("a"), keyed.alias("b")
    pairs = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.k") < F.col("b.k"))).select(F.col("a.k").alias("a"), F.col("b.k").alias("b")).distinct()
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, z: s + z)
    va, vb = rows.select(F.col("k").alias("a"), F.col("v").alias("va")), rows.select(F.col("k").alias("b"), F.col("v").alias("vb"))
    both = pairs.join(va, "a").join(vb, "b")
    cosine = dot("va", "vb") / F.nullif(F.sqrt(dot("va", "va")) * F.sqrt(dot("vb", "vb")), F.lit(0.0))
    return both.where(cosine >= threshold).select("a", "b")
