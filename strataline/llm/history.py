"""Deduplicating new batches against all history (problem 3).

The index of segments is laid over the sorted shingles of a text, read as a string over the shingle
alphabet. Two such strings are similar enough exactly if their edit distance in insertions and deletions
is at most a bound that follows from their lengths. A text of a length class is cut at fixed places of the
shingle range into one segment more than the largest bound its class allows; then two similar texts agree
in one whole segment at the same place. Segments are stored by scope, guard, length class and position;
a new text probes the classes its length can match; each hit is verified by its edit distance.

The index is a folder of two Parquet tables that are only ever appended to: the distinct texts of the history with
their shingles, and their segments. A batch adds the texts the index does not hold yet and asks for its own; no
segment of the history is made twice.

Equal texts are one representative with members, so copies cost one row in the index; pairs of samples
are made from pairs of representatives at the very end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.stage import shared_folder, stage
from .text import LEAST_CHARS, PRIME, guard, mix64, normalized, sha256_hex, shingles

THRESHOLD = 0.9
#: Each length class reaches from a bound to this multiple of it.
CLASS_RATIO = 1.1

_FEATURES = "guard string, normalized_hash string, chars int, shingles array<bigint>"


def features(rows: DataFrame) -> DataFrame:
    """Adds guard, normalized_hash, chars and shingles to rows with a text; the text itself is left behind.

    A text below LEAST_CHARS gets no shingles, for it is compared by its hash only. Null texts are dropped.
    """
    keep = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", " + _FEATURES

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [normalized(t) for t in pdf.pop("text")]
            pdf["guard"] = [guard(t) for t in texts]
            pdf["normalized_hash"] = [sha256_hex(t) for t in texts]
            pdf["chars"] = np.array([len(t) for t in texts], np.int32)
            pdf["shingles"] = [shingles(t) if len(t) >= LEAST_CHARS else [] for t in texts]
            yield pdf

    return rows.where("text is not null").mapInPandas(run, schema)


def length_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / math.log(CLASS_RATIO)).astype(np.int64)


def segment_count(length_class: int, threshold: float = THRESHOLD) -> int:
    """One more than the largest edit distance that a text of the class and a text similar to it can have."""
    longest = math.ceil(CLASS_RATIO ** (length_class + 1))
    return math.floor(longest * (1 - threshold) / threshold + 1e-9) + 1


def segments(values: np.ndarray, count: int) -> np.ndarray:
    """A hash of the shingles in each of ``count`` equal parts of the shingle range."""
    part = (values.astype(np.float64) * (count / PRIME)).astype(np.int64).clip(0, count - 1)
    spread = mix64(values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])
    edge = np.searchsorted(part, np.arange(count + 1))
    total = run[edge[1:]] - run[edge[:-1]]  # wraps, as the sums do
    return mix64(total + np.arange(count, dtype=np.uint64)).view(np.int64)


def _classes(n: int, threshold: float) -> range:
    low, high = length_class(np.array([math.ceil(n * threshold - 1e-9), math.floor(n / threshold + 1e-9)]))
    return range(int(low), int(high) + 1)


def segment_rows(reps: DataFrame, *, probe: bool, threshold: float = THRESHOLD) -> DataFrame:
    """(seg, rep, n): the segments a representative is stored under, or with ``probe`` those it asks for.

    ``seg`` is a hash of the segment, its place, the length class and the group.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rep, count, size, seg = [], [], [], []
            for r, g, values in zip(pdf["rep"], pdf["grp"], pdf["shingles"]):
                values = np.asarray(values, np.int64)
                n = len(values)
                for c in _classes(n, threshold) if probe else (int(length_class(np.array([n]))[0]),):
                    keys = segments(values, segment_count(c, threshold))
                    rep.append(r)
                    count.append(len(keys))
                    size.append(n)
                    seg.append(mix64(mix64(keys.view(np.uint64) + np.uint64(c + 1)) ^ np.array(g, np.int64).view(np.uint64)).view(np.int64))
            yield pd.DataFrame({
                "seg": np.concatenate(seg) if seg else np.zeros(0, np.int64), "rep": np.repeat(np.array(rep, np.int64), count), "n": np.repeat(np.array(size, np.int32), count),
            })

    return reps.select("rep", "grp", "shingles").mapInPandas(run, "seg bigint, rep bigint, n int")


def similar_pairs(stored: DataFrame, asked: DataFrame, threshold: float = THRESHOLD, index: DataFrame | None = None) -> DataFrame:
    """(stored, asked) representatives with Jaccard similarity of at least ``threshold``, equal ids left out.

    Both sides have rep, grp and shingles; only rows of one grp are compared. ``index`` are the stored segments
    of ``stored``; without it they are made here. Shingles are read for the pairs that share a segment only.
    """
    held = index if index is not None else segment_rows(stored, probe=False, threshold=threshold)
    a, b = held.alias("a"), segment_rows(asked, probe=True, threshold=threshold).alias("b")
    sizes = F.least("a.n", "b.n") >= threshold * F.greatest("a.n", "b.n") - 1e-9
    hits = a.join(b, (F.col("a.seg") == F.col("b.seg")) & (F.col("a.rep") != F.col("b.rep")) & sizes)
    pairs = stage(hits.select(F.col("a.rep").alias("stored"), F.col("b.rep").alias("asked")).distinct())
    left = stored.select(F.col("rep").alias("stored"), F.col("grp").alias("g"), F.col("shingles").alias("x"))
    right = asked.select(F.col("rep").alias("asked"), F.col("grp").alias("h"), F.col("shingles").alias("y"))
    both = pairs.join(right, "asked").join(left, "stored").where("g = h")
    total = F.size("x") + F.size("y")
    distance = total - 2 * F.size(F.array_intersect("x", "y"))
    return both.where(distance <= total * ((1 - threshold) / (1 + threshold)) + 1e-9).select("stored", "asked").distinct()


KEY = ["scope", "guard", "normalized_hash"]


class SegmentIndex:
    """The stored index: ``texts`` (rep, grp, scope, guard, normalized_hash, shingles) and ``segments`` (seg, rep, n)."""

    def __init__(self, spark: SparkSession, path: str, threshold: float = THRESHOLD):
        self.spark, self.path, self.threshold = spark, path.rstrip("/"), threshold

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def texts(self) -> DataFrame:
        return self._read("texts", "rep bigint, grp bigint, scope string, guard string, normalized_hash string, shingles array<bigint>")

    def segments(self) -> DataFrame:
        return self._read("segments", "seg bigint, rep bigint, n int")

    def append(self, texts: DataFrame) -> None:
        """Adds texts of the columns of ``texts`` that the index does not hold; one row per KEY, each ``rep`` its own.

        Segments are written first: an append that broke off leaves segments without a text, which match nothing and
        are written again; candidates are made distinct before they are verified.
        """
        new = stage(texts.join(self.texts().select(*KEY), KEY, "left_anti"))
        segment_rows(new, probe=False, threshold=self.threshold).write.mode("append").parquet(f"{self.path}/segments")
        new.select("rep", "grp", *KEY, "shingles").write.mode("append").parquet(f"{self.path}/texts")

    def similar(self, asked: DataFrame) -> DataFrame:
        """(scope, guard, normalized_hash of a stored text, asked): stored texts similar to the asked (rep, grp, shingles)."""
        held = self.texts()
        pairs = similar_pairs(held, asked, self.threshold, self.segments())
        return pairs.join(held.select(F.col("rep").alias("stored"), *KEY), "stored").select(*KEY, "asked")


def _status(corpus: DataFrame) -> DataFrame:
    """(seq, scope, batch_no, status, text) of the corpus rows that have a key."""
    return corpus.where("seq is not null").select("seq", "scope", "batch_no", F.lower(F.trim("status")).alias("status"), "text")


def known_samples(corpus: DataFrame, dedup_index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per sample that is not rejected, without its shingles, and the shingles by ``seq``.

    Features come from the index where a sample is held there, else they are made from its text, once.
    (seq, scope, batch_no, pending, guard, normalized_hash, chars), (seq, shingles)
    """
    samples = _status(corpus)
    held = dedup_index.where("seq is not null")
    status = samples.groupBy("seq").agg(F.min("status").alias("status"))
    columns = ["seq", "scope", "batch_no", (F.coalesce("status", F.lit("accepted")) == "pending").alias("pending")]
    indexed = held.select("seq", "scope", "batch_no", "guard", "normalized_hash", "chars").join(status, "seq", "left")
    missing = samples.where("status is null or status <> 'rejected'").join(held.select("seq"), "seq", "left_anti").dropDuplicates(["seq"])
    made = stage(features(missing.select(*columns, "text")))
    light = ["guard", "normalized_hash", "chars"]
    known = indexed.where("status is null or status <> 'rejected'").select(*columns, *light).unionByName(made.select("seq", "scope", "batch_no", "pending", *light))
    return known, held.select("seq", "shingles").unionByName(made.select("seq", "shingles"))


def index_path(spark: SparkSession, source: str) -> str:
    """Where the index of a source of samples lies in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/segments-{sha256_hex(source)[:16]}"


def duplicates_of_pending(corpus: DataFrame, dedup_index: DataFrame, threshold: float = THRESHOLD, path: str | None = None) -> DataFrame:
    """(seq_a, seq_b): for every pending sample the same or near-same samples of lower batches in its scope and guard.

    With ``path`` the texts of the history are appended to the index stored there as far as it does not hold them, and
    the pending ones asked against it; without, they are compared once and nothing is kept. A sample without scope,
    batch or text matches nothing. Repeated rows count once.
    """
    known, sets = known_samples(corpus, dedup_index)
    samples = stage(known.where("scope is not null and batch_no is not null and guard is not null").dropDuplicates(["seq"]))
    classes = stage(samples.groupBy(*KEY).agg(F.min("seq").alias("rep"), F.max("pending").alias("asked"), F.min("pending").alias("new"), F.max("chars").alias("chars")))
    grp = F.xxhash64("scope", "guard").alias("grp")
    long = classes.where(F.col("chars") >= LEAST_CHARS)
    if path is not None:
        index = SegmentIndex(corpus.sparkSession, path, threshold)
        fresh = long.where("not new").join(index.texts().select(*KEY), KEY, "left_anti")
        index.append(sets.join(fresh.select(F.col("rep").alias("seq"), grp, *KEY), "seq").withColumnRenamed("seq", "rep"))
        asked = stage(sets.join(long.where("asked").select(F.col("rep").alias("seq"), grp), "seq").select(F.col("seq").alias("rep"), "grp", "shingles"))
        # A text of the index that the history no longer holds, such as a rejected one, has no class and drops out.
        old = index.similar(asked).join(classes.select(*KEY, F.col("rep").alias("stored")), KEY).where("stored <> asked").select("stored", "asked")
        near = old.unionByName(similar_pairs(asked, asked, threshold)).distinct()
    else:
        # Only where a group of scope and guard holds a pending sample and a second text, sets need to be compared.
        open_groups = long.groupBy("scope", "guard").agg(F.count(F.lit(1)).alias("n"), F.max("asked").alias("any")).where("n > 1 and any").select("scope", "guard")
        compared = long.join(open_groups, ["scope", "guard"], "left_semi").select(F.col("rep").alias("seq"), grp, "asked")
        reps = stage(sets.join(compared, "seq").select(F.col("seq").alias("rep"), "grp", "asked", "shingles"))
        near = similar_pairs(reps, reps.where("asked"), threshold)
    links = near.unionByName(classes.where("asked").select(F.col("rep").alias("stored"), F.col("rep").alias("asked")))
    members = samples.select("seq", "batch_no", "pending", *KEY).join(classes.select(*KEY, "rep"), KEY).select("seq", "batch_no", "pending", "rep")
    a = members.select(F.col("rep").alias("stored"), F.col("seq").alias("seq_a"), F.col("batch_no").alias("batch_a"))
    b = members.where("pending").select(F.col("rep").alias("asked"), F.col("seq").alias("seq_b"), F.col("batch_no").alias("batch_b"))
    return links.join(b, "asked").join(a, "stored").where("batch_a < batch_b").select("seq_a", "seq_b")
