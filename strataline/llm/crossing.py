"""Same or near-same records across splits (problem 6).

Records are canonicalised once. Equal ones meet by joining the hashes of evaluation and training records.
That join cannot see near-same texts, so a second path bands MinHash signatures of the same canonical
texts, made by one permutation with densification; each pair it offers is verified by its exact Jaccard
similarity. Recall at the threshold is measured in the tests. The canonical form keeps punctuation, as the
definition of a match does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label, latest, split_label
from ..plans.stage import stage
from .text import LEAST_CHARS, mix64, normalized, sha256_hex, window_sets

THRESHOLD = 0.8
ROWS, BANDS = 6, 36
EVALUATION = ("validation", "test")

_FILL = (mix64(np.arange(ROWS * BANDS * 64, dtype=np.uint64)).reshape(64, -1) % np.uint64(ROWS * BANDS)).astype(np.int64)
#: Texts hashed together.
TOGETHER = 256


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS hashes of ROWS minima each for every set of sorted 64-bit hashes.

    One hash per value: the range of hashes is cut into one bin per minimum, and the least hash in a bin is its
    minimum. An empty bin takes over that of a bin fixed by its number and the trial, so equal sets fill alike.
    """
    bins = ROWS * BANDS
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(v) for v in sets])
    at = owner * bins + ((values >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    low = np.zeros(len(sets) * bins, np.uint64)
    full = np.zeros(len(low), bool)
    low[at[first]], full[at[first]] = values[first], True
    low, full = low.reshape(-1, bins), full.reshape(-1, bins)
    own, done = low.copy(), full.copy()
    for trial in _FILL:
        if done.all():
            break
        take = full[:, trial] & ~done
        low = np.where(take, own[:, trial], low)
        done |= take
    low = np.where(done, low, np.array([v[0] for v in sets], np.uint64)[:, None])
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), BANDS))
    for row in range(ROWS):
        out = mix64(out * np.uint64(0x100000001B3) + low[:, row::ROWS])
    return out.view(np.int64)


def canonical(corpus: DataFrame) -> DataFrame:
    """(seq, sample_id, side, split, hash, chars, norm): one row per record in train or an evaluation split.

    Null texts and other splits are left out; a row delivered twice counts once.
    """
    rows = corpus.select("seq", "sample_id", split_label(F.col("split")).alias("split"), "text").where(F.col("split").isin("train", *EVALUATION) & F.col("text").isNotNull() & F.col("seq").isNotNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            norm = [normalized(t) for t in pdf.pop("text")]
            pdf["hash"] = [sha256_hex(t) for t in norm]
            pdf["norm"] = [t if len(t) >= LEAST_CHARS else None for t in norm]
            yield pdf

    made = rows.mapInPandas(run, "seq bigint, sample_id string, split string, hash string, norm string")
    return made.dropDuplicates(["seq"]).withColumn("train", F.col("split") == "train")


def _band_rows(reps: DataFrame) -> DataFrame:
    """(band, rep, n, train, evaluation) with the number of windows of each representative."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[k : k + TOGETHER]
                sets = window_sets(part["norm"].tolist())
                yield pd.DataFrame({
                    "band": bands(sets).ravel(), "rep": np.repeat(part["rep"].to_numpy(np.int64), BANDS), "n": np.repeat(np.array([len(v) for v in sets], np.int32), BANDS),
                    "train": np.repeat(part["train"].to_numpy(bool), BANDS), "evaluation": np.repeat(part["evaluation"].to_numpy(bool), BANDS),
                })

    return reps.select("rep", "train", "evaluation", "norm").mapInPandas(run, "band bigint, rep bigint, n int, train boolean, evaluation boolean")


def _verified(pairs: DataFrame, threshold: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[k : k + TOGETHER]
                kept = []
                for a, b in zip(window_sets(part["x"].tolist()), window_sets(part["y"].tolist())):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    kept.append(both >= threshold * (len(a) + len(b) - both))
                yield part.loc[np.array(kept, bool), ["eval_rep", "train_rep"]]

    return pairs.mapInPandas(run, "eval_rep bigint, train_rep bigint")


def overlap_classes(records: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(eval_rep, train_rep) over classes of equal canonical texts, and the members (rep, seq, sample_id, split, train)."""
    classes = stage(
        records.groupBy("hash").agg(
            F.min("seq").alias("rep"), F.max("train").alias("train"), F.max(~F.col("train")).alias("evaluation"), F.max("norm").alias("norm")
        )
    )
    exact = classes.where("train and evaluation").select(F.col("rep").alias("eval_rep"), F.col("rep").alias("train_rep"))
    # Staged, so that both sides of the join below read the signatures instead of making them twice.
    keyed = stage(_band_rows(classes.where("norm is not null")))
    e = keyed.where("evaluation").select(F.col("rep").alias("eval_rep"), F.col("n").alias("en"), "band")
    t = keyed.where("train").select(F.col("rep").alias("train_rep"), F.col("n").alias("tn"), "band")
    sizes = F.least("en", "tn") >= F.greatest("en", "tn") * threshold - 1e-9
    offered = e.join(t, "band").where(sizes & (F.col("eval_rep") != F.col("train_rep"))).select("eval_rep", "train_rep").distinct()
    texts = classes.select("rep", "norm")
    both = offered.join(texts.withColumnsRenamed({"rep": "eval_rep", "norm": "x"}), "eval_rep").join(texts.withColumnsRenamed({"rep": "train_rep", "norm": "y"}), "train_rep")
    members = records.join(classes.select("hash", "rep"), "hash").select("rep", "seq", "sample_id", "split", "train")
    return exact.unionByName(_verified(both.select("eval_rep", "train_rep", "x", "y"), threshold)), members


def crossing_pairs(corpus: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(seq_a, seq_b), smaller first: every pair of an evaluation record and a same or near-same training record."""
    links, members = overlap_classes(stage(canonical(corpus)), threshold)
    e = members.where("not train").select(F.col("rep").alias("eval_rep"), F.col("seq").alias("e"))
    t = members.where("train").select(F.col("rep").alias("train_rep"), F.col("seq").alias("t"))
    return links.join(e, "eval_rep").join(t, "train_rep").select(F.least("e", "t").alias("seq_a"), F.greatest("e", "t").alias("seq_b"))


def crossing_report(corpus: DataFrame, quality_report: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(split, source_name, samples, overlapping, pairs, recorded): overlaps of each evaluation split and source.

    ``recorded`` counts the overlapping samples whose latest report has split_conflicts above 0. A sample
    without a report, and a null or empty source, count as ``unknown``.
    """
    links, members = overlap_classes(stage(canonical(corpus)), threshold)
    weights = members.where("train").groupBy(F.col("rep").alias("train_rep")).agg(F.count(F.lit(1)).alias("n"))
    per_class = links.join(weights, "train_rep").groupBy("eval_rep").agg(F.sum("n").alias("pairs"))
    states = latest(quality_report.where("sample_id is not null").select("sample_id", "reported_at", "source_name", "split_conflicts"), "sample_id", "reported_at")
    rows = (
        members.where("not train")
        .join(per_class.withColumnRenamed("eval_rep", "rep"), "rep", "left")
        .join(states, "sample_id", "left")
        .select("split", label(F.col("source_name")).alias("source_name"), "pairs", "split_conflicts")
    )
    return rows.groupBy("split", "source_name").agg(
        F.count(F.lit(1)).alias("samples"),
        F.count("pairs").alias("overlapping"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
        F.count(F.when(F.col("pairs").isNotNull() & (F.col("split_conflicts") > 0), 1)).alias("recorded"),
    )
