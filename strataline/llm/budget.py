"""Token budget per source and language (problem 4).

The pieces of a vocabulary, each at the cost its rank has under Zipf's law, are read as a unigram model. They
lie in a double-array trie. All distinct segments of an Arrow batch walk the trie together, one step for all
their positions at a time, and the Viterbi pass runs over all segments in lockstep, keeping only the cost and
the number of pieces of the best path to each position.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label, language_label, latest
from .vocabularies import PIECES, piece_vocabulary

SPACE = "▁"
#: A character outside the vocabulary costs its bytes, each as much as the rarest piece.
_SEGMENT = re.compile(r" ?[^\s、。，；：！？（）《》「」“”]+|[、。，；：！？（）《》「」“”]+|\s+")
#: A reported count is trusted within this factor of the usual ratio of its tokenizer and language.
TRUST = 1.6
#: Segments longer than this are counted in a walk of their own, so that short ones need no long table.
LONG = 64


class DoubleArray:
    """A double-array trie over strings of code points, built breadth first."""

    def __init__(self, entries: list[tuple[str, float]]):
        alphabet = sorted({c for key, _ in entries for c in key})
        self.codes = np.zeros(0x110000, np.int32)  # 0 for a character no piece holds
        self.codes[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        root: dict = {}
        for key, cost in entries:
            node = root
            for c in key:
                node = node.setdefault(int(self.codes[ord(c)]), {})
            node[0] = cost
        span = len(alphabet) + 1
        size = 2 * sum(len(k) for k, _ in entries) + 4 * span
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.cost = np.full(size, np.inf)
        used = bytearray(size)
        used[0] = 1
        self.check[0] = 0
        queue, single, wide = [(root, 0)], span, 1  # wide places only move on, so that building stays linear
        for node, at in queue:
            if 0 in node:
                self.cost[at] = node[0]
            below = [c for c in node if c]
            if not below:
                continue
            if len(below) == 1:
                while used[single]:
                    single += 1
                base = single - below[0]
            else:
                tries = 0
                while any(used[wide + c] for c in below):
                    wide += 1
                    tries += 1
                base = wide
                wide += tries > 50
            if max(base, wide) + 2 * span >= len(used):
                more = len(used)
                used.extend(bytes(more))
                self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
                self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])
                self.cost = np.concatenate([self.cost, np.full(more, np.inf)])
            self.base[at] = base
            for c in below:
                used[base + c] = 1
                self.check[base + c] = at
                queue.append((node[c], base + c))
        self.depth = max(len(k) for k, _ in entries)

    def matches(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, starts, costs) of all pieces in a row of codes in which 0 ends every walk."""
        at = np.flatnonzero(codes)
        state = np.zeros(len(at), np.int64)
        for depth in range(self.depth):
            inside = at + depth < len(codes)
            at, state = at[inside], state[inside]
            code = codes[at + depth]
            nxt = self.base[state].astype(np.int64) + code
            ok = (code > 0) & (nxt < len(self.check))
            ok &= self.check[np.minimum(nxt, len(self.check) - 1)] == state
            ok &= self.base[state] > 0
            at, state = at[ok], nxt[ok]
            if not len(at):
                return
            hit = np.isfinite(self.cost[state])
            if hit.any():
                yield depth + 1, at[hit], self.cost[state[hit]]


@functools.lru_cache(1)
def trie(path: str = PIECES) -> DoubleArray:
    """The double array of a vocabulary, once per worker."""
    return DoubleArray([(piece, float(np.log(rank + 2.0))) for piece, rank in piece_vocabulary(path)])


def _count_block(array: DoubleArray, segments: list[str]) -> np.ndarray:
    """Pieces on the best path of each segment."""
    lengths = np.array([len(s) for s in segments])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]  # one empty place after each segment
    points = np.frombuffer("\0".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.concatenate([points, np.zeros(1, np.uint32)])
    codes = array.codes[points]
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)  # bytes of each character
    byte = float(np.log(40_000.0))
    longest = int(lengths.max())
    n = len(segments)
    cost = np.full((longest + 1, n), np.inf)
    count = np.zeros((longest + 1, n), np.int32)
    cost[0] = 0.0
    owner = np.repeat(np.arange(n), lengths + 1)
    local = np.arange(len(points)) - starts[owner]
    edges: list[list] = [[] for _ in range(longest)]
    for length, at, piece_cost in array.matches(codes):
        at_local = local[at]
        order = np.argsort(at_local, kind="stable")
        at_local, who, c = at_local[order], owner[at[order]], piece_cost[order]
        cut = np.searchsorted(at_local, np.arange(longest + 1))
        for j in np.unique(at_local):
            a, b = cut[j], cut[j + 1] if j + 1 <= longest else len(at_local)
            edges[j].append((length, who[a:b], c[a:b]))
    for j in range(longest):
        alive = np.flatnonzero(lengths > j)
        at = starts[alive] + j
        w = width[at]
        new = cost[j, alive] + byte * w
        better = new < cost[j + 1, alive]
        who = alive[better]
        cost[j + 1, who] = new[better]
        count[j + 1, who] = count[j, who] + w[better]
        for length, who, c in edges[j]:
            new = cost[j, who] + c
            better = new < cost[j + length, who]
            who = who[better]
            cost[j + length, who] = new[better]
            count[j + length, who] = count[j, who] + 1
    return count[lengths, np.arange(n)]


def count_segments(segments: list[str], path: str = PIECES) -> list[int]:
    """The pieces of each normalized segment under the vocabulary's unigram reading."""
    array, out = trie(path), [0] * len(segments)
    order = sorted(range(len(segments)), key=lambda i: len(segments[i]))
    k = 0
    while k < len(order):
        longest = len(segments[order[min(len(order), k + 4000) - 1]])
        step = 4000 if longest <= LONG else max(1, 200_000 // longest)
        block = order[k : k + step]
        filled = [i for i in block if segments[i]]
        if filled:
            for i, c in zip(filled, _count_block(array, [segments[i] for i in filled]).tolist()):
                out[i] = c
        k += step
    return out


def segments(text: str) -> list[str]:
    """The segments of a text: NFKC, runs of white space one mark before the word they lead."""
    clean = " ".join(unicodedata.normalize("NFKC", text).split())
    return [s.replace(" ", SPACE) for s in _SEGMENT.findall(" " + clean)] if clean else []


def estimated_tokens(rows: DataFrame, path: str = PIECES) -> DataFrame:
    """Replaces ``text`` by ``estimate``, the pieces of its best path; a null text has none."""
    keep = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", estimate bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, int] = {}
        for pdf in batches:
            split = [segments(t) if t else [] for t in pdf.pop("text")]
            new = list({s for own in split for s in own if s not in memo})
            if len(memo) + len(new) > 500_000:  # the memo is a speed-up only
                memo = {}
                new = list({s for own in split for s in own})
            memo.update(zip(new, count_segments(new, path)))
            pdf["estimate"] = np.array([sum(map(memo.__getitem__, own)) for own in split], np.int64)
            yield pdf

    return rows.mapInPandas(run, schema)


def sample_tokens(quality_report: DataFrame, corpus: DataFrame, path: str = PIECES) -> DataFrame:
    """(sample_id, source_name, language, domain, reported, estimate, trusted, tokens): one row per sample.

    The latest report of a sample holds. A positive reported count is trusted if its ratio to the estimate is
    within TRUST of the median ratio of its tokenizer and language; else the estimate, scaled by that median,
    stands for it. Without a text the reported count stands, if positive, and else 0. Texts are counted where they lie:
    a row delivered twice is counted twice before it is dropped, which costs less than moving all texts first.
    """
    columns = ["sample_id", "reported_at", "source_name", "language", "domain", "token_count"]
    states = latest(quality_report.where("sample_id is not null").select(*columns), "sample_id", "reported_at")
    counted = estimated_tokens(corpus.where("sample_id is not null").select("sample_id", label(F.col("tokenizer")).alias("tokenizer"), "text"), path)
    texts = counted.groupBy("sample_id").agg(F.max("estimate").alias("estimate"), F.min("tokenizer").alias("tokenizer"))
    rows = states.join(texts, "sample_id", "left").select(
        "sample_id",
        label(F.col("source_name")).alias("source_name"),
        language_label(F.col("language")).alias("language"),
        label(F.col("domain")).alias("domain"),
        F.coalesce("tokenizer", F.lit("unknown")).alias("tokenizer"),
        F.when(F.col("token_count") > 0, F.col("token_count")).alias("reported"),
        F.when(F.col("estimate") > 0, F.col("estimate")).alias("estimate"),
    )
    ratio = F.col("reported") / F.col("estimate")
    usual = rows.groupBy("tokenizer", "language").agg(F.percentile_approx(ratio, 0.5, 1000).alias("usual"))
    rows = rows.join(usual, ["tokenizer", "language"], "left").withColumn("usual", F.coalesce("usual", F.lit(1.0)))
    near = ratio.between(F.col("usual") / TRUST, F.col("usual") * TRUST) | F.col("estimate").isNull()
    trusted = F.coalesce(F.col("reported").isNotNull() & near, F.lit(False))
    guess = F.round(F.col("estimate") * F.col("usual")).cast("bigint")
    return rows.withColumn("trusted", trusted).select(
        "sample_id", "source_name", "language", "domain", "reported", "estimate", "trusted",
        F.coalesce(F.when(F.col("trusted"), F.col("reported")), guess, F.lit(0)).alias("tokens"),
    )


def slice_totals(samples: DataFrame) -> DataFrame:
    """(source_name, language, domain, samples, tokens) for every slice, ``*`` meaning any."""
    fine = samples.groupBy("source_name", "language", "domain").agg(F.count(F.lit(1)).alias("samples"), F.sum("tokens").alias("tokens"))
    keys = ["source_name", "language", "domain"]
    named = [F.when(F.grouping(k) == 1, "*").otherwise(F.col(k)).alias(k + "_") for k in keys]
    cube = fine.cube(*keys).agg(F.sum("samples").alias("samples"), F.sum("tokens").alias("tokens"), *named)
    return cube.select(*[F.col(k + "_").alias(k) for k in keys], "samples", "tokens")


def coverage(samples: DataFrame, coverage_targets: DataFrame) -> DataFrame:
    """Targets as written, with the tokens of their slice, its share and whether it holds too little.

    A null label of a target means any; a null floor is never missed. With no tokens at all every share is 0.
    """
    totals = slice_totals(samples)
    any_ = lambda c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("*"))
    targets = coverage_targets.distinct().select(
        "source_name", "language", "domain", "min_share",
        label(any_(F.col("source_name"))).alias("s"), language_label(any_(F.col("language"))).alias("l"), label(any_(F.col("domain"))).alias("d"),
    )
    everything = totals.where("source_name = '*' and language = '*' and domain = '*'").select(F.sum("tokens")).scalar()
    slices = totals.select(F.col("source_name").alias("s"), F.col("language").alias("l"), F.col("domain").alias("d"), "tokens")
    share = F.coalesce(F.col("tokens") / F.nullif(everything, F.lit(0)), F.lit(0.0))
    return targets.join(slices, ["s", "l", "d"], "left").select(
        "source_name", "language", "domain", "min_share",
        F.coalesce("tokens", F.lit(0)).alias("tokens"), share.alias("share"), F.coalesce(share < F.col("min_share"), F.lit(False)).alias("too_little"),
    )
