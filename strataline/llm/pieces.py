"""Splitting oversized items at natural boundaries (problem 2).

Every boundary of a text is joined to its farthest legal successor, overlap included; the table of successors is
squared until all cuts on the path from the first boundary are known. Nothing walks along a text: cuts in stretches
without a pause follow from their length. The tables of all texts of an Arrow batch are one, so the squaring runs
over the batch at once and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Natural boundaries, strongest first: paragraph, line, sentence, clause, word.
PAUSES = (
    re.compile(r"\n\s*\n\s*"),
    re.compile(r"\n\s*"),
    re.compile(r"[.!?…]+[\"'”’)\]]*\s+|[。！？；]+[”’」』）]*"),
    re.compile(r"[,;:]\s+|[，、：]"),
    re.compile(r"\s+"),
)
#: Rank of a cut inside a word, taken only where no pause lies in the reach of a piece.
HARD = len(PAUSES)


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions inside a text, ascending, and the rank of each (0 strongest)."""
    rank: dict[int, int] = {}
    for level, pattern in enumerate(PAUSES):
        for m in pattern.finditer(text):
            rank.setdefault(m.end(), level)
    rank.pop(len(text), None)
    rank.pop(0, None)
    at = np.fromiter(rank.keys(), np.int64, len(rank))
    level = np.fromiter(rank.values(), np.int8, len(rank))
    order = np.argsort(at)
    return at[order], level[order]


def _last_at_most(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each (low, high] the greatest element of ``at`` in it, else -1."""
    if not len(at):
        return np.full(len(high), -1, np.int64)
    i = np.searchsorted(at, high, "right") - 1
    found = np.where(i >= 0, at[np.maximum(i, 0)], -1)
    return np.where(found > low, found, -1)


def _pause(ends: np.ndarray, at: np.ndarray, level: np.ndarray, limit: int, overlap: int) -> np.ndarray:
    """The farthest legal pause in the reach of the piece after each of ``ends``, -1 for none.

    A pause is legal where no stronger one lies in the last half of the reach; only where that half has none, any
    pause that goes on is.
    """
    start = np.maximum(ends - overlap, 0)
    least = np.maximum(ends, start + overlap)  # any further, and the piece after it starts later than this one
    out = np.full(len(ends), -1, np.int64)
    for floor in (np.maximum(least, start + limit // 2), least):
        for rank in range(HARD):
            hit = _last_at_most(at[level == rank], floor, start + limit)
            out = np.where(out < 0, hit, out)
    return out


def successors(ends: np.ndarray, at: np.ndarray, level: np.ndarray, length: int, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """(hard cuts, next boundary) after a piece that ends at each of ``ends``.

    The next piece starts ``overlap`` before the end and ends with the text if that fits, else at the farthest legal
    pause. Where its reach holds no pause, the text is cut at the limit until a pause or the end comes into reach: as
    such cuts are equally far apart, their number follows from the distance, and the table stays closed over the pauses.
    """
    far = np.maximum(ends - overlap, 0) + limit
    out = np.where(far >= length, length, _pause(ends, at, level, limit, overlap))
    none = out < 0
    ahead = np.append(at, length)
    goal = ahead[np.searchsorted(at, far, "right")]  # the first pause beyond the reach, or the end
    step = limit - overlap
    hard = np.where(none, -(-(goal - far) // step), 0)
    last = far + (hard - 1) * step  # where the last hard cut lies
    after = np.where(last - overlap + limit >= length, length, _pause(last, at, level, limit, overlap))
    return hard, np.where(none, after, out)


def _reachable(successor: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Marks all nodes on the paths from ``first`` by squaring the successor table."""
    seen = np.zeros(len(successor), bool)
    seen[first] = True
    while True:
        grown = seen.copy()
        grown[successor[seen]] = True
        if (grown == seen).all():
            return seen
        seen = grown
        successor = successor[successor]


def cuts(texts: list[str], limits: list[int], overlaps: list[int]) -> list[list[tuple[int, int]]]:
    """(start, end) of the pieces of each text."""
    tables, offsets, base = [], [], 0
    for text, limit, overlap in zip(texts, limits, overlaps):
        n, overlap = len(text), max(0, min(overlap, limit - 1))
        at, level = boundaries(text)
        ends = np.concatenate([np.zeros(1, np.int64), at, np.full(1, n, np.int64)])
        hard, nxt = successors(ends[:-1], at, level, n, limit, overlap)
        tables.append((ends, hard, np.append(np.searchsorted(ends, nxt), len(ends) - 1) + base))
        offsets.append(base)
        base += len(ends)
    if not tables:
        return []
    seen = _reachable(np.concatenate([t[2] for t in tables]), np.array(offsets))
    out = []
    for (ends, hard, _), first, overlap, limit in zip(tables, offsets, overlaps, limits):
        overlap = max(0, min(overlap, limit - 1))
        kept = seen[first : first + len(ends)]
        path, more = ends[kept], hard[kept[:-1]]  # the last end of the path is that of the text
        owner = np.repeat(np.arange(len(more)), more)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(more) - more, more)
        inside = np.maximum(path[owner] - overlap, 0) + limit + nth * (limit - overlap)
        stops = np.unique(np.concatenate([path[1:], inside]))
        starts = np.concatenate([np.zeros(min(1, len(stops)), np.int64), np.maximum(stops[:-1] - overlap, 0)])
        out.append(list(zip(starts.tolist(), stops.tolist())))
    return out


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        plan = cuts(pdf["text"].tolist(), pdf["chunk_max_chars"].tolist(), pdf["chunk_overlap_chars"].tolist())
        rows = []
        for uid, text, begin, pieces in zip(pdf["chunk_version_uid"], pdf["text"], pdf["char_start"], plan):
            shift = 0 if pd.isna(begin) else int(begin)
            rows += [(uid, k, a + shift, b + shift, text[a:b]) for k, (a, b) in enumerate(pieces)]
        yield pd.DataFrame(rows, columns=["chunk_version_uid", "piece_no", "char_start", "char_end", "text"])


def rules(governance_config: DataFrame) -> DataFrame:
    """(rule_version, limits), one row per version; the default rule also stands for a null version.

    Overlap counts from 0, a null limit never cuts. Of several rules of one version, or several defaults, the strictest
    limit holds (ties: the least overlap).
    """
    columns = ["chunk_max_chars", F.coalesce("chunk_overlap_chars", F.lit(0)).alias("chunk_overlap_chars")]
    own = governance_config.where("rule_version is not null").select("rule_version", *columns)
    default = governance_config.where("is_default").select(F.lit(None).cast("string").alias("rule_version"), *columns)
    strictest = F.min(F.struct(*[F.col(c.strip()) for c in ("chunk_max_chars", "chunk_overlap_chars")])).alias("r")
    return own.unionByName(default).where("chunk_max_chars > 0").groupBy("rule_version").agg(strictest).select("rule_version", "r.*")


def oversized(chunks: DataFrame, governance_config: DataFrame) -> DataFrame:
    """Chunks longer than the limit of their rule version, once per version uid.

    A null text and an unknown rule version are not oversized; a limit below 1 is not a limit.
    """
    rule = F.broadcast(rules(governance_config))  # one row per rule version
    return (
        chunks.select("chunk_version_uid", "rule_version", "text", "char_start")
        .join(rule, chunks.rule_version.eqNullSafe(rule.rule_version))
        .where("chunk_max_chars > 0 and length(text) > chunk_max_chars")
        .select("chunk_version_uid", "text", F.col("char_start").cast("bigint").alias("char_start"), "chunk_max_chars", "chunk_overlap_chars")
        .dropDuplicates(["chunk_version_uid"])
    )


def split_oversized(chunks: DataFrame, governance_config: DataFrame) -> DataFrame:
    """(chunk_version_uid, piece_no, char_start, char_end, text): pieces of every oversized chunk.

    Offsets count code points from the chunk's own char_start (from 0 where that is null). Pieces cover
    the text, hold at most chunk_max_chars and share exactly chunk_overlap_chars with the one before.
    """
    schema = "chunk_version_uid string, piece_no int, char_start bigint, char_end bigint, text string"
    return oversized(chunks, governance_config).mapInPandas(_split, schema)


def round_trip(pieces: DataFrame, oversized: DataFrame) -> DataFrame:
    """(chunk_version_uid, char_start, char_end, within_limit, overlaps, text_md5) of each chunk put together from its pieces."""
    rule = oversized.select("chunk_version_uid", "chunk_max_chars", F.greatest(F.lit(0), F.least("chunk_overlap_chars", F.col("chunk_max_chars") - 1)).alias("overlap"))
    # The pieces of one chunk hold its text once, plus overlaps.
    whole = pieces.groupBy("chunk_version_uid").agg(F.sort_array(F.collect_list(F.struct("piece_no", "char_start", "char_end", "text"))).alias("p"))
    joined = whole.join(rule, "chunk_version_uid")
    n = F.size("p")
    shared = F.transform(F.slice("p", 2, F.greatest(n - 1, F.lit(0))), lambda x, k: (F.get("p", k)["char_end"] - x["char_start"]) == F.col("overlap"))
    tail = lambda x: F.when(x["piece_no"] == 0, x["text"]).otherwise(F.substring(x["text"], F.col("overlap") + 1, F.length(x["text"])))
    return joined.select(
        "chunk_version_uid", F.col("p")[0]["char_start"].alias("char_start"), F.element_at("p", -1)["char_end"].alias("char_end"),
        F.forall("p", lambda x: F.length(x["text"]) <= F.col("chunk_max_chars")).alias("within_limit"), F.forall(shared, lambda x: x).alias("overlaps"),
        F.md5(F.concat_ws("", F.transform("p", tail))).alias("text_md5"),
    )
