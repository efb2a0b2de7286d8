"""Queries of the training-data operators over the standard tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import budget, crossing, groups, history, leakage, mixing, pieces, repair, stuffing


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Cases tied to a case of another recorded split."""
    placed, _ = groups.case_components(*(read_table(spark, d, t) for t in ("agent_cases", "chunks", "local_documents")))
    return groups.split_conflicts(placed)


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    """Every valid case with its component and assigned split."""
    return groups.splits(*(read_table(spark, d, t) for t in ("agent_cases", "chunks", "local_documents")))


def p1_chunk_splits(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk with the split of its work."""
    return groups.chunk_splits(*(read_table(spark, d, t) for t in ("agent_cases", "chunks", "local_documents")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that were cut: those with a second piece."""
    cut = pieces.split_oversized(read_table(spark, d, "chunks"), read_table(spark, d, "governance_config"))
    return cut.where("piece_no = 1").select("chunk_version_uid")


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of every oversized chunk."""
    return pieces.split_oversized(read_table(spark, d, "chunks"), read_table(spark, d, "governance_config"))


def p2_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Each oversized chunk put together again from its pieces: its range, whether all pieces keep the limit, its text's digest."""
    chunks, config = read_table(spark, d, "chunks"), read_table(spark, d, "governance_config")
    return pieces.round_trip(pieces.split_oversized(chunks, config), pieces.oversized(chunks, config))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pending samples and their same or near-same earlier samples, asked against the stored index of the history."""
    corpus, index = read_table(spark, d, "corpus"), read_table(spark, d, "dedup_index")
    return history.duplicates_of_pending(corpus, index, path=history.index_path(spark, d))


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return budget.sample_tokens(read_table(spark, d, "quality_report"), read_table(spark, d, "corpus"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Coverage targets whose slice holds too little."""
    return budget.coverage(_samples(spark, d), read_table(spark, d, "coverage_targets")).where("too_little").select("source_name", "language", "domain")


def p4_totals(spark: SparkSession, d: str) -> DataFrame:
    """Token totals by source, language and domain."""
    return budget.slice_totals(_samples(spark, d))


def p4_samples(spark: SparkSession, d: str) -> DataFrame:
    """The tokens of each sample, known or estimated."""
    return _samples(spark, d)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks with damage, by kind."""
    return repair.damage(read_table(spark, d, "chunks"))


def p5_repaired(spark: SparkSession, d: str) -> DataFrame:
    """The repaired text of every chunk and the kinds of damage it had."""
    out = repair.repaired_chunks(read_table(spark, d, "chunks"))
    return out.withColumn("damage", F.concat_ws(",", "damage"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of an evaluation sample and a same or near-same training sample."""
    return crossing.crossing_pairs(read_table(spark, d, "corpus"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps with train per evaluation split and source."""
    return crossing.crossing_report(read_table(spark, d, "corpus"), read_table(spark, d, "quality_report"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a passage of an evaluation item word for word."""
    return leakage.shared_passages(read_table(spark, d, "documents"), read_table(spark, d, "eval_items")).where("whole").select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Passages shared word for word or with edits, with their place and edit distance."""
    return leakage.shared_passages(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources that cannot fill their share."""
    return mixing.mixture_report(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets")).where("short").select("source")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Wanted and reached shares of every target source."""
    return mixing.mixture_report(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The texts of the mix with their uses."""
    return mixing.mixture(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.page_scores(read_table(spark, d, "documents"), stuffing.prose_texts(read_table(spark, d, "corpus")))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Pages stuffed with keywords, links or product tags."""
    return _scores(spark, d).where("stuffed").select("doc_id").distinct()


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    """The scores of every page."""
    return _scores(spark, d)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_splits, p1_chunk_splits, p2_found, p2_pieces, p2_round_trip, p3_found, p4_found, p4_totals, p4_samples,
        p5_found, p5_repaired, p6_found, p6_report, p7_found, p7_leaks, p8_found, p8_report, p8_mix,
        p9_found, p9_scores,
    )
}

ORACLE: dict[str, str] = {
    "p1_found": r"""
        WITH RECURSIVE c AS (
            SELECT case_id, arg_max(struct_pack(s := split, g := grouping, e := evidence_chunks), updated_at) AS r FROM agent_cases GROUP BY 1
        ), k AS (
            SELECT case_id, lower(trim(r.s)) AS split, lower(trim(r.g.base_snapshot_group)) AS snap,
                   regexp_replace(lower(trim(r.g.source_group)), '^work-', '') AS work, r.e AS e FROM c
        ), works AS (
            SELECT case_id, work FROM k WHERE work NOT IN ('', 'unknown', 'n/a')
            UNION SELECT v.case_id, h.work_uid FROM (SELECT case_id, unnest(e) AS u FROM k) v JOIN chunks h ON h.chunk_version_uid = v.u
        ), states AS (
            SELECT document_uid, arg_max(struct_pack(w := work_uid, s := stock_code), updated_at) AS r FROM local_documents GROUP BY 1
        ), issuers AS (
            SELECT DISTINCT r.w AS work, regexp_extract(r.s, '([0-9]{6})', 1) AS issuer FROM states
        ), edges AS (
            SELECT 'c' || case_id AS a, 'w' || work AS b FROM works
            UNION SELECT 'w' || work, 'i' || issuer FROM issuers WHERE issuer NOT IN ('', '000000')
            UNION SELECT 'c' || case_id, 's' || snap FROM k WHERE snap NOT IN ('', 'unknown', 'n/a')
        ), step AS (
            SELECT a, b FROM edges UNION SELECT b, a FROM edges
        ), reach AS (
            SELECT 'c' || case_id AS a, 'c' || case_id AS b FROM k UNION SELECT r.a, s.b FROM reach r JOIN step s ON r.b = s.a
        )
        SELECT DISTINCT x.case_id FROM reach r JOIN k x ON 'c' || x.case_id = r.a JOIN k y ON 'c' || y.case_id = r.b
        WHERE x.split IN ('train', 'validation', 'test') AND y.split IN ('train', 'validation', 'test') AND x.split <> y.split
    """,
    "p2_found": """
        SELECT DISTINCT c.chunk_version_uid
        FROM chunks c JOIN governance_config g
          ON c.rule_version = g.rule_version OR (c.rule_version IS NULL AND g.is_default)
        WHERE length(c.text) > g.chunk_max_chars
    """,
    "p2_round_trip": """
        SELECT c.chunk_version_uid, any_value(coalesce(c.char_start, 0)) AS char_start, any_value(coalesce(c.char_start, 0) + length(c.text)) AS char_end,
               TRUE AS within_limit, TRUE AS overlaps, any_value(md5(c.text)) AS text_md5
        FROM chunks c JOIN governance_config g ON c.rule_version = g.rule_version OR (c.rule_version IS NULL AND g.is_default)
        WHERE length(c.text) > g.chunk_max_chars GROUP BY 1
    """,
}
