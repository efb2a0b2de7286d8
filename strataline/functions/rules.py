"""The rule sets of quality control, as conditions for operators.state.checks: name -> (severity if it does not hold, condition).

A condition that is null does not hold. Names, severities and forms are fixed values of the published reports.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIX_DIGITS = "^[0-9]{6}$"
REPORT_TYPES = ("annual", "semiannual", "quarterly", "research")
REQUIRED = ("document_uid", "asset_uid", "stock_code", "company_name", "report_year", "report_type", "title", "source_name", "language", "raw_file_hash")
#: A title with one of these is not the full report.
PARTIAL_TITLES = ("摘要", "英文", "取消")

Rules = dict[str, tuple[str, Column]]


def _given(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string") != "", F.lit(False))


def title_year(title: Column) -> Column:
    """The first year from 2000 on that stands alone among digits, else null."""
    return F.nullif(F.regexp_extract(title, r"(?<![0-9])(20[0-9]{2})(?![0-9])", 1), F.lit("")).cast("int")


def candidate_rules() -> Rules:
    """For stock_code, source_url, title and report_year of a discovered report."""
    title = F.col("title")
    partial = title.contains(PARTIAL_TITLES[0]) | title.contains(PARTIAL_TITLES[1]) | title.contains(PARTIAL_TITLES[2])
    return {
        "stock_code_format": ("fail", F.col("stock_code").rlike(SIX_DIGITS)),
        "source_url_https": ("warn", F.col("source_url").startswith("https://")),
        "title_has_report_year": ("fail", title_year(title) == F.col("report_year")),
        "title_is_full_report": ("fail", ~partial),
    }


def scholarly_candidate_rules() -> Rules:
    """For work_uid, title, source_url and metadata_hash of a discovered article."""
    return {
        "scholarly_work_uid_present": ("fail", _given("work_uid")),
        "scholarly_title_present": ("fail", F.trim("title") != ""),
        "scholarly_source_url": ("warn", F.col("source_url").startswith("https://")),
        "scholarly_metadata_hash_present": ("fail", _given("metadata_hash")),
    }


def financial_metadata_rules() -> Rules:
    """For the normalized metadata of a report, with its announcement_date as text; hints only, nothing fails."""
    year, titled = F.col("report_year").try_cast("int"), title_year(F.col("title"))
    date = F.col("announcement_date")
    held = [_given(c) for c in REQUIRED]
    all_held = held[0]
    for x in held[1:]:
        all_held &= x
    return {
        "metadata_required_fields": ("warn", all_held),
        "metadata_stock_code_format": ("warn", F.col("stock_code").rlike(SIX_DIGITS)),
        "metadata_report_type": ("warn", F.col("report_type").isin(*REPORT_TYPES)),
        "metadata_report_year": ("warn", year.between(1990, 2100)),
        "metadata_title_year_consistency": ("warn", year.isNotNull() & (titled.isNull() | (titled == year))),
        "metadata_announcement_date": ("warn", date.isNull() | (date == "") | (date.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & date.try_cast("date").isNotNull())),
        "metadata_raw_hash": ("warn", F.col("raw_file_hash").rlike("^[0-9a-f]{64}$")),
    }


def raw_asset_rules() -> Rules:
    """For a stored file: raw_path, its inspection (exists, pdf_valid, actual_size, actual_hash, page_count), file_size and raw_file_hash."""
    path = F.col("raw_path")
    safe = ~path.startswith("/") & ~path.rlike(r"(^|/)\.\.(/|$)")
    return {
        "asset_path_present": ("fail", _given("raw_path")),
        "asset_path_safe": ("fail", safe),
        "asset_exists": ("fail", F.col("exists")),
        "pdf_structure": ("fail", F.col("pdf_valid")),
        "file_size_matches": ("fail", F.col("file_size").isNull() | (F.col("file_size") == F.col("actual_size"))),
        "raw_hash_matches": ("fail", F.col("raw_file_hash") == F.col("actual_hash")),
        "page_count_available": ("warn", F.col("page_count") > 0),
    }


def governed_document_rules() -> Rules:
    """For a governed document: governed_uid, n_blocks, char_count, work_uid, asset_uid, input_path."""
    return {
        "governed_uid_present": ("fail", _given("governed_uid")),
        "governed_blocks_nonempty": ("fail", F.col("n_blocks") > 0),
        "governed_text_nonempty": ("fail", F.col("char_count") > 0),
        "governed_lineage": ("fail", _given("work_uid") & _given("asset_uid") & _given("input_path")),
    }
