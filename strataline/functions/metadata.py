"""Coercion and inference of document metadata; nothing here raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def year(col: Column) -> Column:
    """A year from 1900 to 2100, else null."""
    y = F.trim(col.cast("string")).try_cast("int")
    return F.when(y.between(1900, 2100), y)


def iso_date(col: Column) -> Column:
    """A date written year-month-day, else null."""
    return F.try_to_date(F.regexp_extract(col, r"^\s*(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.try_to_timestamp(F.regexp_extract(col, r"^\s*(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd")).cast("date")


# Names of report types.
REPORT_TYPES = {"annual": "annual", "年报": "annual", "年度报告": "annual", "semiannual": "semiannual", "半年报": "semiannual", "interim": "semiannual", "quarterly": "quarterly", "季报": "quarterly"}


def report_type(col: Column) -> Column:
    pairs = [x for kv in REPORT_TYPES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(col)))


def first_match(pattern: str, *cols: Column, group: int = 1) -> Column:
    """The first match of a pattern in the first of the columns that has one."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, pattern, group), F.lit("")) for c in cols])


def first_known(**sources: Column) -> tuple[Column, Column]:
    """(value, name of its source) of the first source, in order, that is not null."""
    value = F.coalesce(*sources.values())
    name = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in sources.items()])
    return value, name


def canonical_url(col: Column) -> Column:
    """Without scheme, ``www.`` or ``m.``, query and final slash, in lower case; null and empty stay null."""
    bare = F.regexp_replace(F.lower(F.trim(col)), r"^(?:https?:)?//(?:www\.|m\.)?", "")
    return F.nullif(F.regexp_replace(F.regexp_replace(bare, r"[?#].*$", ""), "/+$", ""), F.lit(""))
