"""Contracts on records: messages, regions, answers, line-edit gates. Null input never satisfies a contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid_messages(messages: Column, exactly: int | None = None) -> Column:
    """A system message, then pairs of user and assistant, none of them blank; with ``exactly`` that many in all.

    ``messages`` is an array of structs with role and content.
    """
    role = lambda i: F.when(i == 0, "system").when(i % 2 == 1, "user").otherwise("assistant")
    right = F.transform(messages, lambda m, i: (m["role"] == role(i)) & (F.length(F.trim(m["content"])) > 0))
    n = F.size(messages)
    shape = (n >= 3) & (n % 2 == 1) if exactly is None else n == exactly
    return F.coalesce(shape & F.forall(right, lambda x: F.coalesce(x, F.lit(False))), F.lit(False))


def image_marks(messages: Column, mark: str = "<image>") -> Column:
    """How often the image mark stands in all messages."""
    return F.aggregate(messages, F.lit(0), lambda n, m: n + F.coalesce(F.regexp_count(m["content"], F.lit(mark)), F.lit(0)))


def valid_regions(regions: Column, most: int = 12, side: int = 1000) -> Column:
    """1 to ``most`` boxes [left, top, right, bottom] inside 0..side with positive extent."""
    at = lambda b, i: F.try_element_at(b, F.lit(i))
    box = lambda b: (F.size(b) == 4) & F.forall(b, lambda x: (x >= 0) & (x <= side)) & (at(b, 1) < at(b, 3)) & (at(b, 2) < at(b, 4))
    return F.coalesce(F.size(regions).between(1, most) & F.forall(regions, lambda b: F.coalesce(box(b), F.lit(False))), F.lit(False))


def accepted_answer(status: Column, checks: Column) -> Column:
    """accept, reject or revise; accept counts only if every check of the map is true."""
    whole = F.forall(F.map_values(checks), lambda x: F.coalesce(x, F.lit(False)))
    known = F.lower(F.trim(status))
    return F.when((known == "accept") & F.coalesce(whole, F.lit(False)), "accept").when(known.isin("reject", "revise"), known).otherwise("invalid")


def same_markers(before: Column, after: Column, pattern: str) -> Column:
    """Whether two texts hold the same matches of a pattern, each as often."""
    found = lambda c: F.array_sort(F.regexp_extract_all(c, F.lit(pattern), 0))
    return found(before) == found(after)


def first_reason(*ladder: tuple[str, Column]) -> Column:
    """The name of the first condition that holds, or null; a null condition does not hold."""
    out = F.lit(None).cast("string")
    for name, condition in reversed(ladder):
        out = F.when(F.coalesce(condition, F.lit(False)), name).otherwise(out)
    return out


def download_problem(message: Column) -> Column:
    """A code for the message of a failed download."""
    low = F.lower(message)
    return first_reason(
        ("timeout", F.contains(low, F.lit("timed out")) | F.contains(low, F.lit("timeout"))),
        ("blocked", F.contains(low, F.lit("403")) | F.contains(low, F.lit("captcha"))),
        ("missing", F.contains(low, F.lit("404"))),
        ("invalid", F.contains(low, F.lit("pdf"))),
        ("other", message.isNotNull()),
    )
