"""Text expressions. All are built-in functions, so they stay inside generated code and reach the scan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = r"[ \t\n\r\f\x0B]+"
# What counts as an e-mail address and as a phone number; (?U) reads \w and \d as Unicode classes.
EMAIL = r"(?U)(?<![\w.+-])[\w.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?![\w.-])"
PHONE = r"(?U)(?<!\d)(?:\+?86[-\s]?)?(?:1[3-9](?:[-\s]?\d){9}|0\d{2,3}[-\s]?\d{7,8})(?!\d)"
NUMBER = r"[+-]?[0-9]+(?:[,.][0-9]+)*%?"


def collapsed(text: Column) -> Column:
    """Lower-case, runs of ASCII white space one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), _BLANKS, " "))


def content_hash(text: Column) -> Column:
    return F.sha2(collapsed(text), 256)


def stable_uid(*parts: Column, length: int = 32) -> Column:
    """Prefix of the SHA-256 of the trimmed parts joined by a bar; a null part reads ``None``."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(F.trim(p), F.lit("None")) for p in parts]), 256), 1, length)


def hash_fraction(key: Column) -> Column:
    """A fixed fraction in [0, 1] from the first 32 bits of the SHA-256 of a key."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint") / F.lit(4294967295.0)


def redacted(text: Column) -> Column:
    """E-mail addresses first, then phone numbers, replaced by marks; nothing else is changed."""
    return F.regexp_replace(F.regexp_replace(text, EMAIL, "<EMAIL>"), PHONE, "<PHONE>")


def contacts(text: Column) -> tuple[Column, Column]:
    """Numbers of e-mail addresses, and of phone numbers outside them."""
    return F.regexp_count(text, F.lit(EMAIL)), F.regexp_count(F.regexp_replace(text, EMAIL, "<EMAIL>"), F.lit(PHONE))


def numbers(text: Column) -> Column:
    """All numbers in order."""
    return F.regexp_extract_all(text, F.lit(NUMBER), 0)


def guard_signature(text: Column) -> Column:
    """The ordered numbers of a text as one string; equal strings mean no changed figure."""
    return F.concat_ws(" ", numbers(text))


def han_share(text: Column, head: int = 4000) -> Column:
    """Share of Chinese characters among the first ``head`` characters, the reach the detection is defined on."""
    start = F.substring(text, 1, head)
    return F.regexp_count(start, F.lit("[一-鿿]")) / F.greatest(F.length(start), F.lit(1))


def detected_language(text: Column) -> Column:
    return F.when(han_share(text) > 0.15, "zh").otherwise("en")


# Fixed value: a word of the score and of topics.
WORD = r"[A-Za-z][A-Za-z\-]{2,}"


def long_word_score(text: Column) -> Column:
    """100 less 400 times the share of words of 18 letters or more, rounded half to even, clamped to 0..100; 0 without words."""
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    share = F.size(F.filter(words, lambda w: F.length(w) >= 18)) / F.nullif(F.size(words), F.lit(0))
    return F.coalesce(F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.bround(100 - 400 * share))), F.lit(0.0))


# Words that are no topics.
TOPIC_STOP = """
the and for with that this from are was were has have been their its into which where when while also will can may not but
than then such more most through between about after before under over
""".split()


def topic_words(text: Column) -> Column:
    """The words of four letters or more that may be topics, in lower case, in order."""
    words = F.transform(F.regexp_extract_all(text, F.lit(WORD), 0), F.lower)
    return F.filter(words, lambda w: (F.length(w) >= 4) & ~w.isin(TOPIC_STOP))


def title_case(word: Column) -> Column:
    """Each part between hyphens with a capital."""
    return F.array_join(F.transform(F.split(word, "-"), F.initcap), "-")


# Bounds of a noise line.
LEAST_ALNUM, ENDLESS_WORD, CLUSTERED_WORD = 0.35, 30, 20
CONSONANTS = "(?i)[bcdfghjklmnpqrstvwxyz]{4,}"


def noise_line(text: Column) -> Column:
    """Blank, without letters and digits, mostly other characters, an endless word, or two clusters of consonants beside a long word."""
    alnum = F.regexp_count(text, F.lit(r"[\p{L}\p{N}]"))
    longest = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(text, F.lit("[A-Za-z]+"), 0), F.length)), F.lit(0))
    clusters = F.regexp_count(text, F.lit(CONSONANTS))
    return (alnum == 0) | (alnum / F.greatest(F.length(text), F.lit(1)) < LEAST_ALNUM) | (longest >= ENDLESS_WORD) | ((clusters >= 2) & (longest >= CLUSTERED_WORD))


def stripped(text: Column) -> Column:
    """Without any white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def heading_level(text: Column, label: Column | None = None) -> Column:
    """Marks in front, else 1 for a document title, 2 for an abstract, 3 for a numbered paragraph title, else 2."""
    clean = stripped(text)
    marks = F.length(F.regexp_extract(clean, r"^(#{1,6})\s", 1))
    kind = label if label is not None else F.lit("")
    return (
        F.when(marks > 0, marks)
        .when(kind == "doc_title", 1)
        .when(kind == "abstract", 2)
        .when((kind == "paragraph_title") & clean.rlike(r"^\p{Nd}+(\.\p{Nd}+)*\.?\s"), 3)
        .otherwise(2)
    )


# Fixed value: the whole of a heading that opens a list of sources.
REFERENCE_HEADING = (
    r"(?i)^\s*(?:#{1,6}\s+)?(?:第\s*[0-9一二三四五六七八九十百零〇]+\s*(?:章|节)?\s*|[0-9一二三四五六七八九十百零〇]+(?:\s*\.\s*[0-9]+)*\s*[.、)）]?\s*)?"
    r"(?:参考文献|参考资料|references?|bibliography)\s*[:：]?\s*$"
)


def reference_heading(line: Column) -> Column:
    return line.rlike(REFERENCE_HEADING)


# Content types of layout labels; any other label is a paragraph.
CONTENT_TYPES = {
    "header": "noise", "footer": "noise", "number": "noise", "vision_footnote": "noise", "doc_title": "heading", "abstract": "paragraph",
    "paragraph_title": "heading", "table": "table", "formula": "formula", "image": "figure", "chart": "figure", "figure_title": "caption",
    "reference": "reference", "footnote": "footnote", "algorithm": "algorithm", "text": "paragraph",
}


def content_type(label: Column) -> Column:
    pairs = [x for kv in CONTENT_TYPES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), F.lit("paragraph"))


def governed_part(text: Column, label: Column) -> Column:
    """A block as it stands in governed Markdown: a heading without marks gets those of its level."""
    clean = stripped(text)
    bare = (content_type(label) == "heading") & ~clean.startswith("#")
    return F.when(bare, F.concat(F.repeat(F.lit("#"), heading_level(text, label)), F.lit(" "), clean)).otherwise(clean)
