"""Label clean-up shared by reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(col: Column) -> Column:
    """Lower-case, trimmed; null and empty become ``unknown``."""
    return F.coalesce(F.nullif(F.lower(F.trim(col)), F.lit("")), F.lit("unknown"))


def language_label(col: Column) -> Column:
    """As :func:`label`, without a regional suffix (``en-GB`` and ``en_GB`` become ``en``)."""
    return label(F.regexp_replace(F.trim(col), r"[-_].*$", ""))


def split_label(col: Column) -> Column:
    """Lower-case, trimmed split; null and empty stay null."""
    return F.nullif(F.lower(F.trim(col)), F.lit(""))


def latest(df, key, order):
    """One row per ``key``: the one with the greatest ``order``; ties fall to the greatest remaining values.

    A struct maximum combines on the map side, unlike a ranking window.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != order]
    best = F.max(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in rest])).alias("_s")
    return df.groupBy(*keys).agg(best).select(*keys, F.col("_s._o").alias(order), *[F.col(f"_s.{c}").alias(c) for c in rest])
