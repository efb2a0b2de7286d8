"""All queries of the core with their SQL, collected from the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import queries_blocks, queries_corpus, queries_registry, queries_selection, queries_state, queries_text

_MODULES = (queries_corpus, queries_text, queries_selection, queries_state, queries_blocks, queries_registry)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE: dict[str, str] = {k: v for m in _MODULES for k, v in m.ORACLE.items()}
