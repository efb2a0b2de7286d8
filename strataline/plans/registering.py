"""A decorator that files a query under its name together with its SQL."""

from __future__ import annotations

from collections.abc import Callable


def registry():
    """(QUERIES, ORACLE, query): ``@query(sql)`` files the function; without SQL there is no oracle."""
    queries: dict[str, Callable] = {}
    oracle: dict[str, str] = {}

    def query(sql: str | None = None):
        def add(f: Callable) -> Callable:
            queries[f.__name__] = f
            if sql:
                oracle[f.__name__] = sql
            return f

        return add

    return queries, oracle, query
