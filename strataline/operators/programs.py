"""Small programs on text and numbers: decimal trees, objects inside model answers, lead sentences."""

from __future__ import annotations

import decimal
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

_CONTEXT = decimal.Context(prec=50, rounding=decimal.ROUND_HALF_UP)
_OPERATIONS = {
    "sum": lambda a, b: _CONTEXT.add(a, b),
    "difference": lambda a, b: _CONTEXT.subtract(a, b),
    "ratio": lambda a, b: _CONTEXT.divide(a, b),
    "percentage": lambda a, b: _CONTEXT.multiply(_CONTEXT.divide(a, b), decimal.Decimal(100)),
    "growth": lambda a, b: _CONTEXT.multiply(_CONTEXT.divide(_CONTEXT.subtract(a, b), b), decimal.Decimal(100)),
}


def evaluate(tree, nodes: dict[str, str]) -> decimal.Decimal | None:
    """The value of a tree: a number, the name of a node, or {"op", "args"} with two arguments.

    Unknown names and operations, divisions by zero and values that are no finite number give None.
    """
    try:
        if isinstance(tree, dict):
            a, b = (evaluate(x, nodes) for x in tree["args"])
            return None if a is None or b is None else _OPERATIONS[tree["op"]](a, b)
        value = decimal.Decimal(str(nodes[tree]) if isinstance(tree, str) and tree in nodes else str(tree))
        return value if value.is_finite() else None
    except (decimal.DecimalException, KeyError, ValueError, TypeError):
        return None


def rounded(value: decimal.Decimal | None, places: int) -> str | None:
    """Half-up to a number of places."""
    return None if value is None else str(value.quantize(decimal.Decimal(1).scaleb(-places), rounding=decimal.ROUND_HALF_UP, context=_CONTEXT))


def run_programs(df: DataFrame, key: str, program: str, nodes: str, places: int = 2) -> DataFrame:
    """(key, value): the rounded value of the JSON program of each row over its JSON map of nodes; null for any fault."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for p, n in zip(pdf[program], pdf[nodes]):
                try:
                    out.append(rounded(evaluate(json.loads(p), json.loads(n or "{}")), places))
                except (TypeError, ValueError):
                    out.append(None)
            yield pd.DataFrame({key: pdf[key], "value": out})

    return df.select(key, program, nodes).mapInPandas(run, f"`{key}` {kind}, value string")


_FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.S)


def first_object(text: str | None) -> dict | None:
    """The first JSON object of a text, in a fence or bare, with trailing commas forgiven; None without one."""
    if not text:
        return None
    fenced = _FENCE.search(text)
    for body in ([fenced[1]] if fenced else []) + [text]:
        for at in (m.start() for m in re.finditer(r"\{", body)):
            for candidate in (body[at:], re.sub(r",\s*([}\]])", r"\1", body[at:])):
                try:
                    value, _ = json.JSONDecoder().raw_decode(candidate)
                    if isinstance(value, dict):
                        return value
                except ValueError:
                    continue
    return None


_SENTENCES = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|\n+")


def lead_sentences(text: str, limit: int = 320) -> str:
    """The first whole sentences that fit the limit, headings and table rows left out; a longer first sentence is cut."""
    out = ""
    for s in (x.strip() for x in _SENTENCES.split(text)):
        if not s or s[0] in "#|":
            continue
        joined = f"{out} {s}".strip()
        if len(joined) > limit:
            return out or s[:limit].rstrip()
        out = joined
    return out
