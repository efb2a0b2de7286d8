"""Evaluation texts leaking into training text (problem 7).

A passage of an item leaks if a document holds it with at most a budget of word edits. Items are cut into pieces so
short that a passage holds one more whole piece than the budget: wherever the edits fall, one piece is left intact.
All pieces form one automaton that finds their exact hits in a document in one walk. Around each hit Myers'
bit-parallel distance of the passages through the piece to the document's words decides, and rejects pieces that
merely stand in both. The run of equal words through a hit is measured as well; passages shared word for word are
those whose run is as long as a passage.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shortest shared run of words that counts, in general and for items in zh, where each Han character is a word.
RUN, RUN_ZH = 13, 40
#: Items of one automaton; a larger set of items is searched in blocks, each over all documents.
BLOCK = 20_000

_HAN = "々〇〡-〩〸-〻㐀-䶿一-鿿豈-舘並-龎\U00020000-\U000323af"
_WORD = re.compile(f"[{_HAN}]|[^\\W_{_HAN}]+")

#: One word edit is allowed for so many words of a passage.
WORDS_PER_EDIT = 13

_FOUND = "doc_id bigint, item_id bigint, run int, whole boolean, item_words int, distance int, item_at int, doc_at int"


def words(text: str) -> list[str]:
    """Words under NFKC and case-folding: one Han character or a longest run of other letters and digits."""
    return _WORD.findall(unicodedata.normalize("NFKC", text).casefold())


def myers_search(pattern: list[str], text: list[str]) -> int:
    """Least edit distance of ``pattern`` to any stretch of ``text``, by Myers' bit-vectors over words."""
    m = len(pattern)
    if not m:
        return 0
    full, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = {}
    for k, w in enumerate(pattern):
        at[w] = at.get(w, 0) | 1 << k
    pv, mv, score, best = full, 0, m, m
    for w in text:
        eq = at.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv
        best = min(best, score)
    return best


class Pieces:
    """The pieces of a set of items and the automaton over them."""

    def __init__(self, items: list[tuple[int, str, str]], words_per_edit: int = WORDS_PER_EDIT):
        import ahocorasick

        self.items = {}
        self.automaton = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, lang, text in items:
            own, run = words(text), RUN_ZH if lang.startswith("zh") else RUN
            budget = run // words_per_edit
            # Wherever a passage begins, at least (run - piece + 1) // piece >= budget + 1 pieces lie in it.
            piece = (run + 1) // (budget + 2)
            self.items[item_id] = own, run, piece, budget
            for k in range(0, len(own) - piece + 1, piece):
                found.setdefault(" " + " ".join(own[k : k + piece]) + " ", []).append((item_id, k))
        for key, where in found.items():
            self.automaton.add_word(key, (len(key), where))
        if found:
            self.automaton.make_automaton()

    @staticmethod
    def distance(item: list[str], own: list[str], k: int, at: int, run: int, piece: int, budget: int) -> int:
        """Least edit distance of a passage of ``item`` through its piece ``k`` to the words around ``at``; budget + 1 if above the budget."""
        low, high = max(0, k + piece - run), min(len(item), k + run)
        near = own[max(0, at - (k - low) - budget) : at + high - k + budget]
        held = set(near)
        match = [w in held for w in item[low:high]]
        best = budget + 1
        for start in range(low, high - run + 1):
            # A passage with more words than the budget that do not stand there at all is farther than the budget.
            if start <= k and sum(match[start - low : start - low + run]) >= run - best + 1:
                best = min(best, myers_search(item[start : start + run], near))
                if not best:
                    break
        return best

    def search(self, text: str) -> Iterator[tuple[int, int, bool, int, int, int, int]]:
        """(item_id, run, whole, item_words, distance, item_at, doc_at): the longest run of each item that leaks."""
        if not len(self.automaton):
            return
        own = words(text)
        line = " " + " ".join(own) + " "
        starts, best, covered = None, {}, {}
        for end, (length, where) in self.automaton.iter(line):
            if starts is None:
                starts = {c: k for k, c in enumerate(accumulate((len(w) + 1 for w in own), initial=0))}
            at = starts[end - length + 1]
            for item_id, k in where:
                item, run, piece, budget = self.items[item_id]
                if len(item) < run or covered.get((item_id, at - k), -1) >= at:
                    continue  # no passage, or inside a run already measured
                a, b = k, at
                while a and b and item[a - 1] == own[b - 1]:
                    a, b = a - 1, b - 1
                c, d = k + piece, at + piece
                while c < len(item) and d < len(own) and item[c] == own[d]:
                    c, d = c + 1, d + 1
                covered[item_id, at - k] = d - 1
                distance = self.distance(item, own, k, at, run, piece, budget)
                if distance <= budget and (c - a, -distance) > best.get(item_id, (0,))[:2]:
                    best[item_id] = c - a, -distance, a, b
        for item_id, (length, distance, a, b) in best.items():
            item, run, *_ = self.items[item_id]
            yield item_id, length, length >= run, len(item), -distance, a, b


def shared_passages(documents: DataFrame, eval_items: DataFrame, words_per_edit: int = WORDS_PER_EDIT) -> DataFrame:
    """One row per document and item of which it holds a passage, edited by at most one word in ``words_per_edit``.

    ``run`` is the longest run of equal words through a piece, ``whole`` tells that it is as long as a passage,
    ``distance`` is the least word edit distance of a passage. Rows with a null id or text are left out; an item
    shorter than a passage gives nothing. Items are the stated query set, searched in blocks of BLOCK; the automaton of
    a block is built once and broadcast.
    """
    rows = eval_items.where("item_id is not null and text is not null").select("item_id", F.lower(F.trim(F.coalesce("lang", F.lit("")))).alias("lang"), "text").distinct()
    items = [tuple(r) for r in rows.orderBy("item_id").toLocalIterator()]
    docs = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    context = documents.sparkSession.sparkContext
    out = None
    for k in range(0, max(1, len(items)), BLOCK):
        shared = context.broadcast(Pieces(items[k : k + BLOCK], words_per_edit))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            pieces = shared.value
            for pdf in batches:
                hits = [(doc_id, *hit) for doc_id, text in zip(pdf["doc_id"], pdf["text"]) for hit in pieces.search(text)]
                yield pd.DataFrame(hits, columns=["doc_id", "item_id", "run", "whole", "item_words", "distance", "item_at", "doc_at"])

        part = docs.mapInPandas(run, _FOUND)
        out = part if out is None else out.unionByName(part)
    return out
