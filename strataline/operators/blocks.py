"""From marked-up text to blocks and from blocks to chunks.

The state machines here cannot be said in built-in expressions; they run over Arrow batches of whole
documents, one document after the other, and nothing is shuffled.
"""

from __future__ import annotations

import html.parser
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

_ZERO_WIDTH = dict.fromkeys(map(ord, "​‌‍⁠﻿"))


def normalize_text(value: str) -> str:
    """NFKC, no zero-width characters, single blanks, at most one empty line in a row, trimmed."""
    text = unicodedata.normalize("NFKC", value).translate(_ZERO_WIDTH).replace(" ", " ")
    text = re.sub(r"[ \t]+", " ", text)
    text = re.sub(r" ?\n ?", "\n", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


class _Table(html.parser.HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.places: list[tuple[int, int]] = []
        self.open = False

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.row()
        elif tag in ("td", "th"):
            if not self.rows:
                self.row()
            self.rows[-1].append("")
            self.open = True
        elif tag == "br" and self.open:
            self.rows[-1][-1] += " "

    def row(self):
        self.rows.append([])
        self.places.append(self.getpos())

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.rows[-1][-1] += data


def html_table_to_markdown(value: str) -> str:
    """A pipe table with a rule under its first row; ragged rows are filled, blank ones left out, pipes escaped. Without filled cells the normalized text."""
    parser = _Table()
    parser.feed(value)
    rows = [[re.sub(r"\s+", " ", c).strip().replace("|", r"\|") for c in r] for r in parser.rows if any(c.strip() for c in r)]
    if not rows:
        return normalize_text(value)
    width = max(map(len, rows))
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
    return "\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]])


def _table_places(value: str) -> list[tuple[int, int]]:
    """Where each line of ``html_table_to_markdown(value)`` lies in ``value``; rule and empty lines have no length."""
    parser = _Table()
    parser.feed(value)
    lines = [m.start() for m in re.finditer("^", value, re.M)]
    starts = [lines[line - 1] + column for (line, column), row in zip(parser.places, parser.rows) if any(c.strip() for c in row)]
    if starts:
        spans = [(a, a + len(value[a:b].rstrip())) for a, b in zip(starts, [*starts[1:], len(value)])]
        return [spans[0], (spans[0][1],) * 2, *spans[1:]]
    filled = iter([m.span() for m in re.finditer(r"[^\n]+", value) if normalize_text(m[0])])
    spans, end = [], 0
    for line in html_table_to_markdown(value).split("\n"):
        start, end = next(filled, (end, end)) if line.strip() else (end, end)
        spans.append((start, end))
    return spans


@dataclass
class Block:
    """A piece of a document: its kind, its text, its place and, for headings, its level, for tables, the places of its lines."""

    kind: str
    text: str
    start: int
    end: int
    level: int = 0
    lines: list[tuple[int, int]] = field(default_factory=list)


_HTML_TABLE = re.compile(r"<table\b.*?</table\s*>", re.S | re.I)
_HEADING = re.compile(r"^(#{1,6})\s+(.*)$")


def markdown_blocks(text: str) -> list[Block]:
    """HTML tables, then headings, pipe tables and paragraphs, in order, with their offsets."""
    out: list[Block] = []

    def plain(part: str, shift: int) -> None:
        at, pending = 0, []

        def flush() -> None:
            if pending:
                kind = "table" if all(line.lstrip().startswith("|") for _, line in pending) else "paragraph"
                whole = "\n".join(line for _, line in pending)
                body = whole.strip()
                if body:
                    start = shift + pending[0][0] + len(whole) - len(whole.lstrip())
                    lines = [(shift + at, shift + at + len(line)) for at, line in pending] if kind == "table" else []
                    out.append(Block(kind, body, start, start + len(body), lines=lines))
                pending.clear()

        for line in part.split("\n"):
            heading = _HEADING.match(line)
            is_row = line.lstrip().startswith("|")
            if heading:
                flush()
                out.append(Block("heading", heading[2].strip(), shift + at, shift + at + len(line), len(heading[1])))
            elif not line.strip():
                flush()
            else:
                if pending and pending[-1][1].lstrip().startswith("|") != is_row:
                    flush()
                pending.append((at, line))
            at += len(line) + 1
        flush()

    done = 0
    for m in _HTML_TABLE.finditer(text):
        plain(text[done : m.start()], done)
        lines = [(m.start() + a, m.start() + b) for a, b in _table_places(m[0])]
        out.append(Block("table", html_table_to_markdown(m[0]), m.start(), m.end(), lines=lines))
        done = m.end()
    plain(text[done:], done)
    return out


_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])")


def pack(text: str, limit: int, least: int) -> list[str]:
    """Pieces of at most ``limit`` characters: whole sentences while they fit, hard cuts at the last blank past the half."""
    pieces: list[str] = []
    current = ""
    for sentence in filter(None, (s.strip() for s in _SENTENCE.split(text))):
        while len(sentence) > limit:
            room = limit - len(current) - bool(current)
            if current and room < limit // 2:
                pieces.append(current)
                current, room = "", limit
            cut = sentence.rfind(" ", room // 2, room + 1)
            cut = room if cut <= 0 else cut
            current = f"{current} {sentence[:cut]}".strip()
            pieces.append(current)
            current, sentence = "", sentence[cut:].strip()
        joined = f"{current} {sentence}".strip()
        if len(joined) > limit:
            pieces.append(current)
            joined = sentence
        current = joined
    if current:
        pieces.append(current)
    if len(pieces) > 1 and len(pieces[-1]) < least and len(pieces[-2]) + 1 + len(pieces[-1]) <= limit:
        pieces[-2:] = [f"{pieces[-2]} {pieces[-1]}"]
    return pieces


def piece_places(text: str, pieces: list[str]) -> list[tuple[int, int]]:
    """Where each piece of ``pack(text, ...)`` lies in ``text``: a cursor moves over the characters that are not blank,
    as blanks between sentences are all that packing changes."""
    filled = [k for k, c in enumerate(text) if not c.isspace()]
    places, cursor = [], 0
    for piece in pieces:
        n = sum(not c.isspace() for c in piece)
        places.append((filled[cursor], filled[cursor + n - 1] + 1))
        cursor += n
    return places


def split_table(text: str, rows: int) -> list[str]:
    """A pipe table in parts of ``rows`` body rows, each under the two head rows."""
    lines = text.split("\n")
    head, body = lines[:2], lines[2:]
    return ["\n".join(head + body[k : k + rows]) for k in range(0, max(1, len(body)), rows)]


def table_places(block: Block, rows: int) -> list[tuple[int, int]]:
    """Where the own rows of each part of ``split_table`` lie; the first part begins with the table, the last ends with it."""
    starts = [block.start, *(block.lines[k][0] for k in range(2 + rows, len(block.lines), rows))]
    ends = [*(block.lines[k - 1][1] for k in range(2 + rows, len(block.lines), rows)), block.end]
    return list(zip(starts, ends))


@dataclass
class Chunk:
    """A chunk with the headings above it."""

    kind: str
    context: str
    text: str
    start: int
    end: int
    blocks: int = 1
    parts: list[Block] = field(default_factory=list)


def chunk_blocks(blocks: list[Block], limit: int = 2000, least: int = 80) -> list[Chunk]:
    """Sections up to ``limit`` characters under their heading path; tables stand alone; a short tail joins the chunk before.

    A chunk lies from its first to its last character in the text that gave the blocks; the head rows that the later
    parts of a table repeat are not counted.
    """
    chunks: list[Chunk] = []
    stack: list[tuple[int, str]] = []
    section: Chunk | None = None

    def close() -> None:
        nonlocal section
        if section:
            body = "\n\n".join(b.text for b in section.parts)
            placed = [(body, section.start, section.end)]
            if len(body) > limit:
                packed = [(b, pack(b.text, limit, least)) for b in section.parts]
                placed = [(p, b.start + x, b.start + y) for b, made in packed for p, (x, y) in zip(made, piece_places(b.text, made))]
            for piece, start, end in placed:
                last = chunks[-1] if chunks else None
                if last and last.kind == "section" and last.context == section.context and len(piece) < least and len(last.text) + len(piece) + 2 <= limit:
                    last.text, last.end = last.text + "\n\n" + piece, end
                else:
                    chunks.append(Chunk("section", section.context, piece, start, end, section.blocks))
        section = None

    for b in blocks:
        if b.kind == "heading":
            close()
            while stack and stack[-1][0] >= b.level:
                stack.pop()
            stack.append((b.level, b.text))
            continue
        context = " > ".join(t for _, t in stack)
        if b.kind == "table":
            close()
            rows = max(5, min(30, limit // 120))
            chunks += [Chunk("table", context, part, *place) for part, place in zip(split_table(b.text, rows), table_places(b, rows))]
            continue
        if section and sum(len(p.text) for p in section.parts) + 2 * len(section.parts) + len(b.text) > limit:
            close()
        if section is None:
            section = Chunk("section", context, "", b.start, b.end, 0)
        section.parts.append(b)
        section.end = b.end
        section.blocks += 1
    close()
    return chunks


_CHUNKS = "kind string, title_context string, chunk_index int, char_start bigint, char_end bigint, text string"


def chunk_documents(documents: DataFrame, key: str = "doc_id", limit: int = 2000, least: int = 80) -> DataFrame:
    """(key, kind, title_context, chunk_index, char_start, char_end, text) of every document; null and blank texts give none."""
    key_type = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (k, c.kind, c.context, i, c.start, c.end, c.text)
                for k, text in zip(pdf[key], pdf["text"])
                for i, c in enumerate(chunk_blocks(markdown_blocks(text), limit, least))
            ]
            yield pd.DataFrame(rows, columns=[key, "kind", "title_context", "chunk_index", "char_start", "char_end", "text"])

    return documents.where("text is not null").select(key, "text").mapInPandas(run, f"`{key}` {key_type}, {_CHUNKS}")
