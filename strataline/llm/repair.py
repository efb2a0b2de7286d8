"""Noise in text from scanned pages (problem 5).

Which words, characters and line-end hyphens are damaged is decided per distinct key of the corpus (see misreadings);
the texts are then read once more, and only their uncommon keys meet the table of damaged ones. A second averaged
perceptron tells page furniture from text by the form of a line, its place on the page, the page's number and the kind
of the chunk; it is trained on furniture laid over a bounded sample of clean chunks.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .misreadings import HYPHEN, LOST, WORD, break_key, damaged_keys, surrounded, unbroken
from .perceptron import AveragedPerceptron

#: Chunks without signs of damage that the models are trained on, at most.
SAMPLE = 5000
#: The most frequent sound keys, at most, that texts need not ask about.
COMMON = 100_000

_HAN = "㐀-鿿"
_STOP = ".!?。！？;；:：,，、|"
_NUMBERED = re.compile(
    r"^(?:[-–—·•*]\s*\d{1,4}\s*[-–—·•*]|\[\s?\d{1,4}\s?\]|\(\s?\d{1,4}\s?\)|\d{1,4}\s*/\s*\d{1,4}|\d{1,4}"
    r"|(?:[Pp](?:age|AGE)?|S(?:eite|EITE)?|[Pp](?:ágina|ÁGINA)|Pág|pág)\.?\s*\d{1,4}(?:\s*(?:of|von|de|sur|/|OF|VON|DE|SUR)\s*\d{1,4})?"
    r"|第\s*\d{1,4}\s*页(?:\s*[,，/]?\s*共\s*\d{1,4}\s*页)?)$"
)
_JOINT = re.compile(r"\s{3,}|\s+\|\s+|\s*\.{4,}\s*|\s+·\s+")
_YEAR = re.compile(r"(?:19|20)\d\d\s*(?:年?度?报告|年报)?$")
# Words that join the last part of a title.
_CONNECT = {"and", "und", "et", "y", "e", "of"}
_CAPTION = re.compile(r"[^\W\d]+\.? ?\d{1,4}[ .:]+\S")
_NUMBER_ENDS = "0123456789])-–—·•*页"



# -- lines --------------------------------------------------------------------------------------------------------


def line_features(line: str, before: str, after: str, place: str, page: int | None, title: str, kind: str) -> list[str] | None:
    """What the furniture model sees of a line; None for lines that are no furniture by their form.

    These are blank lines, headings, table rows and quotes with their marks, lines that end a sentence which the line
    before began, and, without a page number of its own, lines that end or begin as a part of a sentence.
    """
    s = line.strip()
    if not s or s[0] in "#|>":
        return None
    ended = s[-1] in _STOP
    if ended:
        s = s.rstrip(_STOP + " ")
        if not s or (before.strip() and before.strip()[-1] not in ".!?。！？") or (not _NUMBERED.match(s) and not _JOINT.search(s)):
            return None
    numbered = s[-1] in _NUMBER_ENDS and _NUMBERED.match(s)
    parts = [p for p in _JOINT.split(s) if p.strip()]
    number = s if numbered else next((p for p in parts if _NUMBERED.match(p.strip())), "") if len(parts) > 1 else ""
    rest = "" if numbered else " ".join(p for p in parts if p is not number) if number else s
    if not number and (ended or s[0].islower() or s[0] in "-–—•*·“\"'("):
        return None
    if not number and (any(c in s for c in "，。；") or s[-1] in "-‐¬­"):
        return None
    digits = [int(x) for x in re.findall(r"\d{1,4}", number)]
    words = re.findall(r"[^\W\d_]+", rest)
    titled = sum(w[0].isupper() or "㐀" <= w[0] <= "鿿" for w in words) / len(words) if words else 1.0
    has_number = "alone" if numbered else "with" if number else "none"
    heads = [x.strip().lower() for x in title.split(" > ")] if title else []
    heading = rest.lower() in heads[-1:]
    near = "none" if not digits or page is None else "same" if digits[0] == page else "near" if abs(digits[0] - page) < 3 else "far"
    open_before = bool(before.strip()) and before.strip()[-1] not in ".!?。！？:："
    follows = after.strip()
    flows = "none" if not follows else "lower" if follows[0].islower() else "upper" if follows[0].isupper() else "han" if "㐀" <= follows[0] <= "鿿" else "other"
    joined = len(words) > 2 and words[-2].lower() in _CONNECT  # "A b and C", as titles are made
    free = f"{not before.strip()}{not after.strip()}"
    yearly = bool(_YEAR.search(rest)) and len(words) <= 7
    han = bool(re.search(f"[{_HAN}]", rest))
    size = min(len(rest) // 8, 8)
    return [
        "line", f"ended{ended}n{has_number}", f"kind{kind}n{has_number}", f"kind{kind}", f"number{has_number}", f"number{has_number}{near}", f"near{near}", f"place{place}", f"free{free}", f"free{free}n{has_number}",
        f"titled{titled > 0.55}y{yearly}n{has_number}", f"upper{rest.isupper()}w{len(words) > 1}", f"words{min(len(words), 8)}h{han}", f"size{size}h{han}",
        f"heading{heading}n{has_number}", f"yearly{yearly}", f"yearly{yearly}place{place}", f"open{open_before}n{has_number}",
        f"known{rest.lower() in heads[:1]}", f"comma{bool(re.search('[,，。;；]|[.] ', rest))}", f"captioned{bool(_CAPTION.match(rest))}n{has_number}", f"edge{place}t{titled > 0.55}n{has_number}y{yearly}free{free}",
        f"han{han}place{place}n{has_number}size{size}", f"flow{open_before}{flows}", f"flow{open_before}{flows}n{has_number}", f"flow{flows}words{min(len(words), 8)}n{has_number}",
        f"last{words[-1].lower() if words and not han else ''}", f"joined{joined}", f"joined{joined}n{has_number}flow{flows}",
    ]


def _places(lines: list[str]) -> list[str]:
    full = [k for k, x in enumerate(lines) if x.strip()]
    if not full:
        return ["only"] * len(lines)
    out = ["mid"] * len(lines)
    out[full[0]], out[full[-1]] = "first", "last"
    if len(full) > 3:
        out[full[1]], out[full[-2]] = "second", "second"
    return out


def furniture_lines(text: str, page: int | None, title: str, kind: str, model: AveragedPerceptron) -> list[int]:
    """Numbers of the lines of a text that are running headers, footers or page numbers."""
    lines = text.split("\n")
    places, out = _places(lines), []
    for k, line in enumerate(lines):
        f = line_features(line, lines[k - 1] if k else "", lines[k + 1] if k + 1 < len(lines) else "", places[k], page, title, kind)
        if f and model.predict(f)[0] == "furniture":
            out.append(k)
    return out


# -- training -----------------------------------------------------------------------------------------------------


def _furniture(rng: random.Random, page: int, title: str, name: str) -> list[str]:
    """A running header or footer as publishers set them."""
    year, last = rng.randint(2000, 2026), page + rng.randint(5, 200)
    han = bool(re.search(f"[{_HAN}]", title))
    number = rng.choice([f"{page}", f"- {page} -", f"— {page} —", f"· {page} ·", f"[{page}]", f"{page} / {last}", f"第 {page} 页" if han else f"Page {page} of {last}",
                         f"第{page}页 共{last}页" if han else f"p. {page}", f"PAGE {page}" if not han else f"第{page}页"])
    text = rng.choice([f"{name} {year} 年度报告", f"{name} · {year} 年报", name, title] if han else
                      [f"{name} - Interim Report {year}", f"{name} | FY{year}", f"{name} Annual Report {year}", name, title, title.upper()])
    form = rng.randrange(6)
    if form == 0:
        return [number]
    if form == 1:
        return [text]
    if form in (2, 3):
        return [text, number] if form == 2 else [number, text]
    joint = rng.choice(["    ", "  |  ", " ...... "])
    return [text + joint + number if form == 4 else number + joint + text]


def train_lines(sample: list[tuple[str, int | None, str, str]], seed: int = 5) -> AveragedPerceptron:
    """The line model from clean (text, page, title_context, content_type) with furniture laid over them."""
    rng = random.Random(seed)
    lines: list[tuple[list[str], str]] = []
    for text, page, title, kind in sample:
        rows = text.split("\n")
        heads = [x for x in title.split(" > ") if x] or ["Notes"]
        page = page if page is not None else rng.randint(1, 30)
        name = rng.choice(re.findall(r"(?:[A-Z][a-z]+ [A-Z][a-z]+)(?=[' ])", text) or [w for w in re.findall(f"[{_HAN}]{{4}}(?=公告)", text)] or heads)
        made = []
        if rng.random() < 0.6:
            made = _furniture(rng, page if rng.random() < 0.9 else rng.randint(1, 300), heads[0], name)
            spot = rng.choice([0, len(rows), len(rows), rng.randrange(len(rows) + 1)])
            pad = rng.random() < 0.5
            rows = rows[:spot] + [""] * pad + made + [""] * pad + rows[spot:]
        places = _places(rows)
        for k, line in enumerate(rows):
            f = line_features(line, rows[k - 1] if k else "", rows[k + 1] if k + 1 < len(rows) else "", places[k], page, title, kind)
            if f:
                lines.append((f, "furniture" if line in made else "text"))
        if heads and rng.random() < 0.3:  # a heading that stands without its mark
            f = line_features(heads[-1], "", "", rng.choice(["first", "mid"]), page, title, kind)
            if f:
                lines.append((f, "text"))
    return AveragedPerceptron(("text", "furniture")).train(lines)


# -- operators ----------------------------------------------------------------------------------------------------


def without_furniture(text: str, drop: set[int]) -> str:
    """A text without the lines ``drop``; where one stood between the halves of a sentence, the halves meet again."""
    if not drop:
        return text.strip("\n")
    kept: list[str] = []
    gap = False
    for k, row in enumerate(text.split("\n")):
        if k in drop:
            gap = True
            continue
        if gap and row.strip():
            while kept and not kept[-1].strip():
                kept.pop()
            if kept and (kept[-1].strip()[-1] in ".!?。！？:：|" or kept[-1].lstrip()[:1] in "#|" or row.lstrip()[:1] in "#|"):
                kept.append("")
            gap = False
        kept.append(row)
    return "\n".join(kept).strip("\n")


def asked_keys(flat: str, common: set[str]) -> list[str]:
    """The keys of an unbroken text that may be damaged. A broken word asks for itself and for its whole."""
    out = []

    def take(m: re.Match) -> str:
        if not m[3][0].islower():
            return m[0]
        out.append(break_key(m[1], m[2], m[3]))
        return m[1] + m[3]

    if "\n" in flat:
        flat = HYPHEN.sub(take, HYPHEN.sub(take, flat))
    words = {"w" + w for w in WORD.findall(flat.lower())} | {"3" + g for g in surrounded(flat)}
    return out + list(words - common)


def rebuilt(flat: str, changed: dict[str, str]) -> str:
    """An unbroken text with all changes made, as continuous paragraphs."""

    def join(m: re.Match) -> str:
        return m[1] + ("" if m[3][0].islower() and break_key(m[1], m[2], m[3]) in changed else "-") + m[3]

    def fix(m: re.Match) -> str:
        after = changed.get("w" + m[0].lower(), m[0])
        if after == m[0]:
            return after
        return after.upper() if m[0].isupper() and len(m[0]) > 1 else after[:1].upper() + after[1:] if m[0][:1].isupper() else after

    if "\n" in flat:
        flat = HYPHEN.sub(join, HYPHEN.sub(join, flat))
    if any(key[0] == "3" for key in changed):
        padded = "\n" + flat + "\n"
        flat = "".join(changed.get("3" + padded[k : k + 3], c) for k, c in enumerate(flat))
    if any(key[0] == "w" for key in changed):
        flat = WORD.sub(fix, flat)
    out = []
    for block in re.split(r"\n[ \t]*\n", flat):
        paragraph = ""
        for row in block.split("\n"):
            row = row.strip()
            if not row:
                continue
            alone = row[0] in "#|>" or re.match(r"[-*•·]\s|\[\d+\]\s|\d+[.)]\s", row) or paragraph[:1] in ("#", "|")
            paragraph += ("\n" if alone else " ") + row if paragraph else row
        if paragraph:
            out.append(paragraph)
    return "\n\n".join(out)


def clean_sample(chunks: DataFrame, limit: int = SAMPLE) -> list[tuple[str, int | None, str, str]]:
    """The chunks of the least hashes, at most ``limit``, whose layout has nothing beside a title and a text.

    A chunk that was delivered several times counts once, however often its rows are repeated.
    """
    rows = chunks.where("text is not null and chunk_version_uid is not null and size(block_labels) <= 2 and not contains(text, '�')")
    order = F.xxhash64("chunk_version_uid"), F.col("chunk_version_uid")
    picked = rows.select("chunk_version_uid").distinct().orderBy(*order).limit(limit)
    one = F.struct("text", "page", F.coalesce("title_context", F.lit("")).alias("title"), F.coalesce("content_type", F.lit("")).alias("kind"))
    found = rows.join(F.broadcast(picked), "chunk_version_uid").groupBy("chunk_version_uid").agg(F.min(one).alias("one")).orderBy(*order)
    return [tuple(r["one"]) for r in found.toLocalIterator()]


_COLUMNS = ["chunk_version_uid", "text", "page", "title_context", "content_type"]


def _scan(chunks: DataFrame) -> tuple[DataFrame, DataFrame, AveragedPerceptron]:
    """(uid, key) of everything a text asks about or shows by itself, (key, to) of the damaged keys, and the line model."""
    sample = clean_sample(chunks)
    changed, counts = damaged_keys(chunks, [text for text, *_ in sample])
    # No damaged key is among the common ones, so leaving these out loses nothing.
    common = counts.where("key not like 'j%' and n > 1").join(changed, "key", "left_anti").orderBy(F.desc("n"), "key").limit(COMMON)
    lines = train_lines(sample)
    shared = chunks.sparkSession.sparkContext.broadcast(({r["key"] for r in common.select("key").toLocalIterator()}, lines))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, model = shared.value
        for pdf in batches:
            uids, asked = [], []
            for uid, text, page, title, kind in zip(*(pdf[c] for c in _COLUMNS)):
                drop = set(furniture_lines(text, None if pd.isna(page) else int(page), title or "", kind or "", model))
                found = asked_keys(unbroken(without_furniture(text, drop)), known)
                found += ["furniture"] * bool(drop) + ["glyph"] * (LOST in text)
                uids += [uid] * len(found)
                asked += found
            yield pd.DataFrame({"chunk_version_uid": uids, "key": asked}, dtype=object)

    rows = chunks.where("text is not null and chunk_version_uid is not null").select(*_COLUMNS)
    return rows.mapInPandas(run, "chunk_version_uid string, key string"), changed, lines


def damage(chunks: DataFrame) -> DataFrame:
    """(chunk_version_uid, damage): one row per chunk and kind (hyphen, glyph, furniture); null texts have none."""
    asked, changed, _ = _scan(chunks)
    kind = F.when(F.col("to").isNull(), F.col("key")).when(F.col("key").startswith("j"), "hyphen").otherwise("glyph")
    shown = F.col("key").isin("furniture", "glyph")
    return asked.join(changed, "key", "left").where(shown | F.col("to").isNotNull()).select("chunk_version_uid", kind.alias("damage")).distinct()


def repaired_chunks(chunks: DataFrame) -> DataFrame:
    """(chunk_version_uid, text, damage): every chunk once, its text as continuous paragraphs."""
    asked, changed, lines = _scan(chunks)
    # At most the distinct damaged words of one chunk come together.
    own = asked.join(changed, "key").distinct().groupBy("chunk_version_uid").agg(F.collect_list(F.struct("key", "to")).alias("changes"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, damages = [], []
            for text, page, title, kind, changes in zip(*(pdf[c] for c in [*_COLUMNS[1:], "changes"])):
                to = {x["key"]: x["to"] for x in changes} if changes is not None else {}
                drop = set(furniture_lines(text, None if pd.isna(page) else int(page), title or "", kind or "", lines))
                texts.append(rebuilt(unbroken(without_furniture(text, drop)), to))
                found = {"hyphen" if key[0] == "j" else "glyph" for key in to} | ({"furniture"} if drop else set()) | ({"glyph"} if LOST in text else set())
                damages.append(sorted(found))
            yield pd.DataFrame({"chunk_version_uid": pdf["chunk_version_uid"], "text": texts, "damage": damages})

    rows = chunks.where("text is not null and chunk_version_uid is not null").select(*_COLUMNS).dropDuplicates(["chunk_version_uid"])
    return rows.join(own, "chunk_version_uid", "left").mapInPandas(run, "chunk_version_uid string, text string, damage array<string>")
