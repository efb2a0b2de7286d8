"""Which words, characters and line-end hyphens of a corpus are damaged (problem 5).

One pass counts the keys of all texts: words, Chinese characters with both neighbours, and words broken at a line end.
Everything else works on the table of distinct keys, as joins:

* pairs of words that differ in one place of one or two characters show which characters are read for which others in
  this corpus: a misreading makes rare words of many common ones, a chance likeness of few;
* in the same way characters that stand, rarely, between neighbours where another one usually stands;
* an averaged perceptron, trained on such misreadings laid over the words of a bounded sample of clean chunks, predicts
  for each key keep, replace, delete, insert or join.

The result is a table of the keys to be changed, which grows with the distinct damaged words, not with the texts.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stage import stage
from .perceptron import AveragedPerceptron

#: An edit must lead to a key at least this many times as frequent.
LEAST_GAIN = 4
#: What teaches a misreading: one key this many times as frequent as the other.
STRONG = 64
#: A misreading must be seen in this many words or surroundings, and in this share of the common words it may befall.
LEAST_TYPES, LEAST_COVER = 3, 0.1
#: Counts of more keys than these are divided down to as many in all: what is rare or common does not hang on the size of the corpus.
REFERENCE = 16_000_000
LOST = "�"

_HAN = "㐀-鿿"
#: A backslash never stands in a sound word; with the sign after it, it is part of one.
WORD = re.compile(rf"(?:[^\W_{_HAN}]|{LOST}|\\[^\s\w]?)+")
HYPHEN = re.compile(f"(?<![^\\W\\d_])([^\\W\\d_{_HAN}]+)([-‐¬­])[ \\t]?\\n[ \\t]?([^\\W\\d_{_HAN}]+)")
_HAN_BREAK = re.compile(f"(?<=[{_HAN}，、])\\n(?=[{_HAN}])")
_SURROUNDED = re.compile(f"(?=(.[{_HAN}].))", re.S)


def unbroken(text: str) -> str:
    """Chinese lines run together, for they break anywhere."""
    return _HAN_BREAK.sub("", text)


def break_key(left: str, mark: str, right: str) -> str:
    """The key of a word broken at a line end, with the kind of its hyphen."""
    return f"j{left.lower()}\t{int(mark in '-‐')}\t{right.lower()}"


def keys(text: str) -> list[str]:
    """The keys of an unbroken text: w words, 3 characters in their surroundings, j broken words; the halves of these are no words."""
    out = []

    def take(m: re.Match) -> str:
        if not m[3][0].islower():
            return m[0]
        out.append(break_key(m[1], m[2], m[3]))
        return " "

    if "\n" in text:
        text = HYPHEN.sub(take, text)
    out += ["w" + w for w in WORD.findall(text.lower())]
    out += ["3" + g for g in surrounded(text) if _is_han(g[0]) or _is_han(g[2])]
    return out


def surrounded(text: str) -> list[str]:
    """Each Chinese character with its neighbours."""
    return _SURROUNDED.findall("\n" + text + "\n")


def _is_han(c: str) -> bool:
    return "㐀" <= c <= "鿿"


def key_counts(chunks: DataFrame) -> DataFrame:
    """(key, n): how often each key occurs; also pairs of neighbours (2 before, 1 after) and, as often as never, the words that broken ones would make.

    All keys are counted. In a corpus of more than ``REFERENCE`` of them, ``n`` is the count for so many, with fractions.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for pdf in batches:
            texts = pdf["text"].tolist()
            for k in range(0, len(texts), 200):
                seen.update(keys(unbroken("\n\n".join(texts[k : k + 200]))))
            if len(seen) > 400_000:
                yield pd.DataFrame({"key": list(seen), "n": list(seen.values())})
                seen.clear()
        if seen:
            yield pd.DataFrame({"key": list(seen), "n": list(seen.values())})

    counted = stage(chunks.where("text is not null").select("text").mapInPandas(run, "key string, n bigint").groupBy("key").agg(F.sum("n").alias("n")))
    size = max(1.0, (counted.agg(F.sum("n")).first()[0] or 0) / REFERENCE)
    counted = counted.select("key", (F.col("n") / F.lit(size)).alias("n"))
    around = counted.where("key like '3%'")
    near = around.select(F.concat(F.lit("2"), F.substring("key", 2, 2)).alias("key"), "n").unionByName(around.select(F.concat(F.lit("1"), F.substring("key", 3, 2)).alias("key"), "n"))
    whole = counted.where("key like 'j%'").select(F.concat(F.lit("w"), F.regexp_replace(F.substring("key", 2, 1 << 30), "\t.\t", "")).alias("key"), F.lit(0.0).alias("n"))
    return stage(counted.unionByName(near).unionByName(whole).groupBy("key").agg(F.sum("n").alias("n")))


def with_levels(rows: DataFrame, counts: DataFrame, asked: list[Column]) -> DataFrame:
    """Adds ``levels``: how often each of the asked keys occurs. ``rows`` are made distinct."""
    columns = rows.columns
    spread = rows.distinct().select(*columns, F.posexplode(F.array(*asked)).alias("_at", "_key"))
    counted = counts.select(F.col("key").alias("_key"), F.col("n").alias("_n"))
    entry = F.struct("_at", F.coalesce("_n", F.lit(0.0)).alias("n"))
    met = spread.join(counted, "_key", "left").groupBy(*columns).agg(F.sort_array(F.collect_list(entry)).alias("_l"))  # as many entries as keys asked for
    return met.select(*columns, F.col("_l.n").alias("levels"))


def level(n: float) -> int:
    """About twice the binary logarithm of a count; 0 for none and for fractions of one."""
    return int(2 * math.log2(n)) if n > 1 else 0


# -- pairs --------------------------------------------------------------------------------------------------------


_MODULUS, _BASE = (1 << 61) - 1, 0x9E3779B97F4A7C1
_POWERS = [1]


class _Hashed:
    """Hashes of a word with a part replaced, each in one step, so that a word of any length costs its length."""

    def __init__(self, word: str):
        self.before = [0]
        for c in word:
            self.before.append((self.before[-1] * _BASE + ord(c) + 2) % _MODULUS)
        while len(_POWERS) < len(word) + 3:
            _POWERS.append(_POWERS[-1] * _BASE % _MODULUS)

    def replaced(self, at: int, width: int, codes: list[int]) -> int:
        """The hash with ``width`` characters at ``at`` replaced by others."""
        h, rest = self.before[at], len(self.before) - 1 - at - width
        for c in codes:
            h = (h * _BASE + c) % _MODULUS
        return (h * _POWERS[rest] + self.before[-1] - self.before[at + width] * _POWERS[rest]) % _MODULUS


def _gaps(words: DataFrame) -> DataFrame:
    """(gap, id, n, at, part): each word with one or two characters taken out at each place, as hashes.

    Words that share a gap differ in these characters only, so a gap joins at most as many words as there are pairs of
    characters.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, w, n in zip(pdf["id"], pdf["word"], pdf["n"]):
                h = _Hashed(w)
                rows += [(h.replaced(k, g, [1]), i, n, k, w[k : k + g]) for g in (1, 2) for k in range(len(w) - g + 1) if len(w) > g + (g == 2)]
            yield pd.DataFrame(rows, columns=["gap", "id", "n", "at", "part"]).astype({"gap": "int64", "id": "int64", "n": "float64", "at": "int32"})

    return words.mapInPandas(run, "gap bigint, id bigint, n double, at int, part string")


def _words(counts: DataFrame) -> DataFrame:
    """(id, word, n) of the counted words that are no numbers."""
    words = counts.where("key like 'w%'").select(F.expr("substring(key, 2)").alias("word"), "n").where(~F.col("word").rlike("^[0-9]+$"))
    return words.select(F.xxhash64("word").alias("id"), "word", "n")


def _after(word: str, at: str, wrong: str, right: str) -> Column:
    """A word with ``wrong`` at ``at`` replaced by ``right``."""
    return F.concat(F.substring(word, F.lit(1), F.col(at)), F.col(right), F.substring(word, F.col(at) + F.length(wrong) + 1, F.length(word)))


def word_pairs(counts: DataFrame) -> DataFrame:
    """(word, n, at, wrong, right, other, m): words that turn into another one when ``wrong`` at ``at`` becomes ``right``."""
    words = _words(counts)
    # A word of a length that no frequent word comes near has no pair.
    near = F.array(F.length("word") - 1, F.length("word"), F.length("word") + 1)
    lengths = words.where(f"n >= {LEAST_GAIN}").select(F.explode(near).alias("length")).distinct()
    gaps = stage(_gaps(words.withColumn("length", F.length("word")).join(lengths, "length", "left_semi")))
    other = gaps.where(f"n >= {LEAST_GAIN}").select("gap", F.col("id").alias("of"), F.col("n").alias("m"), F.col("part").alias("right"))
    both = gaps.withColumnRenamed("part", "wrong").join(other, "gap").where("id <> of").drop("gap")
    least = (F.left("wrong", F.lit(1)) != F.left("right", F.lit(1))) & (F.right("wrong", F.lit(1)) != F.right("right", F.lit(1)))
    named = both.where(least).join(words.select("id", "word"), "id").join(words.select(F.col("id").alias("of"), F.col("word").alias("other")), "of")
    return stage(named.where(_after("word", "at", "wrong", "right") == F.col("other")).select("word", "n", "at", "wrong", "right", "other", "m"))


def word_misreadings(pairs: DataFrame, counts: DataFrame) -> dict[tuple[str, str], tuple[int, float]]:
    """{(as read, as printed): (words it befell, share of the common words it may befall)}: a few hundred at most, as characters are few."""
    strong = pairs.where(F.col("m") >= STRONG * F.greatest("n", F.lit(1))).where(~F.contains("wrong", F.lit(LOST)))
    seen = strong.select("wrong", "right", "other").distinct().groupBy("wrong", "right").agg(F.count(F.lit(1)).alias("types")).where(f"types >= {LEAST_TYPES}")
    common = counts.where(f"key like 'w%' and n >= {STRONG}").select(F.expr("substring(key, 2)").alias("word"))
    places = F.sequence(F.lit(1), F.length("word"))
    parts = F.array_distinct(F.concat(F.transform(places, lambda k: F.substring("word", k, F.lit(1))), F.transform(places, lambda k: F.substring("word", k, F.lit(2)))))
    holding = common.select(F.explode(parts).alias("right")).groupBy("right").agg(F.count(F.lit(1)).alias("of"))
    rows = seen.join(holding, "right").where(F.col("types") >= LEAST_COVER * F.col("of"))
    return {(r["wrong"], r["right"]): (r["types"], r["types"] / r["of"]) for r in rows.collect()}


def character_misreadings(counts: DataFrame) -> list[tuple[str, str]]:
    """(as read, as printed): characters that stand rarely, in several surroundings, where another one usually stands.

    Both pairs with the neighbours must be rare too, else the character belongs there.
    """
    key = F.col("key")
    around = counts.where("key like '3%'").select(F.substring(key, 2, 1).alias("x"), F.substring(key, 3, 1).alias("c"), F.substring(key, 4, 1).alias("y"), "n")
    usual = around.where(f"n >= {STRONG}").select("x", "y", F.col("c").alias("d"), F.col("n").alias("m"))
    pairs = around.join(usual, ["x", "y"]).where((F.col("c") != F.col("d")) & (F.col("m") >= STRONG * F.col("n"))).select("x", "c", "y", "d")
    asked = [F.concat(F.lit("2"), "x", "c"), F.concat(F.lit("1"), "c", "y"), F.concat(F.lit("2"), "x", "d"), F.concat(F.lit("1"), "d", "y")]
    rare = with_levels(pairs, counts, asked).where(F.expr(f"levels[2] >= {STRONG} * levels[0] and levels[3] >= {STRONG} * levels[1]"))
    seen = rare.groupBy("c", "d").agg(F.count(F.lit(1)).alias("types")).where(f"types >= {LEAST_TYPES}")
    return sorted((r["c"], r["d"]) for r in seen.collect())  # pairs of characters


# -- the editor ---------------------------------------------------------------------------------------------------


def _operation(wrong: str, right: str) -> str:
    return "replace" if len(wrong) == len(right) else "delete" if len(wrong) > len(right) else "insert"


def _bin(x: int) -> int:
    return x if x < 6 else 6 + (x - 6) // 3


def edit_features(word: str, place: int, wrong: str, right: str, before: int, after: int, steps: int, seen: tuple[int, float]) -> list[str]:
    """What the editor sees of one possible edit: levels, the misreading and how usual it is, the neighbours."""
    gain = max(-4, min(20, after - before))
    mixed = any(c.isdigit() for c in word) and any(c.isalpha() for c in word)
    around = (word[place - 1 : place].isalpha(), word[place + len(wrong) : place + len(wrong) + 1].isalpha())
    kind = "lost" if LOST in wrong else "digit" if any(c.isdigit() for c in wrong) else "letter"
    return [
        "one", f"gain{gain}", f"before{_bin(before)}", f"after{_bin(after)}", f"g{gain // 3}b{_bin(before)}", f"kind{kind}", f"kind{kind}a{_bin(after)}",
        f"op{_operation(wrong, right)}", f"types{level(seen[0]) // 2}", f"cover{int(10 * min(1.0, seen[1]))}", f"mixed{mixed}k{kind}a{after > 5}",
        f"near{around}", f"len{min(len(word), 12)}", f"len{min(len(word), 12)}g{gain // 3}", f"steps{steps}g{gain // 3}", f"steps{steps}len{min(len(word), 12)}",
    ]


def join_features(left: str, mark: int, right: str, whole: int, a: int, b: int) -> list[str]:
    """What the editor sees of a word broken at a line end: the levels of the whole and of both halves."""
    known = whole > 4
    return [
        "hyphen", f"joingain{max(-6, min(6, (whole - min(a, b)) // 4))}", f"whole{_bin(whole)}", f"wholeknown{known}", f"parts{min(a, b) // 4}w{known}",
        f"mark{mark}", f"mark{mark}p{min(a, b) > 8}w{known}",
    ]


def character_features(was: list[int], now: list[int]) -> list[str]:
    """What the editor sees of a Chinese character and another in its place: levels with both, the one before, the one after."""
    gains = [max(-4, min(20, b - a)) for a, b in zip(was, now)]
    return [
        "han", *(f"han{i}g{g}" for i, g in enumerate(gains)), f"hanworst{min(gains[1:])}", f"hanbest{max(gains[1:])}",
        f"hanwas{_bin(max(was[1:]))}", f"han3{_bin(now[0])}w{_bin(was[0])}", f"hansum{sum(gains[1:]) // 2}",
    ]


def _around(x: str, c: str, y: str) -> list[Column]:
    x, c, y = F.col(x), F.col(c), F.col(y)
    return [F.concat(F.lit("3"), x, c, y), F.concat(F.lit("2"), x, c), F.concat(F.lit("1"), c, y)]


def _possible_characters(around: DataFrame, likes: list[tuple[str, str]], counts: DataFrame) -> DataFrame:
    """(x, c, y, d, levels) for every other character ``d`` that may have been printed in place of ``c``."""
    table = around.sparkSession.createDataFrame(likes, "c string, d string")
    return with_levels(around.join(F.broadcast(table), "c").select("x", "c", "y", "d"), counts, [*_around("x", "c", "y"), *_around("x", "d", "y")])


def _possible_joins(breaks: DataFrame, fixed: DataFrame, counts: DataFrame) -> DataFrame:
    """(l, mark, r, levels of the whole as read, the whole repaired, both halves)."""
    whole = F.concat("l", "r")
    repaired = breaks.withColumn("word", whole).join(fixed, "word", "left").select("l", "mark", "r", F.coalesce("to", whole).alias("to"))
    return with_levels(repaired, counts, [F.concat(F.lit("w"), "l", "r"), F.concat(F.lit("w"), "to"), F.concat(F.lit("w"), "l"), F.concat(F.lit("w"), "r")])


def _two_edits(counts: DataFrame, open_words: DataFrame, known: dict[tuple[str, str], tuple[int, float]]) -> DataFrame:
    """(word, n, at, wrong, right, other, m): open (id, word, n) two misreadings away from a common word, met half way."""

    def half(forward: bool):
        by_first: dict[str, list[tuple[str, str]]] = {}
        for wrong, right in sorted(known):
            a, b = (wrong, right) if forward else (right, wrong)
            by_first.setdefault(a[0], []).append((a, b))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = []
                for i, w, n in zip(pdf["id"], pdf["word"], pdf["n"]):
                    h = _Hashed(w)
                    for k, c in enumerate(w):
                        for a, b in by_first.get(c, ()):
                            if w.startswith(a, k):
                                rows.append((h.replaced(k, len(a), [ord(x) + 2 for x in b]), i, n, k, a, b))
                yield pd.DataFrame(rows, columns=["middle", "id", "n", "at", "a", "b"]).astype({"middle": "int64", "id": "int64", "n": "float64", "at": "int32"})

        return run

    schema = "middle bigint, id bigint, n double, at int, a string, b string"
    words = _words(counts)
    there = open_words.mapInPandas(half(True), schema).withColumnsRenamed({"a": "wrong", "b": "right"})
    back = words.where(f"n >= {STRONG}").mapInPandas(half(False), schema).select("middle", F.col("id").alias("of"), F.col("n").alias("m"), F.col("at").alias("at2"), "a", "b")
    met = there.join(back, "middle").where(f"id <> of and m >= {STRONG} * n").drop("middle")
    named = met.join(words.select("id", "word"), "id").join(words.select(F.col("id").alias("of"), F.col("word").alias("other")), "of")
    return named.where(_after("word", "at", "wrong", "right") == _after("other", "at2", "a", "b")).select("word", "n", "at", "wrong", "right", "other", "m")


def _best(pairs: DataFrame, model: AveragedPerceptron, known: dict[tuple[str, str], tuple[int, float]], steps: int) -> DataFrame:
    """(word, to): what each word most probably was, where the editor would change it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for word, n, at, wrong, right, other, m in pdf.itertuples(index=False, name=None):
                op, score = model.predict(edit_features(word, at, wrong, right, level(n), level(m), steps, known.get((wrong, right), (0, 0.0))))
                if op != "keep" and score > 0:
                    out.append((word, score, m, other))
            yield pd.DataFrame(out, columns=["word", "score", "m", "other"]).astype({"score": "float64", "m": "float64"})

    scored = pairs.select("word", "n", "at", "wrong", "right", "other", "m").mapInPandas(run, "word string, score double, m double, other string")
    return scored.groupBy("word").agg(F.max(F.struct("score", "m", "other")).alias("best")).select("word", F.col("best.other").alias("to"))


def train_editor(sample: list[str], pairs: DataFrame, counts: DataFrame, known: dict[tuple[str, str], tuple[int, float]], likes: list[tuple[str, str]], seed: int = 5) -> AveragedPerceptron:
    """The editor, from misreadings and breaks laid over the words of the sample; what is collected belongs to the sample."""
    rng, spark = random.Random(seed), counts.sparkSession
    vocabulary = sorted({w for t in sample for w in WORD.findall(HYPHEN.sub(" ", unbroken(t)).lower()) if not w.isdigit()}) or [""]
    cuts = [(w[:k], w[k:]) for w in vocabulary if len(w) > 5 and w.isalpha() and (k := rng.randint(2, len(w) - 2))]
    compounds = sorted({(m[1].lower(), m[2].lower()) for t in sample for m in re.finditer(f"([^\\W\\d_{_HAN}]+)-([^\\W\\d_{_HAN}]+)", t)})
    grams = sorted({g for t in sample for g in surrounded(unbroken(t)) if _is_han(g[0]) or _is_han(g[2])})
    words = F.broadcast(spark.createDataFrame([(w,) for w in vocabulary], "word string"))
    held = {r["word"]: r["n"] for r in counts.select(F.expr("substring(key, 2)").alias("word"), "n", "key").where("key like 'w%'").join(words, "word").collect()}
    examples: list[tuple[list[str], str]] = []
    if known:
        table = F.broadcast(spark.createDataFrame(sorted(known), "wrong string, right string"))
        for r in pairs.join(words, "word").join(table, ["wrong", "right"]).orderBy("word", "at", "wrong", "right").collect():
            # The sample is not free of misreadings; a long word far below its neighbour teaches nothing.
            if len(r["word"]) < 6 or r["m"] < STRONG * max(r["n"], 1):
                examples.append((edit_features(r["word"], r["at"], r["wrong"], r["right"], level(r["n"]), level(r["m"]), 1, known[r["wrong"], r["right"]]), "keep"))
        for r in _two_edits(counts, _words(counts).join(words, "word", "left_semi"), known).orderBy("word", "other", "at", "wrong", "right").collect():
            if len(r["word"]) < 6:
                examples.append((edit_features(r["word"], r["at"], r["wrong"], r["right"], level(r["n"]), level(r["m"]), 2, known[r["wrong"], r["right"]]), "keep"))
    by_right: dict[str, list[str]] = {}
    for wrong, right in sorted(known):
        by_right.setdefault(right, []).append(wrong)
    for word in vocabulary:
        after = level(held.get(word, 0))
        spots = [(k, r) for k in range(len(word)) for r in (word[k], word[k : k + 2]) if r in by_right]
        if after < 6 or not word:
            continue
        for steps in (1, 1, 2):
            # A misreading recurs, so its own count is anything well below that of the word.
            before = rng.choice((0, rng.randint(0, 6), rng.randint(0, max(0, after - 8))))
            if spots and rng.random() > 0.1:
                k, right = rng.choice(spots)
                wrong = rng.choice(by_right[right])
                strength = known[wrong, right]
            else:
                k = rng.randrange(len(word))
                right, wrong, strength = word[k], LOST, (0, 0.0)
            bad = word[:k] + wrong + word[k + len(right) :]
            examples.append((edit_features(bad, k, wrong, right, before, after, steps, strength), _operation(wrong, right)))
            if not spots:
                continue
            # A sound word beside one a little more frequent.
            near = min(20, after + rng.randint(-6, 5))
            examples.append((edit_features(word, k, right, wrong, after, near, steps, strength), "keep"))
    nothing = spark.createDataFrame([], "word string, to string")
    broken = spark.createDataFrame([(a, rng.choice((1, 1, 0)), b) for a, b in cuts + compounds] or [("", 1, "")], "l string, mark int, r string")
    apart = set(compounds)
    for r in _possible_joins(broken, nothing, counts).orderBy("l", "r").collect():
        whole, repaired, a, b = map(level, r["levels"])
        f = join_features(r["l"], r["mark"], r["r"], max(whole, repaired), a, b)
        # Compounds are fewer than words; they weigh as much in all.
        examples += [(f, "keep")] * max(1, len(cuts) // len(apart)) if (r["l"], r["r"]) in apart else [(f, "join")]
    if likes and grams:
        both = sorted({*likes, *((d, c) for c, d in likes)})
        around = spark.createDataFrame([(g[0], g[1], g[2]) for g in grams], "x string, c string, y string")
        for r in _possible_characters(around, both, counts).orderBy("x", "c", "y", "d").collect():
            was, now = [level(n) for n in r["levels"][:3]], [level(n) for n in r["levels"][3:]]
            if max(was[1:]) > max(now[1:]) + 2:
                examples += [(character_features(was, now), "keep"), (character_features(now, was), "replace")]
    return AveragedPerceptron(("keep", "replace", "delete", "insert", "join")).train(examples)


def damaged_keys(chunks: DataFrame, sample: list[str]) -> tuple[DataFrame, DataFrame]:
    """(key, to) of all keys that the editor changes, and the counts of all keys.

    A word goes to the word as printed, a character in its surroundings to the right character, a broken word to
    itself, to be joined.
    """
    counts = key_counts(chunks)
    pairs = word_pairs(counts)
    known, likes = word_misreadings(pairs, counts), character_misreadings(counts)
    model = train_editor(sample, pairs, counts, known, likes)
    spark = chunks.sparkSession
    table = F.broadcast(spark.createDataFrame(sorted(known), "wrong string, right string"))
    usual = pairs.where(f"m >= {LEAST_GAIN} * n").join(table, ["wrong", "right"])
    one = stage(_best(usual.unionByName(pairs.where(F.contains("wrong", F.lit(LOST))), allowMissingColumns=True), model, known, 1))
    two = _best(_two_edits(counts, _words(counts).join(one, "word", "left_anti"), known), model, known, 2)
    fixed = stage(one.unionByName(two))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for x, c, y, d, levels in pdf.itertuples(index=False, name=None):
                was, now = [level(n) for n in levels[:3]], [level(n) for n in levels[3:]]
                op, score = model.predict(character_features(was, now))
                if op != "keep" and max(now[1] - was[1], now[2] - was[2]) >= LEAST_GAIN:
                    out.append(("3" + x + c + y, score, d))
            yield pd.DataFrame(out, columns=["key", "score", "to"]).astype({"score": "float64"})

    key = F.col("key")
    around = counts.where("key like '3%'").select(F.substring(key, 2, 1).alias("x"), F.substring(key, 3, 1).alias("c"), F.substring(key, 4, 1).alias("y"))
    scored = _possible_characters(around, likes, counts).mapInPandas(decide, "key string, score double, to string")
    characters = scored.groupBy("key").agg(F.max(F.struct("score", "to")).alias("best")).select("key", F.col("best.to").alias("to"))

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for left, mark, right, levels in zip(pdf["l"], pdf["mark"], pdf["r"], pdf["levels"]):
                whole, repaired, a, b = map(level, levels)
                if model.predict(join_features(left, mark, right, max(whole, repaired), a, b))[0] == "join":
                    out.append((f"j{left}\t{mark}\t{right}", left + right))
            yield pd.DataFrame(out, columns=["key", "to"], dtype=object)

    cut = F.split(F.expr("substring(key, 2)"), "\t")
    breaks = counts.where("key like 'j%'").select(cut[0].alias("l"), cut[1].cast("int").alias("mark"), cut[2].alias("r"))
    joins = _possible_joins(breaks, fixed, counts).mapInPandas(joined, "key string, to string")
    changed = fixed.select(F.concat(F.lit("w"), "word").alias("key"), "to").unionByName(characters).unionByName(joins)
    return stage(changed), counts
