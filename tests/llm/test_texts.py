"""Operators on texts: problems 2, 4, 5, 8 and 9."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataline.llm import budget, misreadings, mixing, pieces, repair, stuffing
from strataline.llm.perceptron import AveragedPerceptron


def rows(df):
    return {tuple(r) for r in df.collect()}


# -- 2: pieces ----------------------------------------------------------------------------------------------------


def _greedy(text, limit, overlap):
    """The same cuts, one after the other: the strongest pause in the last half of the reach, any pause, or the limit."""
    overlap = max(0, min(overlap, limit - 1))
    at, level = pieces.boundaries(text)
    out, end, first = [], 0, True
    while end < len(text):
        start = max(end - overlap, 0)
        far, least = start + limit, max(end, start + overlap)
        nxt = min(far, len(text))
        if far < len(text):
            for floor in (max(least, start + limit // 2), least):
                reach = [(rank, -x) for x, rank in zip(at.tolist(), level.tolist()) if floor < x <= far]
                if reach:
                    nxt = -min(reach)[1]
                    break
        out.append((0 if first else start, nxt))
        end, first = nxt, False
    return out


@pytest.mark.parametrize("seed", range(6))
def test_pointer_doubling_matches_greedy(seed):
    rng = random.Random(seed)
    texts, limits, overlaps = [], [], []
    for _ in range(12):
        n = rng.choice([30, 300, 2000])
        texts.append("".join(rng.choice(rng.choice(["abcdefg", "abc .", "ab\n", "中文。，"])) for _ in range(n)) or "x")
        if rng.random() < 0.5:  # long stretches without a pause
            texts[-1] = texts[-1][:20] + "x" * rng.randint(1, 900) + " " + "y" * rng.randint(0, 500) + texts[-1][20:60]
        limits.append(rng.choice([7, 20, 110]))
        overlaps.append(rng.choice([0, 3, 19, 200]))
    for text, limit, overlap, got in zip(texts, limits, overlaps, pieces.cuts(texts, limits, overlaps)):
        assert got == _greedy(text, limit, overlap)
        held = max(0, min(overlap, limit - 1))
        assert got[0][0] == 0 and got[-1][1] == len(text)
        assert all(0 < b - a <= limit for a, b in got)
        assert all(y[0] == max(0, x[1] - held) and y[0] > x[0] for x, y in zip(got, got[1:]))


def test_pieces_operator(spark):
    text = ("A sentence ends here. " * 30).strip()
    chunks = [("u1", "r1", text, 10, 1), ("u1", "r1", text, 10, 1), ("u2", None, text, None, 1), ("u3", "r9", text, 0, 1), ("u4", "r1", None, 0, 1),
              ("u5", "r1", "x" * 100, 0, 1), ("u6", "r1", "x" * 101, 0, 1), ("u7", "r1", "", 0, 1), ("u8", "r1", "长" * 20_000, 0, 1)]
    df = spark.createDataFrame(chunks, "chunk_version_uid string, rule_version string, text string, char_start long, piece_no int")
    rule = spark.createDataFrame([("r1", 100, 10, False), ("r2", 200, None, True), ("r3", None, 5, False)], "rule_version string, chunk_max_chars int, chunk_overlap_chars int, is_default boolean").withColumn("text", F.lit("clash"))
    got = pieces.split_oversized(df, rule).collect()
    assert {r["chunk_version_uid"] for r in got} == {"u1", "u2", "u6", "u8"}
    for uid, shift, limit, overlap in (("u1", 10, 100, 10), ("u2", 0, 200, 0)):
        own = sorted((r for r in got if r["chunk_version_uid"] == uid), key=lambda r: r["piece_no"])
        assert all(r["text"] == text[r["char_start"] - shift : r["char_end"] - shift] and len(r["text"]) <= limit for r in own)
        assert all(b["char_start"] == a["char_end"] - overlap for a, b in zip(own, own[1:]))
        assert all(r["text"].endswith(". ") or r["text"].endswith(".") for r in own)
    assert pieces.split_oversized(df.limit(0), rule).count() == 0 == pieces.split_oversized(df, rule.limit(0)).count()


# -- 4: tokens ----------------------------------------------------------------------------------------------------


def _viterbi(segment, vocabulary):
    best = [(0.0, 0)] + [(math.inf, 0)] * len(segment)
    for i, char in enumerate(segment):
        width = len(char.encode("utf-8", "surrogatepass"))
        options = [(1, math.log(40_000) * width, width)] + [(n, vocabulary[segment[i : i + n]], 1) for n in range(1, 17) if segment[i : i + n] in vocabulary]
        for n, cost, count in options:
            if i + n <= len(segment) and best[i][0] + cost < best[i + n][0] - 1e-9:
                best[i + n] = best[i][0] + cost, best[i][1] + count
    return best[-1][1]


def test_counts_match_plain_viterbi():
    vocabulary = {p: math.log(k + 2.0) for p, k in budget.piece_vocabulary()}
    texts = ["Management absorbed the renewal of 51.49 million.", "报告期内，可比估值模型约为837万元", "naïve Übertragung", "\U0001f600 x", "a" * 90]
    cut = [s for t in texts for s in budget.segments(t)]
    assert budget.count_segments(cut) == [_viterbi(s, vocabulary) for s in cut]
    assert budget.segments("  ") == [] and budget.count_segments([]) == [] and budget.count_segments([""]) == [0]


def test_budget(spark):
    text = "The committee reviewed the revenue of the fund."
    reports = [("s1", 1, "A", "en-GB", "d", 9), ("s1", 2, " a", "EN", "D ", 10), ("s2", 1, "a", "en", None, 10), ("s3", 1, None, "", "d", 99_000), ("s4", 1, "a", None, "d", None),
               ("s5", 1, "a", "en", "d", -5), ("s6", 1, "b", "en", "d", 7), (None, 1, "a", "en", "d", 5), ("s2", 1, "a", "en", None, 10)]
    q = spark.createDataFrame(reports, "sample_id string, reported_at int, source_name string, language string, domain string, token_count long").withColumn("text", F.lit("clash"))
    c = spark.createDataFrame([(f"s{k}", text, "tok-a") for k in (1, 2, 3, 4, 5, 5)] + [("s7", None, None)], "sample_id string, text string, tokenizer string")
    got = {r["sample_id"]: r for r in budget.sample_tokens(q, c).collect()}
    assert set(got) == {"s1", "s2", "s3", "s4", "s5", "s6"}
    assert got["s1"]["tokens"] == 10 and got["s1"]["trusted"] and got["s1"]["language"] == "en" and got["s1"]["domain"] == "d"
    assert got["s5"]["tokens"] == 10 and not got["s5"]["trusted"]
    assert got["s6"]["tokens"] == 7 and got["s3"]["source_name"] == "unknown"
    targets = spark.createDataFrame([("a", "*", "*", 0.9), ("A ", "en", "*", 0.0001), ("zz", "*", "*", 0.1), ("*", "*", "*", None), ("*", "*", "*", 1.0)], "source_name string, language string, domain string, min_share double")
    seen = {(r["source_name"], r["min_share"]): r["too_little"] for r in budget.coverage(budget.sample_tokens(q, c), targets).collect()}
    assert seen == {("a", 0.9): True, ("A ", 0.0001): False, ("zz", 0.1): True, ("*", None): False, ("*", 1.0): False}
    empty = budget.coverage(budget.sample_tokens(q.limit(0), c.limit(0)), targets).collect()
    assert {(r["source_name"], r["min_share"]): r["too_little"] for r in empty}["a", 0.9]


# -- 5: scanned pages ---------------------------------------------------------------------------------------------


def test_perceptron_learns_and_is_repeatable():
    data = [([f"n{k % 3}"], "a" if k % 3 else "b") for k in range(60)]
    model = AveragedPerceptron(("a", "b")).train(data)
    assert all(model.predict(f)[0] == y for f, y in data)
    assert model.weights == AveragedPerceptron(("a", "b")).train(data).weights


_WORDS = "committee revenue regional forecast the of and quarterly provision management confirmed external annual deferred inventory currency settlement reported".split()


def _page(rng, title):
    lines = []
    for _ in range(4):
        lines.append(" ".join(rng.choice(_WORDS) for _ in range(9)).capitalize())
    return f"## {title}\n\n" + "\n".join(lines) + "."


def _misread(rng, body):
    """Two words of a text read with l for i or ri for n."""
    words = [w for w in _WORDS if ("i" in w or "n" in w) and w in body]
    for w in rng.sample(words, min(2, len(words))):
        a, b = rng.choice([x for x in (("i", "l"), ("n", "ri")) if x[0] in w])
        body = body.replace(w, w.replace(a, b, 1), 1)
    return body


@pytest.fixture(scope="module")
def scanned(spark):
    rng = random.Random(8)
    data, truth = [], {}
    for k in range(900):
        title = f"{rng.choice(_WORDS).capitalize()} and {rng.choice(_WORDS)}"
        text, labels, page = _page(rng, title), ["paragraph_title", "text"], rng.randint(1, 40)
        if k % 9 == 0:
            labels = [*labels, "text"]
            head, body = text.split("\n\n", 1)
            body, kind = rng.choice([(body + f"\nPage {page} of 90", "furniture"), (_misread(rng, body), "glyph"), (body.replace("management", "manage-\nment").replace("inventory", "inven‐\ntory"), "hyphen")])
            text = f"{head}\n\n{body}"
            if kind == "glyph" or any(x in text for x in ("Page ", "manage-\n", "inven‐\n")):
                truth.setdefault(f"u{k}", set()).add(kind)
        data.append((f"u{k}", text, page, f"Annual report > {title}", "section", labels))
    data += [("n1", None, 1, None, "section", None), (None, "x", 1, None, "section", None), ("n2", "", None, None, None, None), data[0], ("long", "committee " * 20_000, 1, "", "section", ["text"])]
    df = spark.createDataFrame(data, "chunk_version_uid string, text string, page int, title_context string, content_type string, block_labels array<string>").withColumn("damage", F.lit("clash"))
    return df, truth


def test_damage_of_planted_cases(scanned):
    df, truth = scanned
    got = {}
    for r in repair.damage(df).collect():
        got.setdefault(r["chunk_version_uid"], set()).add(r["damage"])
    want = {(u, d) for u, s in truth.items() for d in s}
    have = {(u, d) for u, s in got.items() for d in s}
    assert len(want & have) >= 0.95 * len(want) and len(have - want) <= 0.05 * len(want)


def test_repair_rebuilds_paragraphs(scanned):
    df, truth = scanned
    got = {r["chunk_version_uid"]: r for r in repair.repaired_chunks(df).collect()}
    assert "n1" not in got and got["n2"]["text"] == "" and len(got["long"]["text"]) > 190_000
    for u, kinds in truth.items():
        text = got[u]["text"]
        assert text.startswith("## ") and "\n\n" in text and "\n" not in text.split("\n\n", 1)[1]
        if kinds & set(got[u]["damage"]):
            assert not any(x in text for x in ("manage-", "inven‐", "Page ", "conflrmed", "reveriue", "provlsion", "externai"))


def test_repair_of_nothing(spark, scanned):
    df, _ = scanned
    assert repair.damage(df.limit(0)).count() == 0 == repair.repaired_chunks(df.limit(0)).count()


def test_batches_without_damage(spark, scanned):
    """A batch in which nothing is found must give an empty frame of strings, not of floats."""
    df, truth = scanned
    sound = df.where(~F.col("chunk_version_uid").isin(*[u for u, kinds in truth.items() if kinds])).limit(20)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        assert repair.damage(sound).count() <= 2
    finally:
        spark.conf.set(key, before)


def test_line_forms():
    f = repair.line_features
    assert f("## Heading", "", "", "first", 1, "", "section") is None and f("ends here.", "", "", "mid", 1, "", "section") is None
    assert "numberalone" in f("- 5 -", "", "", "last", 5, "", "table") and "numberalonesame" in f("第 5 页", "", "", "last", 5, "", "section")
    assert "numberwith" in f("Notes ...... 12", "", "", "last", 5, "", "section") and "numberalone" in f("Page 7.", "", "", "last", 5, "", "section")
    assert f("A very long running header of a report " * 5, "", "", "first", 5, "", "caption")


def test_misreadings_are_learnt_from_the_corpus(spark):
    """A misreading that no list knows is found where it befalls many common words; a chance likeness is not."""
    words = ["market", "meeting", "margin", "summer", "common", "member", "amount", "number", "formal", "damage"]
    rng = random.Random(3)
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(120)]
    texts[5] += " " + " ".join(w.replace("m", "w3", 1) for w in words[:8]) + " mirket"
    texts[6] += " 客户" + "应收账款与客户存款" * 3
    df = spark.createDataFrame([(f"u{k}", t) for k, t in enumerate(texts)], "chunk_version_uid string, text string")
    counts = misreadings.key_counts(df)
    pairs = misreadings.word_pairs(counts)
    assert set(misreadings.word_misreadings(pairs, counts)) == {("w3", "m")}
    counts = counts.unionByName(spark.createDataFrame([("wcow3w3on", 1), ("wcowwon", 1), ("w" + "x" * 20_000, 1)], "key string, n long"))
    assert misreadings.word_pairs(counts).where("word = 'cow3w3on' and other = 'common'").isEmpty()
    two = misreadings._two_edits(counts, spark.createDataFrame([("cow3w3on", 1)], "word string, n long").withColumn("id", F.xxhash64("word")), {("w3", "m"): (8, 0.8)})
    assert {r["other"] for r in two.collect()} == {"common"}


def test_misreadings_of_a_larger_corpus(spark, monkeypatch):
    """A corpus repeated many times teaches what it teaches once: its rare words do not become common ones."""
    words = ["market", "meeting", "margin", "summer", "common", "member", "amount", "number", "formal", "damage"]
    rng = random.Random(4)
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(120)]
    texts[5] += " " + " ".join(w.replace("m", "w3", 1) for w in words[:8])
    texts[7] += " " + " ".join("m" + "".join(rng.choice("abcdefghik") for _ in range(9)) for _ in range(150))
    df = spark.createDataFrame([(f"u{k}", t) for k, t in enumerate(texts)], "chunk_version_uid string, text string")
    monkeypatch.setattr(misreadings, "REFERENCE", sum(len(misreadings.keys(t)) for t in texts), raising=False)
    for repeats in (1, 64):
        counts = misreadings.key_counts(df.crossJoin(spark.range(repeats)))
        assert set(misreadings.word_misreadings(misreadings.word_pairs(counts), counts)) == {("w3", "m")}


def test_sample_of_repeated_chunks(spark):
    """Chunks that stand in the table many times do not crowd others out of the sample."""
    df = spark.createDataFrame([(f"u{k}", f"text {k}", k, None, None, ["text"]) for k in range(12)], "chunk_version_uid string, text string, page int, title_context string, content_type string, block_labels array<string>")
    assert sorted(x[0] for x in repair.clean_sample(df.crossJoin(spark.range(30)).drop("id"), 12)) == sorted(f"text {k}" for k in range(12))


# -- 8: mixture ---------------------------------------------------------------------------------------------------


def test_mixture(spark):
    rng = random.Random(3)
    docs = [(k, " ".join(rng.choice(_WORDS) for _ in range(rng.randint(1, 40))), rng.choice(["A", " a ", "b", "c"])) for k in range(3000)]
    docs += [(9001, None, "a"), (9002, "", "b"), (9003, docs[0][1], docs[0][2]), (9004, "orphan text", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("tokens", F.lit(5)).withColumn("key", F.lit("clash"))
    t = spark.createDataFrame([("A", 0.5, 1, 0.4), ("b", 0.1, 2, 0.4), ("C ", 0.3, 2, 2.0), ("none", 0.1, 3, 0.4), ("nul", None, None, None)], "source string, target_share double, max_repeats int, mix_size_share double")
    sized = {r["doc_id"]: r["tokens"] for r in mixing.sized_texts(df).collect()}
    total = sum(sized.values())
    report = {r["source"]: r for r in mixing.mixture_report(df, t).collect()}
    assert report["none"]["short"] and not report["nul"]["short"] and report["C "]["short"] and not report["A"]["short"]
    for s, share in (("A", 0.5), ("b", 0.1)):
        assert abs(report[s]["reached_tokens"] - share * 0.4 * total) <= 60
    twice = spark.createDataFrame([("A", 0.5, 1, 0.4), (" a", 0.2, 1, 0.4)], "source string, target_share double, max_repeats int, mix_size_share double")
    got = {r["source"]: r["reached_tokens"] for r in mixing.mixture_report(df, twice).collect()}
    assert abs(got["A"] - 0.2 * total) <= 60 and abs(got[" a"] - 0.08 * total) <= 60  # two targets of one source keep their own budgets
    used = mixing.mixture(df, t).collect()
    for r in used:
        assert 1 <= r["uses"] <= {"A": 1, "b": 2, "C ": 2}[r["source"]]
    assert len({r["doc_id"] for r in used}) == len(used)
    by = {}
    for r in used:
        by[r["source"]] = by.get(r["source"], 0) + r["uses"] * r["tokens"]
    assert all(by[s] == report[s]["reached_tokens"] for s in by)
    assert mixing.mixture(df.limit(0), t).count() == 0 and mixing.mixture_report(df, t.limit(0)).count() == 0
    assert {r["reached_tokens"] for r in mixing.mixture_report(df.limit(0), t).collect()} == {0}


# -- 9: stuffed pages ---------------------------------------------------------------------------------------------


def _prose(rng, n):
    noun, verb, adj = ([f"{stem}{end}" for stem in stems for end in ("", "ment", "ation", "ing", "er")] for stems in (["fund", "bank", "report", "market", "ship", "govern", "settle"], ["review", "confirm", "reduc"], ["region", "annu", "extern", "liquid"]))
    return " ".join(f"The {rng.choice(adj)} {rng.choice(noun)} {rng.choice(verb)} the {rng.choice(noun)} of the {rng.choice(adj)} {rng.choice(noun)} in {rng.randint(1990, 2030)}." for _ in range(n))


def test_stuffed_pages(spark):
    rng = random.Random(5)
    prose = [_prose(rng, 6) for _ in range(300)]
    pages = {
        1: "\n".join(f"- cheap loan https://x{k}.example/a/b{k}" for k in range(30)),
        2: ", ".join(rng.choice(["cheap", "best", "top"]) + " " + rng.choice(["loan", "watch", "shoe"]) for _ in range(120)),
        3: "Tags: " + " ".join(f"#tag{k}word" for k in range(60)),
        4: "贷款保险" * 80,
        6: "best loan, cheap loan, best loan, top loan, cheap loan, best loan, top loan, best loan",  # short pages are judged too
        5: "\n".join(f"ABC-{k}  fast sofa  {k}.50  in stock" for k in range(40)),
        10: _prose(rng, 20),
        11: _prose(rng, 6) + "\n\n| row | 1.5 | 20 |\n" + "\n".join(f"| name{k} | {k}.5 | {k} |" for k in range(60)),
        12: _prose(rng, 6) + "\n" + "\n".join(f"Chapter {k} title here ........ {k}" for k in range(30)),
        13: _prose(rng, 12) + "\n" + "\n".join(f"[{k}] A title of a source. https://s{k}.example/p" for k in range(20)),
        14: None, 15: "", 16: "\n\n", 17: "x" * 50_000, 18: _prose(rng, 900),
    }
    df = spark.createDataFrame([*pages.items(), (None, pages[1])], "doc_id long, text string").withColumn("stuffed", F.lit("clash"))
    got = {r["doc_id"]: r["stuffed"] for r in stuffing.page_scores(df, prose).collect()}
    assert set(got) == set(pages)
    assert [k for k in (1, 2, 3, 4, 5, 6) if not got[k]] == [] and [k for k in (10, 11, 12, 13, 14, 15, 16, 18) if got[k]] == []
    assert stuffing.page_scores(df.limit(0), prose).count() == 0
    assert stuffing.page_scores(df.where("doc_id = 10"), []).count() == 1
    corpus = spark.createDataFrame([("a", "t1", "accepted"), ("a", "t1", "accepted"), ("b", None, "accepted"), ("c", "t2", "pending")], "sample_id string, text string, status string")
    assert stuffing.prose_sample(corpus) == ["t1"]


def test_prose_model_reads_the_whole_corpus(spark):
    """Counts and limits are those of all accepted texts, however many, and of one plain pass over them."""
    rng = random.Random(6)
    texts = [_prose(rng, 1 + k % 3) + (f" Only{''.join(chr(97 + int(x)) for x in str(k))} said so." if k % 50 == 0 else "") for k in range(4200)] + [" \n", "贷款与保险的报告已于年内完成。" * 3]
    corpus = spark.createDataFrame([(f"s{k}", t, "accepted") for k, t in enumerate(texts)] + [("x", "Never read.", "rejected")], "sample_id string, text string, status string")
    assert len(stuffing.prose_sample(corpus)) == len(texts)
    model = stuffing.trained(stuffing.prose_texts(corpus).repartition(7))
    c, part, word, *_ = stuffing.read(texts, stuffing._Tokens())
    a, b = stuffing._before(c, part)
    keys, n = np.unique((a * model.k + b) * model.k + c, return_counts=True)
    plain = stuffing.ProseModel(dict(zip(keys.tolist(), n.tolist())), len(np.unique(word[word >= 0])))
    assert (model.keys == keys).all() and np.allclose(model.p3, plain.p3) and np.allclose(model.p2, plain.p2) and model.words == plain.words
    surprise = np.bincount(part, -np.log(plain.probability(c, part))) / np.bincount(part)
    assert math.isclose(model.high, math.exp(np.quantile(surprise, stuffing.PROSE_SHARE)) * stuffing.MARGIN, rel_tol=2e-4)
    assert len(model.low[False][0]) == len(stuffing.CHAINS) and len(model.low[True][0]) == 1
    rows = plain.shown(texts[:67])
    assert [sum(n for k, _, n, _ in rows if k == size) for size in stuffing.CHAINS] == [67, 33, 16, 8, 4, 2]
    empty = stuffing.trained(stuffing.prose_texts(corpus.limit(0)))
    assert empty.high == math.inf and not empty.low[False][1].any()
