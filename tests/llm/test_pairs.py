"""Operators on groups and pairs: problems 1, 3, 6 and 7, against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strataline.llm import crossing, groups, history, leakage
from strataline.llm.text import guard, normalized, sha256_hex, shingles


def rows(df):
    return {tuple(r) for r in df.collect()}


def _components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    out = defaultdict(set)
    for x in parent:
        out[find(x)].add(x)
    return {frozenset(c) for c in out.values()}


@pytest.mark.parametrize("seed, part", [(0, groups.PART), (1, 4)])
def test_components_match_union_find(spark, seed, part):
    """With lists in parts of 4 the hub's list has several."""
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(60)}", f"k{rng.randrange(45)}") for _ in range(70)] + [(f"p{k}", f"p{k + 1}") for k in range(25)]
    edges += [("hub", f"leaf{k}") for k in range(30)] + edges[:5] + [("solo", "solo")]
    got = groups.components(spark.createDataFrame([*edges, (None, "x"), ("x", None)], "src string, dst string"), part)
    parts = defaultdict(set)
    for r in got.collect():
        parts[r["component"]].add(r["node"])
    assert {frozenset(c) for c in parts.values()} == _components([e for e in edges if e[0] != e[1]])
    assert all(c in members for c, members in parts.items())


def test_components_of_nothing(spark):
    assert groups.components(spark.createDataFrame([], "src string, dst string")).count() == 0


def _case_tables(spark):
    group = "source_group string, base_snapshot_group string, template_family string"
    cases = [
        ("c1", 1, "train", ("work-W1", None, "t"), ["v1"]),
        ("c2", 1, " TEST ", (" W1 ", None, "t"), None),
        ("c3", 1, "train", (None, "s1", "t"), ["v2", "v2", None]),
        ("c4", 1, "validation", ("unknown", "S1", "t"), []),
        ("c5", 1, "train", ("n/a", "unknown", "t"), ["nowhere"]),
        ("c6", 1, "test", None, None),
        ("c7", 1, "test", ("w7", None, "t"), None), ("c7", 2, "train", ("w7", None, "t"), None), ("c7", 2, "train", ("w7", None, "t"), None),
        ("c8", 1, None, ("w8", None, "t"), None),
        ("c9", 1, "train", ("w9", None, "t"), None), ("c10", 1, "test", ("w10", None, "t"), None),
        ("c11", 1, "design_demo", ("w9", "s2", "t"), None), ("c12", 1, "test", (None, "s2", "t"), None),
        (None, 1, "train", ("w1", None, "t"), None),
    ]
    agent = spark.createDataFrame(cases, f"case_id string, updated_at int, split string, grouping struct<{group}>, evidence_chunks array<string>").withColumn("node", F.lit("clash"))
    chunks = spark.createDataFrame([("v1", "w1"), ("v1", "w1"), ("v2", "w2"), (None, None), ("v3", "w33"), ("v4", None)], "chunk_version_uid string, work_uid string").withColumn("component", F.lit(1))
    docs = spark.createDataFrame(
        [("d1", 1, "w9", "600001"), ("d2", 1, "w10", "600001.XA"), ("d2", 2, "w10", "000000"), ("d3", 1, "w7", "XB 600002"), ("d4", 1, "w8", "600002 "), ("d5", 1, None, None)],
        "document_uid string, updated_at int, work_uid string, stock_code string",
    )
    return agent, chunks, docs


def test_cases_and_splits(spark):
    agent, chunks, docs = _case_tables(spark)
    placed, _ = groups.case_components(agent, chunks, docs)
    # c1-c2 share a work; c3-c4 a snapshot; c9-c11-c12 chain through a demo case; w10 lost its issuer in its last state.
    assert {r[0] for r in groups.split_conflicts(placed).collect()} == {"c1", "c2", "c3", "c4", "c9", "c12"}
    got = groups.splits(agent, chunks, docs).collect()
    assert len(got) == 12
    by = defaultdict(set)
    for r in got:
        by[r["component"]].add(r["assigned"])
    assert all(len(s) == 1 for s in by.values())
    made = {r["chunk_version_uid"]: r["assigned"] for r in groups.chunk_splits(agent, chunks, docs).collect()}
    case = {r["case_id"]: r["assigned"] for r in got}
    assert made["v1"] == case["c1"] and made["v2"] == case["c3"] and made["v3"] and made["v4"]


def test_works_without_a_case_tie_their_issuers(spark):
    group = "source_group string, base_snapshot_group string, template_family string"
    case = [(f"c{k}", 1, "test" if k == 7 else "train", (f"w{k}", None, "t"), None) for k in range(40)]
    agent = spark.createDataFrame([*case, ("far", 1, "test", ("elsewhere", None, "t"), None)], f"case_id string, updated_at int, split string, grouping struct<{group}>, evidence_chunks array<string>")
    # Issuers 0-39 have a case each; work m, without a case, belongs to all of these. Works o80 and q80 share two issuers in turn.
    own = [(f"w{k}", k) for k in range(40)] + [("m", k) for k in range(40)]
    loose = [x for k in range(80, 160, 2) for x in ((f"o{k}", k), (f"q{k}", k), (f"q{k}", k + 1), (f"r{k}", k + 1))]
    docs = spark.createDataFrame([(f"d{n}", 1, w, f"{600000 + i}") for n, (w, i) in enumerate(own + loose)], "document_uid string, updated_at int, work_uid string, stock_code string")
    chunks = spark.createDataFrame([(w, w) for w in sorted({w for w, _ in own + loose})], "chunk_version_uid string, work_uid string")
    made = {r["chunk_version_uid"]: r["assigned"] for r in groups.chunk_splits(agent, chunks, docs).collect()}
    cases = groups.splits(agent, chunks, docs).collect()
    tied = [r for r in cases if r["case_id"] != "far"]
    assert {made[w] for w, _ in own} == {r["assigned"] for r in tied} and len({made[w] for w, _ in own}) == 1
    assert all(r["conflict"] for r in tied) and len({r["component"] for r in cases}) == 2 and sum(r["conflict"] for r in cases) == 40
    assert all(made[f"o{k}"] == made[f"q{k}"] == made[f"r{k}"] for k in range(80, 160, 2))
    assert len({made[f"o{k}"] for k in range(80, 160, 2)}) > 1


def test_splits_follow_the_shares(spark):
    data = [(f"c{k}", 1, "train", (f"w{k}", None, "t"), None) for k in range(600)] + [(f"h{k}", 1, "train", ("hot", None, "t"), None) for k in range(300)]
    agent = spark.createDataFrame(data, "case_id string, updated_at int, split string, grouping struct<source_group string, base_snapshot_group string, template_family string>, evidence_chunks array<string>")
    _, chunks, docs = _case_tables(spark)
    n = {r["assigned"]: r["n"] for r in groups.splits(agent, chunks, docs).groupBy("assigned").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(n["train"] - 720) < 30 and abs(n["validation"] - 90) < 30 and abs(n["test"] - 90) < 30
    assert groups.splits(agent.limit(0), chunks.limit(0), docs.limit(0)).count() == 0


def _samples(seed, n):
    rng = random.Random(seed)
    vocabulary = ["alpha", "bond", "credit", "duration", "equity", "fund", "growth", "hedge", "income", "junior", "kapital", "lease", "margin", "note"]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            t = rng.choice(texts)
            kind = rng.random()
            if kind < 0.3:
                t = t.upper() + " "
            elif kind < 0.8 and t:
                k = rng.randrange(len(t))
                t = t[:k] + rng.choice(["x", " new", ""]) + t[k + rng.randint(0, 2) :]
        else:
            t = " ".join(rng.choice(vocabulary) + rng.choice(["", "s", "ed"]) for _ in range(rng.choice([2, 8, 30, 60])))
        texts.append(t)
    return texts, rng


def test_history_matches_brute_force(spark):
    texts, rng = _samples(5, 120)
    texts[3], texts[4], texts[5] = None, "", "z" * 20_000
    corpus, index = [], []
    for k, t in enumerate(texts):
        status = rng.choice(["accepted", "accepted", "rejected"]) if k < 80 else "pending"
        row = (k, f"s{k}", t, rng.choice(["A", "A", "B"]), k // 10, status)
        norm = normalized(t) if t is not None else None
        if status == "accepted" and rng.random() < 0.8 and t is not None:
            index.append((k, f"s{k}", row[3], guard(norm), sha256_hex(norm), len(norm), shingles(norm), row[4]))
            if rng.random() < 0.3:
                continue  # known from the index only
        corpus.append(row)
    c = spark.createDataFrame(corpus + corpus[:9] + [(None, "s", "t", "A", 1, "pending"), (500, "s500", texts[90], None, 99, "pending")], "seq long, sample_id string, text string, scope string, batch_no int, status string").withColumn("rep", F.lit(0))
    i = spark.createDataFrame(index, "seq long, uid string, scope string, guard string, normalized_hash string, chars int, shingles array<long>, batch_no int").withColumn("grp", F.lit(0))
    known = {k: (s, g, h, n, set(x), b, False) for k, _, s, g, h, n, x, b in index}
    for k, _, t, s, b, status in corpus:
        if status != "rejected" and t is not None and k not in known:
            norm = normalized(t)
            known[k] = (s, guard(norm), sha256_hex(norm), len(norm), set(shingles(norm)), b, status == "pending")
    want = set()
    for b, y in known.items():
        for a, x in known.items():
            if y[6] and x[5] < y[5] and x[:2] == y[:2]:
                if x[2] == y[2] or (min(x[3], y[3]) >= 80 and len(x[4] & y[4]) >= 0.9 * len(x[4] | y[4])):
                    want.add((a, b))
    assert len(want) > 20
    assert rows(history.duplicates_of_pending(c, i)) == want
    assert history.duplicates_of_pending(c.limit(0), i.limit(0)).count() == 0


def test_stored_index_takes_batches_one_by_one(spark, tmp_path):
    """Three batches asked in turn against a growing index give what one comparison of all gives; no segment is made twice."""
    texts, rng = _samples(9, 90)
    rows_ = [(k, f"s{k}", t, "A", 1 + k // 30) for k, t in enumerate(texts)]
    schema = "seq long, sample_id string, text string, scope string, batch_no int, status string"
    nothing = spark.createDataFrame([], "seq long, uid string, scope string, guard string, normalized_hash string, chars int, shingles array<long>, batch_no int")
    path, held = str(tmp_path / "index"), []
    for batch in (2, 3, 4):
        seen = [(*r, "pending" if r[4] == batch else "rejected" if r[0] == 5 and batch > 2 else "accepted") for r in rows_ if r[4] <= batch]
        corpus = spark.createDataFrame(seen, schema)
        assert rows(history.duplicates_of_pending(corpus, nothing, path=path)) == rows(history.duplicates_of_pending(corpus, nothing))
        assert rows(history.duplicates_of_pending(corpus, nothing, path=path)) == rows(history.duplicates_of_pending(corpus, nothing))  # again: nothing to append
        index = history.SegmentIndex(spark, path)
        held.append((index.texts().count(), index.texts().select(*history.KEY).distinct().count()))
    assert all(n == distinct for n, distinct in held) and held[0][0] < held[1][0] < held[2][0]


def test_crossing_matches_brute_force(spark):
    texts, rng = _samples(6, 120)
    texts[3], texts[4] = None, ""
    data = [(k, f"s{k}", t, rng.choice(["train", " Train", "TEST", "validation", None, "dev"])) for k, t in enumerate(texts)]
    df = spark.createDataFrame(data + data[:7] + [(None, "s", texts[0], "train")], "seq long, sample_id string, text string, split string").withColumn("hash", F.lit("clash"))
    clean = [(k, normalized(t), s.strip().lower()) for k, _, t, s in data if t is not None and s and s.strip().lower() in ("train", "test", "validation")]
    want = set()
    for a, x, s in clean:
        for b, y, u in clean:
            if s == "train" and u != "train":
                p, q = ({z[i : i + 5] for i in range(max(1, len(z) - 4))} for z in (x, y))
                if x == y or (min(len(x), len(y)) >= 80 and len(p & q) >= 0.8 * len(p | q)):
                    want.add((min(a, b), max(a, b)))
    assert len(want) > 15
    assert rows(crossing.crossing_pairs(df)) == want
    report = spark.createDataFrame([("s1", 1, "A ", 0), ("s1", 2, " a", 1), ("s2", 1, None, None)], "sample_id string, reported_at int, source_name string, split_conflicts int")
    got = crossing.crossing_report(df, report).collect()
    assert sum(r["samples"] for r in got) == sum(1 for _, _, s in clean if s != "train")
    assert sum(r["pairs"] for r in got) == len(want)
    assert crossing.crossing_pairs(df.limit(0)).count() == 0


@pytest.mark.parametrize("n, least", [(76, 0.99), (240, 0.995), (900, 0.995)])
def test_bands_hold_pairs_at_the_threshold(n, least):
    """Recall on pairs at 0.8, down to the shortest texts that are compared."""
    import numpy as np

    rng = np.random.default_rng(1)
    found = 0
    for _ in range(1000):
        common, rest = n * 8 // 9, n - n * 8 // 9
        both, a, b = (rng.integers(0, 2**63, k).astype(np.uint64) * np.uint64(2) for k in (common, rest, rest))
        x, y = crossing.bands([np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))])
        found += bool((x == y).any())
    assert found >= least * 1000


def test_words_and_myers():
    assert leakage.words("Ａ_b-c’d 12中文x ½") == ["a", "b", "c", "d", "12", "中", "文", "x", "1", "2"]
    rng = random.Random(2)

    def slow(p, t):
        row = [0] * (len(t) + 1)
        for i, x in enumerate(p, 1):
            new = [i]
            for j, y in enumerate(t, 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
            row = new
        return min(row)

    for _ in range(200):
        p, t = [rng.choice("abc") for _ in range(rng.randint(0, 9))], [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        assert leakage.myers_search(p, t) == slow(p, t)


def test_leaks_match_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(30))
    items = [(k, " ".join(word() for _ in range(rng.randint(5, 60))), rng.choice(["en", None, "de"])) for k in range(20)]
    items += [(50, "".join(chr(0x4E00 + rng.randrange(500)) for _ in range(90)), "zh"), (51, None, "en"), (None, "x " * 20, "en"), (52, "", "zh")]
    items += [(60, items[0][1] + " tail", "en")]  # two items share a passage
    docs = []
    for k in range(60):
        base = [word() for _ in range(rng.randint(0, 50))]
        pick = rng.choice(items[:20] + items[20:21])
        w = leakage.words(pick[1])
        n = rng.choice([10, 12, 13, 14, 30, 39, 40, 41])
        at = rng.randrange(max(1, len(w) - n))
        glue = "" if pick[2] == "zh" else " "
        docs.append((k, " ".join(base) + " , " + glue.join(w[at : at + n]).upper() + "! " + word()))
    docs += [(100, None), (101, ""), (None, items[0][1]), (102, (items[1][1] + " ") * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(7))
    it = spark.createDataFrame(items + items[:3], "item_id long, text string, lang string")
    want = set()
    for d, t in docs:
        if d is None or not t:
            continue
        own = leakage.words(t)
        for i, text, lang in items:
            if i is None or not text:
                continue
            n, w = (40 if lang == "zh" else 13), leakage.words(text)
            grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            if any(tuple(own[k : k + n]) in grams for k in range(len(own) - n + 1)):
                want.add((d, i))
    found = leakage.shared_passages(df, it)
    got = found.where("whole")
    assert rows(got.select("doc_id", "item_id")) == want and len(want) > 20
    assert got.count() == len(want) and found.where("distance > 0 and whole").count() == 0
    assert leakage.shared_passages(df, it.limit(0)).count() == 0 and leakage.shared_passages(df.limit(0), it).count() == 0


def test_edited_passages():
    """Passages with as many word edits as the budget are found wherever the edits fall, and pieces alone are not."""
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(40))
    rejected = 0
    for lang, run in (("en", leakage.RUN), ("zh", leakage.RUN_ZH)):
        item = [word() for _ in range(run * 3)]
        search = leakage.Pieces([(1, lang, " ".join(item))]).search
        budget = run // leakage.WORDS_PER_EDIT
        for _ in range(150):
            at = rng.randrange(len(item) - run)
            passage = item[at : at + run]
            for k in rng.sample(range(run), budget):
                passage[k] = rng.choice(["", "other", passage[k] + " more"])
            text = " ".join([word() for _ in range(9)] + passage + [word() for _ in range(9)])
            assert [h[0] for h in search(text)] == [1]
            at = rng.randrange(0, len(item) - run)
            piece = " ".join([word() for _ in range(30)] + item[at : at + run // 2] + [word() for _ in range(30)])
            rejected += not list(search(piece))
    assert rejected > 290
