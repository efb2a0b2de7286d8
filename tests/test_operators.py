import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataline.operators import dedup, graph, mixture, near_duplicates, selection, state


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_keep_first_with_nulls_and_ties(spark):
    df = spark.createDataFrame([(1, "a", 9), (2, "a", 9), (3, None, 9), (4, None, 9)], "id int, k string, representative_x int")
    got = {r["id"]: (r["representative"], r["is_kept"]) for r in dedup.keep_first(df, F.col("k"), "id").collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (4, True)}


def test_priority_union_delta_append_upsert(spark):
    a = spark.createDataFrame([("x", 1), ("y", 1)], "k string, v int")
    b = spark.createDataFrame([("y", 2), ("z", 2)], "k string, v int")
    assert rows(dedup.priority_union([a, b], "k")) == {("x", 1), ("y", 2), ("z", 2)}
    fresh, known = dedup.delta(b, a, "k")
    assert rows(fresh) == {("z", 2)} and rows(known) == {("y", 2)}
    once = dedup.append_distinct(a, b, "k")
    assert rows(dedup.append_distinct(once, b, "k")) == rows(once) == {("x", 1), ("y", 1), ("z", 2)}
    assert rows(dedup.upsert_status(a, b, "k", "v")) == {("x", "missing"), ("y", "changed"), ("z", "new")}
    assert rows(dedup.full_cover(a, b, "k")) == {("x", True), ("z", False)}
    empty = a.limit(0)
    assert rows(dedup.append_distinct(empty, empty, "k")) == set()


def _texts(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"word{k}" for k in range(60)]
    out = []
    for k in range(n):
        if out and rng.random() < 0.5:
            words = list(rng.choice(out))
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        out.append(words)
    return [(k, " ".join(w)) for k, w in enumerate(out)]


def _shingles(text):
    w = text.lower().split(" ")
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_duplicates_match_brute_force(spark):
    data = _texts(60, 4) + [(100, None), (101, ""), (102, "one")]
    df = spark.createDataFrame(data, "doc_id int, text string").withColumn("h", F.lit(1)).withColumn("k", F.lit("clash"))
    got = {r["doc_id"]: (r["class_id"], r["links"]) for r in near_duplicates.near_duplicate_classes(df, "doc_id").collect()}
    first = {}
    for k, t in data:
        if t is not None:
            first.setdefault(t, k)
    sets = {k: _shingles(t) for t, k in first.items()}
    links = {k: sum(1 for j in sets if j != k and len(sets[k] & sets[j]) >= 0.8 * len(sets[k] | sets[j])) for k in sets}
    assert got == {k: (first[t], links[first[t]]) for k, t in data if t is not None}


def test_greedy_is_not_transitive(spark):
    nodes = spark.createDataFrame([(k,) for k in range(1, 6)], "k int")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (2, 3)], "a int, b int")
    assert rows(near_duplicates.greedy_decisions(nodes, pairs)) == {(1, True), (2, False), (3, True), (4, False), (5, True)}
    assert rows(near_duplicates.greedy_decisions(nodes, pairs.limit(0))) == {(k, True) for k in range(1, 6)}


def test_greedy_matches_sequential_model(spark):
    rng = random.Random(1)
    edges = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(60)}
    kept = []
    for k in range(40):
        if not any((j, k) in edges for j in kept):
            kept.append(k)
    got = near_duplicates.greedy_decisions(spark.range(40).withColumnRenamed("id", "k"), spark.createDataFrame(list(edges), "a long, b long"))
    assert sorted(r["k"] for r in got.where("keep").collect()) == kept


def test_lineage_with_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("d", None), ("d", "a")], "child string, parent string")
    assert ("d", "c", 3) in rows(graph.ancestors(edges))
    assert {r[0] for r in graph.cyclic_nodes(edges).collect()} == {"a", "b", "c"}
    tree = edges.where("child <> 'c'")
    assert graph.would_cycle(tree, "c", "a") and not graph.would_cycle(tree, "d", "c")
    assert rows(graph.ancestors(edges.limit(0))) == set()


def test_families_match_union_find(spark):
    rng = random.Random(3)
    data = [(f"m{rng.randrange(50):02}", f"g{rng.randrange(60)}") for _ in range(70)] + [("m00", None), (None, "g1"), ("alone", None)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for m, g in data:
        if m is not None:
            find(m)
            if g is not None:
                parent[find("#" + g)] = find(m)
    comps = {}
    for m in {m for m, _ in data if m}:
        comps.setdefault(find(m), []).append(m)
    want = {(m, min(c)) for c in comps.values() for m in c}
    assert rows(graph.families(spark.createDataFrame(data, "m string, g string"), "m", "g")) == want


def test_largest_remainder_and_quota(spark):
    w = spark.createDataFrame([("a", 0.5), ("b", 0.25), ("c", 0.25), ("d", None)], "k string, w double")
    assert rows(selection.largest_remainder(w, "k", "w", 10)) == {("a", 5), ("b", 3), ("c", 2), ("d", 0)}
    assert rows(selection.largest_remainder(w.where("k = 'd'"), "k", "w", 10)) == {("d", 0)}
    docs = spark.createDataFrame([("a", k) for k in range(8)] + [("b", 1)], "k string, id int")
    quotas = spark.createDataFrame([("a", 3), ("b", 4)], "k string, quota long")
    order = sorted(range(8), key=lambda k: hashlib.sha256(str(k).encode()).hexdigest())
    got = mixture.quota_select(docs, quotas, "k", "id")
    assert {(r["k"], r["id"], r["rank"]) for r in got.collect()} == {*(("a", x, k + 1) for k, x in enumerate(order[:3])), ("b", 1, 1)}
    assert [(r["k"], r["id"]) for r in selection.round_robin(docs, "k", [F.col("id")], 3).collect()] == [("a", 0), ("b", 1), ("a", 1)]


def _walk(records, quotas, cap, redistribute):
    """The mixture, one record after the other."""
    order = sorted(records, key=lambda r: hashlib.sha256(r[0].encode()).hexdigest())
    seen, eligible = {}, []
    for r in order:
        f = r[3] if r[3] is not None else ("alone", r[0])
        seen[f] = seen.get(f, 0) + 1
        if cap is None or seen[f] <= cap:
            eligible.append(r)
    room, out = dict(quotas), {}
    for k, g, n, _ in eligible:
        if g in room and n <= room[g]:
            room[g] -= n
            out[k] = "quota"
    left = sum(quotas.values()) - sum(n for k, _, n, _ in records if k in out)
    for k, g, n, _ in eligible:
        if redistribute and k not in out and quotas.get(g) and n <= left:
            left -= n
            out[k] = "redistributed"
    return out


@pytest.mark.parametrize("cap, redistribute", [(None, False), (2, False), (None, True), (3, True)])
def test_mixture_matches_a_walk(spark, cap, redistribute):
    rng = np.random.default_rng(5)
    records = [(f"r{k}", "abcd"[int(rng.integers(4))], int(rng.choice([1, 3, 40, 200, 900])), [None, f"f{int(rng.integers(25))}"][int(rng.integers(2))]) for k in range(160)]
    quotas = {"a": 1500, "b": 700, "c": 0, "e": 300}
    df = spark.createDataFrame([*records, ("bad", "a", 0, None), ("bad2", None, 5, None), (None, "a", 5, None)], "id string, g string, size long, fam string").withColumn("_before", F.lit("clash"))
    q = spark.createDataFrame(list(quotas.items()), "g string, quota long")
    got = mixture.mix(df, q, "g", "id", "size", family="fam", cap=cap, redistribute=redistribute)
    assert {r["id"]: r["chosen"] for r in got.collect()} == _walk(records, quotas, cap, redistribute)
    assert mixture.mixture_faults(df, got, q, "g", "id", "size", "fam", cap).count() == 0
    bad = got.unionByName(got.limit(1)).unionByName(got.limit(1).withColumn("id", F.lit("new")))
    assert {"unknown_record", "repeated_record"} <= {r["fault"] for r in mixture.mixture_faults(df, bad, q, "g", "id", "size", "fam", cap).collect()}
    report = {r["g"]: r for r in mixture.mixture_report(df, got, q, "g", "size").collect()}
    assert report["e"]["available"] == 0 and report["e"]["shortfall"] == 300
    assert mixture.mix(df.limit(0), q, "g", "id", "size").count() == 0


def test_vector_search_and_diversity(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((40, 16))
    x = np.concatenate([base, base[:20] + 0.05 * rng.standard_normal((20, 16)), np.zeros((1, 16))])
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + [(99, None)], "vec_id long, embedding array<double>")
    unit = x[:60] / np.linalg.norm(x[:60], axis=1, keepdims=True)
    sim = unit @ unit.T
    got = {(r["query_id"], r["rank"]): r["item_id"] for r in selection.top_by_similarity(df.where("vec_id in (0, 7, 60)"), df, 3).collect()}
    for q in (0, 7):
        order = [k for k in np.argsort(-sim[q]) if k != q][:3]
        assert [got[q, r] for r in (1, 2, 3)] == order
    assert not any(q == 60 for q, _ in got)
    found = rows(selection.cosine_pairs(df.select(F.col("vec_id").alias("k"), F.col("embedding").alias("v")), 0.95))
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if sim[i, j] >= 0.95}
    assert found <= want and len(found) >= 0.9 * len(want) > 0
    kept = {r[0] for r in selection.greedy_diverse(df, 0.95).collect()}
    assert set(range(40)) <= kept and not kept & set(range(40, 60))


def test_state(spark):
    df = spark.createDataFrame([(1, "g", False, 1), (2, "g", True, 2), (3, "h", False, 5)], "id int, g string, on boolean, o int")
    got = {r["id"]: r["is_selected"] for r in state.resolve_versions(df, ["g"], F.col("on"), [F.col("o")]).collect()}
    assert got == {1: False, 2: True, 3: True}
    a = spark.createDataFrame([("d", 1, 0, 5000), ("d", 2, 4000, 4001), ("d", 3, 5000, 6000), ("e", 4, 0, 9), ("d", 5, None, 3)], "doc string, id int, s long, e long")
    pairs = {(r["l_id"], r["r_id"]) for r in state.overlapping(a, a, ["doc"], "s", "e", 1000).collect()}
    assert pairs == {(1, 1), (2, 2), (3, 3), (4, 4), (1, 2), (2, 1)}
    made = state.checks(df, "id", {"on": ("fail", F.col("on")), "o": ("warn", F.col("o") > 1)})
    assert {r["id"]: r["qc_passed"] for r in made.collect()} == {1: False, 2: True, 3: False}
    assert ("on", "fail", 2) in rows(state.check_summary(made))
    assert rows(state.next_attempt(df.withColumnRenamed("o", "attempt"), ["g"])) == {("g", 3), ("h", 6)}


def test_diversity_goes_by_score_and_recall_holds_at_the_threshold(spark):
    near = [[1.0, 0.0], [0.95, 0.3122], [0.8, 0.6]]  # 0-1 and 1-2 reach 0.9, 0-2 does not
    df = spark.createDataFrame([(k, v, s) for k, (v, s) in enumerate(zip(near, [1.0, 2.0, None]))], "vec_id long, embedding array<double>, q double")
    assert rows(selection.greedy_diverse(df, 0.9)) == {(0,), (2,)}
    assert rows(selection.greedy_diverse(df, 0.9, score=F.col("q"))) == {(1,)}
    assert rows(selection.greedy_diverse(df, 0.9, score=-F.col("q"))) == {(0,), (2,)}
    rng = np.random.default_rng(1)
    for t in (0.8, 0.9, 0.95):
        a, b = np.linalg.qr(rng.standard_normal((800, 64, 2)))[0].transpose(2, 0, 1)
        x = np.concatenate([a, (t + 1e-6) * a + np.sqrt(1 - (t + 1e-6) ** 2) * b])
        found = rows(selection.cosine_pairs(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "k long, v array<double>"), t))
        assert len(found & {(k, k + 800) for k in range(800)}) >= 0.99 * 800
    assert selection.sign_bands(-1.0) == (0, 1) and selection.sign_bands(1.0) == (12, 1)
