"""SpotSigs (1), SimHash (7) and nearest neighbours (9) against brute force."""

import hashlib
import random
from itertools import combinations

import cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from laminar.llm import components, neighbours, queries, simhash, spotsigs

SF, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_op1_edits_and_likeness(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    order = sorted(docs, reverse=True)
    got = {r["doc_id"]: r for r in queries.QUERIES["op1_document_fingerprints"](spark, SF).collect()}
    assert sorted(got) == sorted(docs)
    split = lambda p: {p[k : k + 16] for k in range(0, len(p), 16)}
    for i, doc_id in enumerate(order):
        text, after = docs[doc_id], docs[order[(i + 1) % len(order)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        r = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = split(r["fingerprint"]), split(r["edited_fingerprint"])
        c = split(got[order[(i + 1) % len(order)]]["fingerprint"])
        assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b))
        assert r["near_next"] == pytest.approx(len(a & c) / len(a | c))
    by_text = {}
    for i, t in docs.items():
        by_text.setdefault(t, set()).add(got[i]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())


def test_spotsigs_chains(spark):
    sigs = lambda t: set(spark.range(1).select(spotsigs.signatures(F.lit(t)).alias("s")).first()["s"])
    one = sigs("the house stands at the lake")  # spots: house (the), lake (the, no chain)
    assert one == sigs("THE house, stands!") and len(one) == 1
    assert len(sigs("")) == 1 and sigs("") != sigs("x")


@pytest.mark.parametrize("table", ["edge", "documents"])
def test_spotsigs_pairs_against_brute_force(spark, table):
    docs = cases.with_clashes(cases.documents(spark)) if table == "edge" else spark.read.parquet(f"{SF}/documents.parquet")
    members, pairs = spotsigs.near_pairs(docs)
    sets = {r["doc_id"]: set(r["s"]) for r in docs.where("doc_id is not null").select("doc_id", spotsigs.signatures(F.col("text")).alias("s")).collect()}
    cls = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == cls
    reps = sorted(set(cls.values()))
    near = {(a, b) for a, b in combinations(reps, 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert {(r["class_a"], r["class_b"]) for r in pairs.collect()} == near
    assert spotsigs.near_pairs(cases.empty(spark))[1].count() == 0


def brute_print(text, n=3):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    shingles = [b" ".join(w[k : k + n]) for k in range(len(w) - n + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(prints):
    ids, root = sorted(prints), {}
    for i in ids:
        root[i] = i
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in combinations(ids, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in ids}


def test_simhash_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_simhash_near_dedup"](spark, SF).collect()}
    prints = {i: brute_print(t) for i, t in docs.items()}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(prints)


@pytest.mark.parametrize("spread", [2, 12])
def test_similar_codes_in_large_groups(spark, spread):
    """Codes that differ in few low bits: one group far above its limit is dealt again."""
    rng = random.Random(spread)
    codes = {rng.getrandbits(64) for _ in range(40)}
    base = rng.getrandbits(64)
    while len(codes) < 1000:
        code = base
        for b in rng.sample(range(64), spread):
            code ^= 1 << b
        codes.add(code)
    codes = sorted(codes)
    frame = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "code long")
    roots = components.connected_components(simhash.similar(spark, frame, group_rows=256))
    got = {r["node"] % (1 << 64): r["root"] for r in roots.collect()}
    expected = brute_components(dict(enumerate(codes)))
    groups = {}
    for k, c in enumerate(codes):
        groups.setdefault(expected[k], set()).add(c)
    found = {}
    for c, r in got.items():
        found.setdefault(r, set()).add(c)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {frozenset(g) for g in found.values()}


def test_simhash_edge_rows(spark):
    docs = cases.with_clashes(cases.documents(spark))
    rows = simhash.components(docs).collect()
    assert len(rows) == len(cases.ROWS)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert by[1] != by[2] or len(by[2]) == 1
    assert by[2] == {(f"{brute_print(cases.ROWS[0][1]):016x}", 1)}
    assert by[3] == by[4] == by[5] == {("0" * 16, 3)} and ("0" * 16, 3) in by[None]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3, 6, 7, 8]
    assert simhash.components(cases.empty(spark)).count() == 0
    assert simhash.one_of_each(cases.empty(spark)).count() == 0


def brute_near(rows, k=20):
    ok = {i: np.array(v, dtype=np.float64) for i, v in rows.items() if v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in ok:
        if q % 20 == 0:
            near = sorted(((-float(ok[q] @ x), i) for i, x in ok.items() if i != q))[:k]
            out[q] = [i for _, i in near]
    return out


def test_nearest_recall(spark):
    rows = {r["vec_id"]: list(r["embedding"]) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()}
    got = {}
    for r in queries.QUERIES["op9_nearest_neighbours"](spark, SF01).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    expected = brute_near(rows)
    assert sorted(got) == sorted(expected)
    hits = 0
    for q, near in got.items():
        near.sort()
        assert [n[0] for n in near] == list(range(1, len(near) + 1)) and len({n[1] for n in near}) == len(near)
        assert near == [(k + 1, *x) for k, x in enumerate(sorted(((i, s) for _, i, s in near), key=lambda x: (-x[1], x[0])))]
        for _, i, s in near:
            assert s == pytest.approx(float(np.dot(np.array(rows[q], float), np.array(rows[i], float))), abs=1e-9)
        hits += len({n[1] for n in near} & set(expected[q]))
    assert hits / sum(map(len, expected.values())) >= 0.9


def unit_vectors(n, d=64, seed=0):
    x = np.random.default_rng(seed).standard_normal((n, d)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_nearest_recall_of_many_blocks(spark, monkeypatch):
    """Flat spectrum, 63 blocks: rounds go on until lists settle, and recall is the method's own."""
    monkeypatch.setattr(neighbours, "BLOCK_NODES", 64)
    x = unit_vectors(4000)
    built = []
    build = neighbours.build
    monkeypatch.setattr(neighbours, "build", lambda *a: built.append(build(*a)) or built[0])
    df = spark.createDataFrame(list(enumerate(x.tolist())), "id long, vec array<float>")
    got = {}
    for r in neighbours.nearest(df, F.col("id") % 20 == 0, 20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    new = F.avg(F.size(F.filter("fresh", lambda f: f)) / F.size("fresh"))
    assert built[0][0].agg(new).first()[0] < neighbours.MIN_CHANGED
    s = x[::20] @ x.T
    s[np.arange(len(s)), 20 * np.arange(len(s))] = -np.inf
    best = np.argpartition(-s, 20, axis=1)[:, :20]
    assert sorted(got) == list(range(0, 4000, 20))
    assert sum(len(got[20 * i] & set(b.tolist())) for i, b in enumerate(best)) / best.size >= 0.9


def test_search_goes_on_until_settled(spark):
    """A chain of nodes, searched from its far end: one hop a round."""
    n = 12
    x = np.array([[np.cos(a), np.sin(a), 0.0] for a in np.linspace(0, 1.5, n)], dtype=np.float16)
    nodes = spark.createDataFrame([(i, x[i].tobytes()) for i in range(n)], "id long, code binary")
    near = [[j for j in (i - 1, i + 1) if 0 <= j < n] for i in range(n)]
    graph = spark.createDataFrame(
        [(0, i, m, [0.0] * len(m), [False] * len(m)) for i, m in enumerate(near)], neighbours._GRAPH
    )
    asked = spark.createDataFrame([(0, x[-1].tobytes(), [0])], "id long, code binary, entry array<long>")
    found = neighbours.search(graph, 1, nodes, asked).first()
    assert list(found["nbr"]) == list(range(n))[::-1]


def test_nearest_edge_vectors(spark):
    rows = [(i, [float(i % 7 - 3), 1.0, float(i % 5)]) for i in range(90)]  # many copies and ties
    bad = [(200, None), (220, []), (240, [0.0, 0.0, 0.0]), (260, [None, 1.0, 1.0]), (280, [float("nan"), 1.0, 1.0]), (300, [float("inf"), 0.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows + bad, "id long, vec array<double>").withColumn("node", F.lit("x"))
    got = {}
    for r in neighbours.nearest(df, F.col("id") % 20 == 0, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert {q: [i for _, i in sorted(n)] for q, n in got.items()} == brute_near(dict(rows))
    none = spark.createDataFrame(bad, "id long, vec array<double>")
    assert neighbours.nearest(none, F.col("id") % 20 == 0).count() == 0
    two = neighbours.nearest(spark.createDataFrame(rows[:2], "id long, vec array<double>"), F.col("id") % 20 == 0)
    assert [(r["query_id"], r["vec_id"]) for r in two.collect()] == [(0, 1)]


def test_local_join_names_vectors_in_proportion(spark):
    """Five times the nodes: five times the vectors that a build round sends to its groups, and
    a few more. (With groups of 4,096 lists it was 17 times here.)"""
    named = []
    for n in (5_000, 25_000):
        nbr = F.transform(F.sequence(F.lit(1), F.lit(neighbours.DEGREE)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(n)))
        graph = spark.range(n).select("id", nbr.alias("nbr"), F.transform(nbr, lambda _: F.lit(True)).alias("fresh"))
        lists = neighbours._lists(graph, neighbours._joins(n), 0)
        named.append(lists.select("part", "u").distinct().count())
    assert named[1] <= 7.5 * named[0]
    assert named[1] <= (neighbours.DEGREE + neighbours.REVERSE) * 25_000
