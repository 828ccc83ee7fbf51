"""Mixing (10) and line dedup (8) against brute force."""

import random
import re
from collections import Counter, defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from laminar import checks
from laminar.llm import line_dedup, mixing, queries
from laminar.llm.common import WORD

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(WORD, text or "")


def filled(sizes: dict, weights=(5, 2, 1), cap=3):
    """Water-filling round by round: {source: target}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s] + 1e-9}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = float(cap * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("name", ["edge", "table"])
def test_mix_meets_targets(spark, name):
    docs = cases.documents(spark) if name == "edge" else spark.read.parquet(f"{SF}/documents.parquet")
    texts = {(r["doc_id"], r["text"], r["source"]) for r in docs.collect()}
    got = mixing.mix(cases.with_clashes(docs)).select("doc_id", "source", "text", "mix.*").collect()
    assert len(got) == docs.count() and {(r["doc_id"], r["text"], r["source"]) for r in got} == texts
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in got:
        assert r["size"] == len(words(r["text"])) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    expected = filled(sizes)
    for r in got:
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 2  # the boundary document gives part of its words


def test_mix_agrees_however_partitioned_and_is_written_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = mixing.mix(docs).select("doc_id", "mix.taken")
    b = mixing.mix(docs.repartition(5, "text")).select("doc_id", "mix.taken")
    assert cases.rows_of(a) == cases.rows_of(b)
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    sums = Counter()
    for r in out.collect():
        assert r["n_chars"] == len(r["text"])
        sums[r["doc_id"]] += len(words(r["text"]))
    assert sums == Counter({r["doc_id"]: r["taken"] for r in a.collect() if r["taken"]})


def test_mix_of_nothing(spark):
    assert mixing.mix(cases.empty(spark)).count() == 0
    assert mixing.repeated(cases.empty(spark)).count() == 0


def brute_lines(docs, least=50):
    """{(id, text): text without later repeated runs}: every window is compared."""
    seen, out = set(), {}
    for i, text in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0)):
        if text is None:
            out[i, text] = None
            continue
        lines = text.split("\n")
        full = [k for k, x in enumerate(lines) if words(x)]
        gone, own = set(), []
        for a in range(len(full)):
            n = 0
            for b in range(a, len(full)):
                n += len(words(lines[full[b]]))
                if n >= least:
                    own.append((tuple(lines[k] for k in full[a : b + 1]), full[a], full[b]))
                    break
        for content, start, stop in own:
            if content in seen:
                gone.update(range(start, stop + 1))
            seen.add(content)
        out[i, text] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("ab cd ef gh ij".split()) + str(k) for _ in range(rng.randint(0, 30))) for k in range(12)]
    passage = [rng.choice(pool) for _ in range(6)]
    rows = []
    for i in range(40):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"own {i} {k}" for k in range(rng.randint(0, 12))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(lines))
            lines[at:at] = passage
        rows.append((i, "\n".join(lines), "en", "a"))
    docs = cases.documents(spark, rows)
    got = {(i, t): k for i, t, k in zip(*_columns(docs, line_dedup.dedup_lines(docs, both_ways=False)))}
    assert got == brute_lines([(r[0], r[1]) for r in rows])


def _columns(docs, out):
    before = docs.select("doc_id", F.col("text").alias("before"))
    rows = out.select("doc_id", F.col("text").alias("kept")).join(before, "doc_id").collect()
    return [r["doc_id"] for r in rows], [r["before"] for r in rows], [r["kept"] for r in rows]


def brute_runs(docs, least=50):
    """{(id, text): text without later repeated runs}: every run of enough words is compared.
    A null text stays as it is."""
    runs, first = [], {}
    for i, text in set(docs):
        if text is None:
            continue
        lines = text.split("\n")
        full = [k for k, x in enumerate(lines) if words(x)]
        size = [len(words(lines[k])) for k in full]
        for a in range(len(full)):
            for b in range(a, len(full)):
                if sum(size[a : b + 1]) >= least:
                    content, place = tuple(lines[k] for k in full[a : b + 1]), (i is None, i or 0, full[a])
                    runs.append((content, place, text, full[b]))
                    first[content] = min(first.get(content, place), place)
    gone = defaultdict(set)
    for content, place, text, stop in runs:
        if place != first[content]:
            gone[place[:2], text].update(range(place[2], stop + 1))
    keep = lambda i, t: [x for k, x in enumerate(t.split("\n")) if k not in gone[(i is None, i or 0), t]]
    return {(i, t): None if t is None else "\n".join(keep(i, t)) for i, t in docs}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup_both_ways(spark, seed):
    rng = random.Random(seed)
    line = lambda n: " ".join(f"{rng.choice('abcde')}{rng.randint(0, 99)}" for _ in range(n))
    passages = [[line(n) for n in sizes] for sizes in ([60, 10, 10], [5, 70, 3, 3], [20, 20, 20, 20], [49], [1] * 55)]
    rows = []
    for i in range(30):
        lines = [f"own {i} {k}" for k in range(rng.randint(0, 5))]
        for p in rng.sample(passages, rng.randint(0, 2)):
            at = rng.randint(0, len(lines))
            lines[at:at] = [*p, ""] if rng.random() < 0.5 else p
        rows.append((i, "\n".join(lines), "en", "a"))
    docs = cases.documents(spark, rows)
    got = {(i, t): k for i, t, k in zip(*_columns(docs, line_dedup.dedup_lines(docs)))}
    assert got == brute_runs([(r[0], r[1]) for r in rows])
    assert got != brute_lines([(r[0], r[1]) for r in rows])  # lines after the last window go, too


def test_line_dedup_edge_rows(spark):
    passage = "\n".join(" ".join(f"w{k}x{j}" for j in range(20)) for k in range(4))
    rows = [*cases.ROWS, (20, f"start\n{passage}\nend", "en", "a"), (21, passage, "en", "a"), (None, f"{passage}\nx", "en", "a")]
    docs = cases.with_clashes(cases.documents(spark, rows))
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "removed_runs"] and out.count() == len(rows)
    kept = {r["doc_id"]: r for r in out.where("doc_id in (2, 3, 6, 20, 21)").collect()}
    assert kept[20]["text"] == f"start\n{passage}\nend" and kept[21]["text"] == "" and kept[21]["n_chars"] == 0
    assert kept[3]["text"] is None and kept[6]["text"] == cases.LONG
    assert {r["text"] for r in out.where("doc_id is null").collect()} == {"a row without an id", None, "x"}
    assert line_dedup.dedup_lines(cases.empty(spark)).count() == 0


def test_line_dedup_of_very_many_lines(spark):
    """A document of 30,000 lines with thousands of runs of its own and another's."""
    passage = [" ".join(f"p{k}w{j}" for j in range(10)) for k in range(6)]
    own = lambda n: [f"own line {n} {k}" for k in range(2)]
    long = "\n".join(x for n in range(3750) for x in [*passage, *own(n)])
    docs = cases.documents(spark, [(1, "\n".join(passage), "en", "a"), (2, long, "en", "a"), (3, long, "en", "a")])
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert got[1] == "\n".join(passage)
    assert got[2] == "\n".join(x for n in range(3750) for x in own(n))
    assert got[3] == ""


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = checks.duckdb_connection(SF)
    res = checks.compare(queries.QUERIES[name](spark, SF), con, queries.ORACLE[name])
    assert res["values_match"] and res["types_match"], res
