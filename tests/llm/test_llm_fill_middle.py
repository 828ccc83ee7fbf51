"""Fill-in-middle (12) against brute force, DuckDB SQL and round trips."""

import hashlib
import random
import re

import cases
import numpy as np
import pyarrow as pa
import pytest

from laminar import checks
from laminar.llm import fill_middle, queries


def brute(doc_id, text, seed, rate, spm):
    """(n, form, prefix_chars, middle_chars, output) as the contract words it."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


LINES = ["", "\n", "a", "a\n", "\n\n", "ä\nß\n\U0001f600", "x\r\ny z\n", "<P", "<P\n>", "<P>", "q<M>\n", "<", ">\n", "<S\n", "M>\n"]


def made_up(n=400, seed=5):
    rng = random.Random(seed)
    return [(i, "".join(rng.choices(LINES, k=rng.randrange(12)))) for i in range(n)]


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (0, 50), (100, 100)])
@pytest.mark.parametrize("window", [1 << 20, 7])
def test_forms_against_brute_force(spark, monkeypatch, rate, spm, window):
    """Windows of any size give the same (tiny ones cut every text)."""
    rows = [(None, None), (1, None), (None, "a\nb"), *made_up()]
    monkeypatch.setattr(fill_middle, "WINDOW", window)
    draws = []
    for i, _ in rows:
        digest = hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
        draws.append([int(digest[8 * k : 8 * k + 8], 16) for k in range(4)])
    texts = pa.array([t for _, t in rows])
    made = fill_middle.scatter(texts, np.array(draws).T, rate, spm)
    expected = [brute(i, t, 3, rate, spm) for i, t in rows]
    assert [tuple(r.values()) for r in made.to_pylist()] == expected
    back = fill_middle.gather(made.field("output"), made.field("form"))
    assert back.to_pylist() == [t or "" for _, t in rows]


def test_slices_and_large_strings():
    texts = pa.array(["zero\n", None, "one\ntwo\nthree", "four\n\nfive\n"]).slice(1)
    h = np.array([[1, 5, 7], [2, 9, 3], [0, 0, 0], [10, 60, 90]])
    a = fill_middle.scatter(texts, h, 100, 50)
    b = fill_middle.scatter(texts.cast(pa.large_string()), h, 100, 50)
    assert a.to_pylist() == b.to_pylist()
    assert fill_middle.gather(a.field("output").slice(1), a.field("form").slice(1)).to_pylist() == texts.to_pylist()[1:]


def test_outputs_that_do_not_suit_their_form():
    for output, form in (("<P>a<S>b", "psm"), ("<S>a<P>b<M>c", "psm"), ("x<P>a<S>b<M>c", "psm"), ("a", "other")):
        with pytest.raises(ValueError):
            fill_middle.gather(pa.array([output]), pa.array([form]))


def test_edge_rows(spark):
    long = "".join(f"line {i} ä\n" for i in range(200_000))
    rows = [*cases.ROWS, (20, long, "en", "a"), (21, long[:-1].replace("\n", " "), "en", "a")]
    docs = cases.with_clashes(cases.documents(spark, rows)).withColumnRenamed("n_chars", "fim")
    out = fill_middle.fill_in_middle(docs, seed=7)
    assert set(out.columns) == set(docs.columns)
    back = fill_middle.restored(out["fim.output"], out["fim.form"])
    got = out.select("doc_id", "text", "fim.*", back.alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(
            r["doc_id"], r["text"], 7, 100, 50
        )
        assert r["back"] == (r["text"] or "")
    assert fill_middle.fill_in_middle(cases.empty(spark)).count() == 0


def test_query_against_sql(spark, duck01):
    sf = "/root/testdata/sf0.01"
    result = checks.compare(queries.QUERIES["op12_fill_in_middle"](spark, sf), duck01, queries.ORACLE["op12_fill_in_middle"])
    assert result["values_match"] and result["types_match"], result
