"""Spelling variants (11) against brute force."""

import random
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pytest

from laminar.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def brute_words(rows, min_length=7, min_count=2):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= min_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def edits(word, letters):
    """All strings one edit from the word."""
    n = len(word)
    out = {word[:i] + word[i + 1 :] for i in range(n)}
    out |= {word[:i] + c + word[i + 1 :] for i in range(n) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(n + 1) for c in letters}
    return out - {word}


def brute(words, ratio=10):
    letters = sorted(set("".join(words)))
    forms, rows = {}, []
    for w, n in words.items():
        near = [v for v in edits(w, letters) if v in words]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        forms[w] = form
        rows.append([w, form, None, n, len(near), words[form] if form else None])
    for r in rows:
        root = r[0]
        while forms[root] is not None:
            root = forms[root]
        r[2] = root
    return sorted(tuple(r) for r in rows)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = brute(brute_words([tuple(r) for r in docs]))
    assert got(queries.QUERIES["op11_spelling_variants"](spark, SF)) == expected
    assert any(r[1] for r in expected) and any(not r[1] and r[4] for r in expected)


def made_up_words(seed=1, n=1500):
    """Few letters, so that near words abound, with chains of forms and ties."""
    rng = random.Random(seed)
    words = {}
    for _ in range(n):
        w = "".join(rng.choices("abcäß", k=rng.randrange(7, 9)))
        words[w] = rng.choice([2, 3, 25, 30, 300, 4000, 50_000])
    return words


@pytest.mark.parametrize("symbols", [1, 2, 8])
def test_made_up_words_against_brute_force(spark, symbols):
    words = made_up_words(n=300 if symbols == 1 else 1500)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = got(spelling.variants(df, symbols))
    assert rows == brute(words)
    assert any(r[1] and r[2] != r[1] for r in rows)  # chains


def test_neighbourhoods_are_whole():
    rng = random.Random(2)
    for size in (1, 2, 7, 12):
        word = "".join(rng.choices("abcdefgh", k=size))
        own, near = zip(*[(a, b) for a, b in spelling.neighbourhoods([word], 3)])
        near = np.concatenate(near)
        wanted = edits(word, "abcdefghijklmnop") | {word}
        assert set(spelling.reduced_hashes(sorted(wanted), 3).tolist()) == set(near.tolist())
        assert len(set(near.tolist())) == len(near)
        assert set(np.concatenate(own).tolist()) == set(spelling.reduced_hashes([word], 3).tolist())


def test_bitmap(spark):
    rng = np.random.default_rng(4)
    hashes = rng.integers(-(2**63), 2**63 - 1, 5000)
    df = spark.createDataFrame([(int(h),) for h in hashes], "class long")
    bitmap = spelling.class_bitmap(df, 1 << 18)
    assert spelling.in_bitmap(bitmap, hashes).all()
    assert set(np.flatnonzero(np.unpackbits(bitmap, bitorder="little"))) == set((hashes % (1 << 18)).tolist())
    assert not spelling.class_bitmap(df.where("false"), 1 << 16).any()


def test_many_lengths_in_small_blocks(monkeypatch):
    words = ["a" * k + "b" for k in range(1, 60)]
    whole = [np.concatenate(x).tolist() for x in zip(*spelling.neighbourhoods(words))]
    monkeypatch.setattr(spelling, "HELD", 50)
    parts = [np.concatenate(x).tolist() for x in zip(*spelling.neighbourhoods(words))]
    assert sorted(zip(*whole)) == sorted(zip(*parts))


def test_edge_rows(spark):
    long = "x" * 20_000
    texts = [
        "Beispiel BEISPIEL beispiel Äpfelchen äpfelchen Äpfelchen äpfelchen ×÷×÷×÷× ×÷×÷×÷×",
        f"{long} {long} {long}y {long}y " + "beispiel " * 50 + "beispeil beispeil beispie beispie",
        "İstanbul İstanbul ſſſſſſſſ ſſſſſſſſ kurz kurz",
    ]
    rows = [*cases.ROWS, *[(30 + i, t, "de", "a") for i, t in enumerate(texts)], (30, texts[0], "de", "a")]
    docs = cases.with_clashes(cases.documents(spark, rows))
    expected = brute_words([(i, t) for i, t, _, _ in rows])
    assert long in expected or any(len(w) > 10_000 for w in expected)
    counted = {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()}
    assert counted == expected
    words = {w: n for w, n in expected.items() if len(w) < 100}
    found = got(spelling.spelling_variants(docs))
    assert [r for r in found if len(r[0]) < 100] == brute(words)
    for r in found:
        if len(r[0]) >= 100:
            assert r[4] == sum(abs(len(w) - len(r[0])) == 1 for w in expected)
    assert spelling.spelling_variants(cases.empty(spark)).count() == 0
