"""The road of the language model whose filter is too large to broadcast."""

import glob

import cases
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from laminar.llm import language_model as lm
from laminar.session import shared_root


def corpus(spark):
    word = lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(40 + 13 * k)))
    made = spark.range(300).select((F.col("id") + 100).alias("doc_id"))
    made = made.withColumn("text", F.concat_ws(" ", *[word(k) for k in range(40)]))
    return cases.documents(spark).select("doc_id", "text").unionByName(made)


def test_chunks_of_any_size_score_alike(spark, monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT_CHARS", 1_000)  # over 100 segments in several groups
    docs = corpus(spark)
    train = lm.outside_fold(docs)
    whole = cases.rows_of(lm.score(docs, train, head_words=20), "doc_id", "lm.*")
    for tokens in (1, 700, 1 << 20):
        monkeypatch.setattr(lm, "_FLUSH", tokens)
        apart = cases.rows_of(lm.score(docs, train, head_words=20, max_filter_bytes=0), "doc_id", "lm.*")
        assert [r[:4] for r in apart] == [r[:4] for r in whole] and len(whole) == 300 + len(cases.ROWS)
        assert np.allclose([r[4:] for r in apart], [r[4:] for r in whole], rtol=1e-12)
    assert not glob.glob(f"{shared_root(spark).removeprefix('file:')}/laminar/lm-*")


def test_a_chunk_asks_once_for_what_differs():
    rng = np.random.default_rng(5)
    vocabulary = np.sort(rng.integers(0, 1 << 63, 500, dtype=np.uint64))
    words = rng.integers(1, 500, 20_000)
    ends = np.arange(99, len(words), 100)
    words[ends] = 0
    none = np.zeros(0, dtype=np.uint64)
    model = lm.Model(none, none.astype(np.int64), none, none.astype(float), 10, 5, 0.5, 40)
    packed = lm._packed_chunk(words, vocabulary, np.full(200, 100))
    assert len(packed[1]) == 4 * len(words) and not any(packed[1][2 * len(words) :])
    chunk = lm._Chunk(model, *packed)
    asked = pd.DataFrame(list(chunk.questions()), columns=["group", "pair", "pair_n", "word", "word_n"])
    before = np.concatenate(([0], words[:-1]))
    before[::100] = 0
    pairs = set(zip(before.tolist(), words.tolist()))
    assert len(asked) == 3  # a row for each group of 16 of the 40 segments
    assert asked["pair"].map(len).sum() == 8 * len(pairs) and asked["word"].map(len).sum() == 8 * 500
    keys = lm.pair_key(vocabulary[[h for h, _ in pairs]], vocabulary[[w for _, w in pairs]])
    assert set(lm.unpacked(asked["pair"], np.uint64).tolist()) == set(keys.tolist())
