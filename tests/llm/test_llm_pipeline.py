"""The corpus pipeline, stage by stage, and its rows against the tokenizers library."""

import hashlib

import cases
import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

SF, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    from test_llm_mixing_lines import brute_runs, words
    from test_llm_near import brute_components, brute_print
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        kept[name] = docs, spark.read.parquet(str(tmp_path / name))
        docs = kept[name][1]
        if name != "bpe":
            assert docs.columns == columns
    before, after = kept["toxicity"]
    ids = {r["doc_id"] for r in after.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()}
    assert len(clean & ids) >= 0.97 * len(clean)
    before, after = kept["line_dedup"]
    expected = brute_runs([(r["doc_id"], r["text"]) for r in before.collect()])
    assert sorted(r["text"] for r in after.collect()) == sorted(expected.values())
    before, after = kept["simhash"]
    groups = brute_components({r["doc_id"]: brute_print(r["text"]) for r in before.collect()})
    assert {r["doc_id"] for r in after.collect()} == set(groups.values())
    before, after = kept["mix"]
    size = before.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0]
    total = sum(len(words(r["text"])) for r in after.collect())
    assert 0.9 * size <= total <= 1.1 * size
    before, after = kept["bpe"]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.no_truncation()
    tok.no_padding()
    want = []
    for r in before.collect():
        found = tok.encode(r["text"], add_special_tokens=False).ids
        back = tok.decode(found, skip_special_tokens=False)
        want.append((r["doc_id"], r["source"], len(found), hashlib.sha256(np.array(found, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert cases.rows_of(after) == sorted(want, key=repr)


def test_stages_on_edge_rows_and_nothing(spark):
    for docs in (cases.documents(spark), cases.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).checkpoint()
        assert docs.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_toxic_documents_go(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.reject_toxic(spark, docs, SF01).select("doc_id").collect()}
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()}
    assert len(toxic & kept) <= 0.4 * len(toxic) and len(clean & kept) >= 0.98 * len(clean)


def test_run(spark):
    first, second = (corpus_pipeline.run(spark, SF) for _ in range(2))
    assert cases.rows_of(first) == cases.rows_of(second) and first.count() > 0
