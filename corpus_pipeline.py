"""A training corpus from ``documents``: five stages, each on all that the one before kept.

1. toxicity: documents that the weakly supervised classifier rejects go;
2. line_dedup: later repetitions of passages of 50 words or more go from the texts;
3. simhash: of each group of near-duplicates the least doc_id stays;
4. mix: sources are repeated and cut to their target weights;
5. bpe: token counts and digests of every text of the mix.

All stages but the last return the columns of ``documents``. Texts with nothing left after
stage 2 are near-duplicates of each other (stage 3 keeps one) and have no words to mix.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm import bpe, line_dedup, mixing, simhash, toxicity
from laminar.llm.common import read_table
from laminar.session import shared_root


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled rows among the documents; keep what scores below one half."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), toxicity.training_labels(labels))
    return toxicity.score(docs, model).where(F.col("toxicity") < 0.5).select(*docs.columns)


def dedup_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and n_tokens, ids_sha256, decoded_sha256 of each repetition."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.round_trip(docs.select("doc_id", "source", "text"), path).select(
        "doc_id", "source", "bpe.*"
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_passages),
    ("simhash", near_dedup),
    ("mix", mix_sources),
    ("bpe", tokenise),
]

# Toxicity, SimHash and BPE can't be expressed in SQL; the tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read
    again, so that a lost executor costs one stage at most."""
    docs = read_table(spark, sf_dir, "documents")
    root = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
