"""What the operators on whole texts hold at a time on an executor."""

import cases
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from laminar.llm import bpe, common, simhash, toxicity

ARROW = "spark.sql.execution.arrow"


@pytest.fixture
def default_batches(spark):
    names = [f"{ARROW}.maxBytesPerBatch", f"{ARROW}.maxRecordsPerBatch"]
    for n in names:
        spark.conf.unset(n)
    yield
    for n in names:
        spark.conf.unset(n)


def largest_batch(spark) -> int:
    """Bytes of the largest batch of 3,000 texts of 20 KB or more that a Python worker gets."""

    @F.pandas_udf("long")
    def rows(texts: pd.Series) -> pd.Series:
        return pd.Series([len(texts)] * len(texts))

    text = F.repeat(F.col("id").cast("string"), 20_000)
    most = spark.range(1, 3001, 1, 1).select(rows(text).alias("n")).agg(F.max("n")).first()[0]
    return 20_000 * most


def test_whole_texts_reach_python_in_small_batches(spark, default_batches):
    docs = cases.documents(spark)
    model = toxicity.fit(docs.select("doc_id", "text"), spark.createDataFrame([], "doc_id long, toxic int"))
    operators = [
        lambda: toxicity.score(docs, model),
        lambda: simhash.components(docs),
        lambda: bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")),
    ]
    for run in operators:
        for n in ("maxBytesPerBatch", "maxRecordsPerBatch"):
            spark.conf.unset(f"{ARROW}.{n}")
        assert run().count() == len(cases.ROWS)
        assert largest_batch(spark) <= 2 * common.BATCH_BYTES


def test_smaller_batches_stay(spark, default_batches):
    spark.conf.set(f"{ARROW}.maxBytesPerBatch", "1000")
    spark.conf.set(f"{ARROW}.maxRecordsPerBatch", "0")  # no limit
    common.small_batches(spark)
    assert spark.conf.get(f"{ARROW}.maxBytesPerBatch") == "1000"
    assert spark.conf.get(f"{ARROW}.maxRecordsPerBatch") == str(common.BATCH_ROWS)


def test_simhash_masks_need_no_python_rows(spark, monkeypatch):
    """Rows that the driver deals out as tuples start Python workers on the executors."""
    codes = spark.range(0, 40).select((F.col("id") * 5).alias("code"))
    want = {tuple(r) for r in simhash.similar(spark, codes).collect()}

    def refused(*args, **kwargs):
        raise AssertionError("tuples were dealt out")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    assert {tuple(r) for r in simhash.similar(spark, codes).collect()} == want and want
