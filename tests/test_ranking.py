"""Distributed ranking and exact quantiles against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from laminar.operators.quantiles import approx_cuts, exact_cuts
from laminar.operators.ranking import global_rank

from brute import window_rank


def _ranked(df, n_parts, descending=True):
    got = global_rank(df, "v", ["k"], descending=descending, n_partitions=n_parts)
    want = window_rank(df, "v", ["k"], descending=descending)
    cols = ["k", "row_number", "rank", "percent_rank"]
    return (
        sorted(tuple(r) for r in got.select(*cols).collect()),
        sorted(tuple(r) for r in want.select(*cols).collect()),
    )


@pytest.mark.parametrize("n_parts", [1, 3, 8, 17])
@pytest.mark.parametrize("distinct", [1, 3, 40, 10_000])
def test_global_rank_matches_window(spark, n_parts, distinct):
    rnd = random.Random(n_parts * 1000 + distinct)
    rows = [(i, float(rnd.randrange(distinct))) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, v double")
    got, want = _ranked(df, n_parts)
    assert got == want


def test_hot_value_spans_partitions_and_nulls(spark):
    # a third of the rows share one value; some values are null (ranked last)
    rows = [(i, 7.0 if i % 3 == 0 else (None if i % 11 == 0 else float(i % 50))) for i in range(900)]
    df = spark.createDataFrame(rows, "k long, v double")
    for desc in (True, False):
        got, want = _ranked(df, 12, descending=desc)
        assert got == want


def test_single_row_and_empty(spark):
    one = spark.createDataFrame([(1, 5.0)], "k long, v double")
    r = global_rank(one, "v", ["k"], n_partitions=4).collect()[0]
    assert (r.row_number, r.rank, r.percent_rank) == (1, 1, 0.0)
    empty = spark.createDataFrame([], "k long, v double")
    assert global_rank(empty, "v", ["k"], n_partitions=4).count() == 0


def test_no_single_partition_exchange(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    plan = global_rank(df, "v", ["k"], n_partitions=8)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    # single-partition steps only ever read the per-partition statistics (one row per
    # range partition): their child already holds the aggregated __cnt column
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            assert "__cnt" in lines[i + 1] or "__last" in lines[i + 1], lines[i: i + 2]


@pytest.mark.parametrize("n", [1, 2, 5, 13, 200])
def test_exact_cuts_match_brute_force(spark, n):
    rnd = random.Random(n)
    vals = [float(rnd.randrange(30)) for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(vals)), "k long, v double")
    cuts = exact_cuts(df, "v", ["k"], n_partitions=5).collect()[0]
    s = sorted(vals)
    want = [s[max(1, math.ceil(p * n)) - 1] for p in (0.2, 0.4, 0.6, 0.8)]
    assert list(cuts) == want


def test_approx_cuts_close(spark):
    df = spark.range(10_000).select(F.col("id").alias("k"), F.col("id").cast("double").alias("v"))
    cuts = approx_cuts(df, "v", relative_error=0.05).collect()[0]
    for got, p in zip(cuts, (0.2, 0.4, 0.6, 0.8)):
        assert abs(got - p * 10_000) <= 0.05 * 10_000 + 1


def test_payload_columns_and_sampled_bounds(spark):
    """Enough rows that range bounds come from a sample, plus payload columns the
    statistics branch does not need: both branches must still agree."""
    df = spark.range(120_000).select(
        F.col("id").alias("k"),
        (F.col("id") * 7919 % 1000).cast("double").alias("v"),
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("payload"),
    )
    got = global_rank(df, "v", ["k"], n_partitions=32)
    want = window_rank(df, "v", ["k"])
    cols = ["k", "row_number", "rank", "percent_rank", "payload"]
    diff = got.select(*cols).exceptAll(want.select(*cols)).count()
    assert diff == 0
    assert got.count() == 120_000


def test_without_exchange_reuse_still_correct(spark):
    rows = [(i, float(i % 5), str(i)) for i in range(5000)]
    df = spark.createDataFrame(rows, "k long, v double, payload string")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = sorted(tuple(r) for r in global_rank(df, "v", ["k"], n_partitions=6)
                     .select("k", "row_number", "rank", "percent_rank").collect())
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    want = sorted(tuple(r) for r in window_rank(df, "v", ["k"])
                  .select("k", "row_number", "rank", "percent_rank").collect())
    assert got == want


@pytest.mark.parametrize("n_parts", [1, 5, 16])
def test_global_row_number_matches_window(spark, n_parts):
    from laminar.operators.ranking import global_row_number

    rnd = random.Random(n_parts)
    rows = [(i, float(rnd.randrange(7)), f"p{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v double, payload string")
    order = [F.col("v").desc(), F.col("k").asc()]
    got = global_row_number(df, order, n_partitions=n_parts, count_col="n")
    want = window_rank(df, "v", ["k"], rank_col=None, percent_rank_col=None)
    g = sorted((r.k, r.row_number, r.n, r.payload) for r in got.collect())
    w = sorted((r.k, r.row_number, 3000, r.payload) for r in want.collect())
    assert g == w


def test_exact_cuts_many_match_single(spark):
    from laminar.operators.quantiles import exact_cuts_many

    rnd = random.Random(5)
    rows = [(i, float(rnd.randrange(40)), None if i % 7 == 0 else float(rnd.randrange(9))) for i in range(333)]
    df = spark.createDataFrame(rows, "k long, a double, b double")
    many = exact_cuts_many(df, ["a", "b"], ["k"], n_partitions=6).collect()[0].asDict()
    one_a = exact_cuts(df, "a", ["k"], n_partitions=3).collect()[0].asDict()
    one_b = exact_cuts(df, "b", ["k"], n_partitions=4).collect()[0].asDict()
    assert many == {**one_a, **one_b}


def test_one_exchange_of_the_ranked_rows(spark):
    """The window takes over the dealing's partitioning; the rows move once."""
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit("x").alias("payload"))
    out = global_rank(df, "v", ["k"], n_partitions=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    moved = [i for i, ln in enumerate(plan.splitlines()) if "Exchange" in ln and "Broadcast" not in ln]
    lines = plan.splitlines()
    rows_moved = [lines[i] for i in moved if "__cnt" not in lines[i + 1] and "count" not in lines[i + 1] and "__rank" not in lines[i + 1] and "__border" not in lines[i + 1]]
    assert len(rows_moved) == 1, plan


def test_ranks_are_long(spark):
    out = global_rank(spark.createDataFrame([(1, 5.0)], "k long, v double"), "v", ["k"])
    assert [t for _, t in out.select("row_number", "rank").dtypes] == ["bigint", "bigint"]


def test_buckets_follow_the_rows_not_the_setting(spark):
    from laminar.operators import ranking

    assert ranking.buckets_for(2000) == 1 and ranking.buckets_for(0) == 1
    assert ranking.buckets_for(10 * ranking.ROWS_PER_BUCKET) == 10
    assert ranking.buckets_for(10**12) == ranking.MAX_BUCKETS
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        df = spark.range(2000).groupBy(F.col("id").alias("k")).agg(F.max(F.col("id") % 9).alias("v"))
        got = global_rank(df, "v", ["k"])
        assert got.rdd.getNumPartitions() <= 10
        assert got.agg(F.max("row_number")).first()[0] == 2000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_two_tie_breakers_with_nulls_and_descending_dates(spark):
    rnd = random.Random(11)
    rows = [(i // 3 if i % 5 else None, i, None if i % 17 == 0 else rnd.randrange(4)) for i in range(700)]
    df = spark.createDataFrame(rows, "k long, k2 long, n int").withColumn("v", F.date_add(F.lit("2020-01-01").cast("date"), F.col("n")))
    for desc in (True, False):
        got = global_rank(df, "v", ["k", "k2"], descending=desc, n_partitions=9)
        want = window_rank(df, "v", ["k", "k2"], descending=desc)
        cols = ["k", "k2", "row_number", "rank"]
        assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
