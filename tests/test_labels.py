"""E1-E13 threshold boundaries and score chains on literal frames."""

from pyspark.sql import functions as F

from laminar.functions import (
    churn_risk,
    growth_pct,
    higher_is_better_score,
    lifetime_value,
    performance_category,
    recency_score,
    retention_rate,
    rfm_code,
    rfm_segment,
    spend_tier,
    transaction_frequency,
)


def _one(spark, expr, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_spend_tier_boundaries(spark):
    got = _one(spark, spend_tier(F.col("x")), "x double",
               [(10000.0,), (9999.99,), (5000.0,), (1000.0,), (999.0,), (None,)])
    assert got == ["Premium", "Gold", "Gold", "Silver", "Bronze", "Bronze"]


def test_frequency_boundaries(spark):
    got = _one(spark, transaction_frequency(F.col("x")), "x long", [(50,), (49,), (20,), (19,)])
    assert got == ["High", "Medium", "Medium", "Low"]


def test_churn_is_strict_and_null_is_low(spark):
    got = _one(spark, churn_risk(F.col("x")), "x int", [(91,), (90,), (31,), (30,), (None,)])
    assert got == ["High", "Medium", "Medium", "Low", "Low"]


def test_performance_boundaries(spark):
    got = _one(spark, performance_category(F.col("x")), "x double",
               [(80.0,), (79.9,), (60.0,), (40.0,), (20.0,), (19.9,)])
    assert got == ["Top Performer", "Good Performer", "Good Performer",
                   "Average Performer", "Below Average", "Poor Performer"]


def test_lifetime_value(spark):
    df = spark.createDataFrame(
        [(100.0, "Premium"), (100.0, "Gold"), (100.0, "Silver"), (100.0, "Bronze"), (0.0, None)],
        "t double, s string",
    )
    got = [r[0] for r in df.select(lifetime_value(F.col("t"), F.col("s"))).collect()]
    assert got == [150.0, 130.0, 110.00000000000001, 100.0, 0.0]


def test_growth_pct(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, None), (5.0, 0.0)], "c double, p double")
    got = [r[0] for r in df.select(growth_pct(F.col("c"), F.col("p"))).collect()]
    assert got[0] == (110.0 - 100.0) / 100.0 * 100
    assert got[1] == 0.0
    assert got[2] is None  # zero previous month: null, not a division error


def test_retention_rate_half_up(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (3, 3)], "c long, n long")
    got = [str(r[0]) for r in df.select(retention_rate(F.col("c"), F.col("n"))).collect()]
    assert got == ["33.33", "66.67", "100.00"]


def test_scores_and_segments(spark):
    cuts = [F.lit(v) for v in (10.0, 20.0, 30.0, 40.0)]
    df = spark.createDataFrame([(v,) for v in (5, 10, 15, 20, 25, 30, 35, 40, 45, None)], "v int")
    hi = [r[0] for r in df.select(higher_is_better_score(F.col("v"), cuts)).collect()]
    assert hi == [1, 2, 2, 3, 3, 4, 4, 5, 5, 1]
    std = [r[0] for r in df.select(recency_score(F.col("v"), cuts)).collect()]
    assert std == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]
    written = [r[0] for r in df.select(recency_score(F.col("v"), cuts, "as_written")).collect()]
    assert written == [1, 1, 3, 3, 4, 4, 5, 5, 5, 5]
    assert 2 not in written  # the published chain never reaches 2


def test_rfm_segment_order(spark):
    rows = [(5, 5, 5), (3, 3, 3), (5, 1, 1), (1, 3, 3), (1, 1, 3), (1, 1, 1), (3, 1, 1)]
    df = spark.createDataFrame(rows, "r int, f int, m int")
    got = [tuple(x) for x in df.select(
        rfm_code(F.col("r"), F.col("f"), F.col("m")),
        rfm_segment(F.col("r"), F.col("f"), F.col("m")),
    ).collect()]
    assert got == [
        ("555", "Champions"), ("333", "Loyal Customers"), ("511", "New Customers"),
        ("133", "At Risk"), ("113", "Cannot Lose Them"), ("111", "Lost Customers"),
        ("311", "Others"),
    ]
