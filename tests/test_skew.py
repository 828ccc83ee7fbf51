"""Hot-key splitting for lookup joins."""

from pyspark.sql import functions as F

from laminar.operators.skew import hot_keys, split_hot_key_join


def _frames(spark, n=60_000):
    big = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 2000).alias("k"),
        F.col("id").alias("t"),
    )
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"))
    return big, small


def test_hot_key_detected_and_bounded(spark):
    big, small = _frames(spark)
    hot = {r["k"]: r["__salts"] for r in hot_keys(small, "k", "n", max_hot_keys=100, min_split_rows=10).collect()}
    assert 7 in hot and hot[7] > 1
    assert len(hot) <= 100


def test_split_join_equals_plain_join(spark):
    big, small = _frames(spark)
    got = split_hot_key_join(big, small, "k", "n", F.col("t"), max_hot_keys=50, min_split_rows=10)
    want = big.join(small, "k")
    cols = ["k", "t", "n", "first_t"]
    assert got.count() == want.count() == 60_000
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0


def test_hot_key_spread_over_tasks(spark):
    big, small = _frames(spark)
    joined = split_hot_key_join(big, small, "k", "n", F.col("t"), max_hot_keys=100, min_split_rows=10)
    tagged = joined.withColumn("p", F.spark_partition_id())  # task of the join output
    # measure the shuffled join, as on large inputs (no whole-side broadcast)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per_task = tagged.where("k = 7").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(per_task) > 1
    assert max(r["count"] for r in per_task) < 20_000  # the key holds 20,000 rows
