"""Run with task failures injected on first attempts; print RETRY-OK when results
equal the failure-free run. Started in its own process by test_retries.py (it needs
a local master that retries tasks: local[4, 4])."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from laminar.operators.ranking import global_rank  # noqa: E402
from laminar.plans import cohort  # noqa: E402
from laminar.session import build_session  # noqa: E402
from laminar.sources import testdata  # noqa: E402


def main(sf_dir: str) -> None:
    spark = build_session("local[4, 4]", shuffle_partitions=8,
                          extra_conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    @F.udf(T.LongType())
    def flaky(v):
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        return v

    tx = testdata.transactions(spark, sf_dir)
    flaky_tx = tx.withColumn("customer_id", flaky(F.col("customer_id")))
    clean = sorted(tuple(r) for r in cohort.cohort_analysis(tx).collect())
    retried = sorted(tuple(r) for r in cohort.cohort_analysis(flaky_tx).collect())

    df = spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") % 97).alias("v"))
    want = sorted(tuple(r) for r in global_rank(df, "v", ["k"], n_partitions=8).collect())
    flaky_df = df.withColumn("v", flaky(F.col("v")))
    got = sorted(tuple(r) for r in global_rank(flaky_df, "v", ["k"], n_partitions=8).collect())
    print("RETRY-OK" if clean == retried and got == want and len(got) == 50_000 else "RETRY-MISMATCH")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
