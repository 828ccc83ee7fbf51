"""What a flow leaves on disk while it runs."""

import datetime as dt
import os

from pyspark.sql import functions as F

from laminar import session
from laminar.plans import layers as plans
from laminar.plans.layers import LayerConfig, build_gold, run_layers
from laminar.sources import layers

DAY = dt.date(2024, 5, 1)
COLUMNS = "transaction_id string, customer_id long, product_id long, quantity decimal(12,2), amount decimal(12,2), transaction_date timestamp_ntz"


def transactions(spark):
    rows = spark.range(2_000).selectExpr(
        "concat('t', id) AS transaction_id", "id % 50 AS customer_id", "id % 30 AS product_id",
        "cast(1 AS decimal(12,2)) AS quantity", "cast(id % 97 AS decimal(12,2)) AS amount",
        "cast(timestamp_seconds(1700000000 + id * 5000) AS timestamp_ntz) AS transaction_date",
    )
    null = spark.createDataFrame([(None, None, None, None, None, None)], COLUMNS)
    return rows.unionByName(null)


def shuffle_files(spark) -> set:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for top in manager.localDirsString() for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def test_a_job_leaves_no_shuffle_files(spark, tmp_path):
    kept = shuffle_files(spark)
    counts = spark.range(1_000).selectExpr("id % 7 AS k").groupBy("k").count()
    with session.shuffles_removed(spark):
        counts.write.parquet(str(tmp_path / "out"))
    assert spark.conf.get(session.SHUFFLE_CLEANUP, "false") == "false"
    assert shuffle_files(spark) <= kept
    assert counts.count() == 7 and spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_run_layers_leaves_no_shuffle_files(spark, tmp_path):
    transactions(spark).write.parquet(str(tmp_path / "bronze"))
    kept = shuffle_files(spark)
    run_layers(
        spark,
        LayerConfig(
            bronze_tables={"bronze_transactions": str(tmp_path / "bronze")},
            silver_root=str(tmp_path / "silver"), gold_root=str(tmp_path / "gold"),
            transactions_table="silver_transactions", run_date=DAY, as_of=DAY, relative_error=0.0,
            gate_gold=False,
        ),
    )
    assert len(shuffle_files(spark) - kept) <= 2


def test_pairs_go_when_gold_is_written(spark, tmp_path, monkeypatch):
    made, real = [], session.fresh_dir
    monkeypatch.setattr(session, "fresh_dir", lambda *a: made.append(real(*a)) or made[-1])
    read = []
    write = layers.write_gold

    def seen(*args, **kwargs):
        read.extend(p for p in made if "pairs" in p and os.path.exists(p.removeprefix("file:")))
        return write(*args, **kwargs)

    monkeypatch.setattr(plans.layers, "write_gold", seen)
    counts = build_gold(transactions(spark), str(tmp_path / "gold"), as_of=DAY, run_date=DAY)
    assert counts["customer_analytics"] == 51 and counts["product_analytics"] == 31
    assert read and not any(os.path.exists(p.removeprefix("file:")) for p in made)


def test_rounds_of_the_neighbour_search_leave_no_shuffle_files(spark):
    from laminar.llm import neighbours

    vec = F.array(*[F.sin(F.col("id") * k + k) for k in range(1, 9)])
    rows = spark.range(60).select("id", vec.alias("vec"))
    kept = shuffle_files(spark)
    found = neighbours.nearest(rows, F.col("id") % 20 == 0, 5).collect()
    assert len(found) == 15 and len(shuffle_files(spark) - kept) <= 2
