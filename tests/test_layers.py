"""Sinks, lineage, catalog and the incremental loader."""

import datetime as dt

from pyspark.sql import functions as F

from laminar.plans.layers import LayerConfig, clean_to_silver, run_layers
from laminar.sources import layers, testdata
from laminar.streaming.incremental import load_increment

SF = "/root/testdata/sf0.001"


def test_gold_overwrite_keeps_other_days(spark, tmp_path):
    root = str(tmp_path / "gold")
    df = spark.createDataFrame([(1, "x")], "k long, v string")
    layers.write_gold(df, root, "ds", run_date=dt.date(2024, 1, 1))
    layers.write_gold(df, root, "ds", run_date=dt.date(2024, 1, 2))
    res = layers.write_gold(df.union(df), root, "ds", run_date=dt.date(2024, 1, 2))  # retry
    assert res["record_count"] == 2
    got = spark.read.parquet(f"{root}/ds").groupBy("day").count().orderBy("day").collect()
    assert [(r.day, r["count"]) for r in got] == [(1, 1), (2, 2)]


def test_gold_keeps_own_year_month(spark, tmp_path):
    df = spark.createDataFrame([("2001-03", 2001, 3, "x")], "year_month string, year int, month int, dataset_name string")
    out = layers.add_gold_metadata(df, "monthly_metrics", run_date=dt.date(2024, 5, 6)).collect()[0]
    assert (out.year, out.month, out.load_year, out.load_month, out.load_day) == (2001, 3, 2024, 5, 6)
    assert (out.dataset_name, out.gold_dataset) == ("x", "monthly_metrics")


def test_lineage_and_catalog(spark, tmp_path):
    root = str(tmp_path)
    bronze = testdata.dirty_bronze_orders(spark, SF)
    rep = clean_to_silver(bronze, f"{root}/silver", "bronze_orders", "job", f"{root}/lineage",
                          run_date=dt.date(2024, 1, 1))
    lin = spark.read.parquet(f"{root}/lineage").collect()[0]
    assert (lin.source_table, lin.target_table, lin.record_count) == (
        "bronze_orders", "silver_orders", rep["output_rows"])
    tbl = layers.register_table(spark, "t_silver_orders", f"{root}/silver/silver_orders")
    assert tbl.count() == rep["output_rows"]
    assert spark.sql("SELECT count(*) FROM t_silver_orders WHERE year = 2024").collect()[0][0] == rep["output_rows"]


def test_incremental_runs_and_replay(spark, tmp_path):
    root = str(tmp_path)
    ev = testdata.table(spark, SF, "events")
    halves = [ev.where("event_id % 2 = 0"), ev.where("event_id % 2 = 1")]
    seen = []
    for drop in halves + [None]:
        if drop is not None:
            drop.write.mode("append").parquet(f"{root}/landing")
        load_increment(spark, f"{root}/landing", ev.schema, f"{root}/silver", f"{root}/ck",
                       run_date=dt.date(2024, 1, 1))
        seen.append(spark.read.parquet(f"{root}/silver").count())
    n = ev.count()
    assert seen == [halves[0].count(), n, n]
    # a replayed batch overwrites its own folder instead of appending again
    batch = spark.read.parquet(f"{root}/silver").where("batch_id = 0").drop("batch_id")
    layers.write_layer(batch, f"{root}/silver/batch_id=0", mode="overwrite")
    assert spark.read.parquet(f"{root}/silver").count() == n


def test_run_layers_end_to_end(spark, tmp_path):
    root = str(tmp_path)
    # silver inputs for the gold job, as the cleaning job would have written them
    bronze_dir = f"{root}/bronze"
    testdata.transactions(spark, SF).write.parquet(f"{bronze_dir}/bronze_transactions")
    testdata.customers(spark, SF).write.parquet(f"{bronze_dir}/bronze_customers")
    cfg = LayerConfig(
        bronze_tables={
            "bronze_transactions": f"{bronze_dir}/bronze_transactions",
            "bronze_customers": f"{bronze_dir}/bronze_customers",
        },
        silver_root=f"{root}/silver",
        gold_root=f"{root}/gold",
        transactions_table="silver_transactions",
        customers_table="silver_customers",
        lineage_path=f"{root}/lineage",
        as_of="2001-08-02",
        run_date=dt.date(2024, 1, 1),
    )
    out = run_layers(spark, cfg)
    assert set(out["gold"]) == {
        "customer_analytics", "product_analytics", "daily_metrics", "monthly_metrics",
        "cohort_analysis", "rfm_customer_segments"}
    summary = spark.read.parquet(f"{root}/gold/job_summary")
    got = {r.dataset_name: r.record_count for r in summary.collect()}
    assert got == out["gold"]
    assert spark.read.parquet(f"{root}/lineage").count() == 2


def test_jobs_cli(spark, tmp_path):
    from laminar import jobs

    root = str(tmp_path)
    testdata.transactions(spark, SF).write.parquet(f"{root}/bronze/bronze_transactions")
    testdata.dirty_bronze_orders(spark, SF).write.parquet(f"{root}/bronze/bronze_orders")
    assert jobs.list_tables(spark, f"{root}/bronze") == ["bronze_orders", "bronze_transactions"]
    jobs.main(["bronze-to-silver", "--bronze-root", f"{root}/bronze", "--silver-root",
               f"{root}/silver", "--lineage-path", f"{root}/lineage", "--run-date", "2024-01-01"])
    assert spark.read.parquet(f"{root}/lineage").count() == 2
    jobs.main(["silver-to-gold", "--silver-root", f"{root}/silver", "--gold-root", f"{root}/gold",
               "--transactions", "silver_transactions", "--run-date", "2024-01-01",
               "--as-of", "2001-08-02", "--gate"])
    got = {r.dataset_name: r.record_count for r in spark.read.parquet(f"{root}/gold/job_summary").collect()}
    assert len(got) == 6 and all(v > 0 for v in got.values())


def test_job_summary_counts_this_run_only(spark, tmp_path):
    from laminar.plans.layers import build_gold

    root = str(tmp_path / "gold")
    tx = testdata.transactions(spark, SF)
    first = build_gold(tx, root, run_date=dt.date(2024, 1, 1), as_of="2001-08-02")
    second = build_gold(tx, root, run_date=dt.date(2024, 1, 2), as_of="2001-08-02")
    assert first == second
    summary = spark.read.parquet(f"{root}/job_summary").where("day = 2")
    assert {r.dataset_name: r.record_count for r in summary.collect()} == second


def test_cleaning_rerun_is_idempotent(spark, tmp_path):
    root = str(tmp_path)
    bronze = testdata.dirty_bronze_orders(spark, SF)
    a = clean_to_silver(bronze, f"{root}/silver", "bronze_orders", "job", run_date=dt.date(2024, 1, 1))
    clean_to_silver(bronze, f"{root}/silver", "bronze_orders", "job", run_date=dt.date(2024, 1, 1))
    assert spark.read.parquet(f"{root}/silver/silver_orders").count() == a["output_rows"]


def test_failed_batch_is_processed_again(spark, tmp_path):
    import pytest

    root = str(tmp_path)
    ev = testdata.table(spark, SF, "events")
    ev.write.parquet(f"{root}/landing")

    def broken(df):
        raise RuntimeError("writer failed")

    with pytest.raises(Exception):
        load_increment(spark, f"{root}/landing", ev.schema, f"{root}/silver", f"{root}/ck",
                       transform=broken)
    reports = load_increment(spark, f"{root}/landing", ev.schema, f"{root}/silver", f"{root}/ck")
    assert sum(r["output_rows"] for r in reports) == ev.count()
    assert spark.read.parquet(f"{root}/silver").count() == ev.count()


def test_read_with_merged_schema(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(f"{root}/day=1")
    spark.createDataFrame([(2, "b", 3.0)], "id long, v string, extra double").write.parquet(f"{root}/day=2")
    df = layers.read_table(spark, root, merge_schema=True)
    assert set(df.columns) == {"id", "v", "extra", "day"}
    assert df.where("extra IS NULL").count() == 1


def test_names_and_role_binding():
    from laminar.plans.layers import bind_roles, silver_name

    assert silver_name("bronze_orders") == "silver_orders"
    assert silver_name("raw_bronze_orders") == "silver_raw_orders"
    assert bind_roles(["silver_customers", "silver_transactions", "silver_products"]) == {
        "customers": "silver_customers", "transactions": "silver_transactions",
        "products": "silver_products"}
    assert bind_roles(["silver_customer_transactions"]) == {"customers": "silver_customer_transactions"}


def test_incremental_inferred_schema_batches_and_archive(spark, tmp_path):
    import os

    root = str(tmp_path)
    ev = testdata.table(spark, SF, "events")
    ev.repartition(4).write.parquet(f"{root}/landing")
    reports = load_increment(spark, f"{root}/landing", None, f"{root}/silver", f"{root}/ck",
                             max_files_per_trigger=1, archive_dir=f"{root}/archive")
    assert len(reports) >= 4
    assert spark.read.parquet(f"{root}/silver").count() == ev.count()
    again = load_increment(spark, f"{root}/landing", ev.schema, f"{root}/silver", f"{root}/ck")
    assert again == [] and spark.read.parquet(f"{root}/silver").count() == ev.count()
    assert os.path.isdir(f"{root}/archive")


def test_jobs_incremental(spark, tmp_path):
    from laminar import jobs

    root = str(tmp_path)
    ev = testdata.table(spark, SF, "events")
    ev.write.parquet(f"{root}/landing")
    args = ["incremental", "--source", f"{root}/landing", "--silver-dir", f"{root}/silver",
            "--checkpoint", f"{root}/ck"]
    jobs.main(args)
    jobs.main(args)  # nothing new
    assert spark.read.parquet(f"{root}/silver").count() == ev.count()


def test_concurrent_lineage_writes(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "lineage")

    def one(i):
        layers.append_lineage(layers.lineage_record(spark, "job", f"t{i}", f"s{i}", i, 0.1), path)

    with ThreadPoolExecutor(max_workers=6) as pool:
        list(pool.map(one, range(12)))
    got = sorted(r.record_count for r in spark.read.parquet(path).collect())
    assert got == list(range(12))


def test_gold_values_through_the_whole_flow(spark, tmp_path):
    """Gold built from cleaned silver tables (amounts now doubles) agrees with the
    oracle to 6 decimals."""
    from laminar import checks, registry
    from laminar.plans.layers import LayerConfig, run_layers

    root = str(tmp_path)
    for name, df in {
        "bronze_transactions": testdata.transactions(spark, SF),
        "bronze_customers": testdata.customers(spark, SF),
        "bronze_products": testdata.products(spark, SF),
    }.items():
        df.write.parquet(f"{root}/bronze/{name}")
    run_layers(spark, LayerConfig(
        bronze_tables={n: f"{root}/bronze/{n}" for n in
                       ("bronze_transactions", "bronze_customers", "bronze_products")},
        silver_root=f"{root}/silver", gold_root=f"{root}/gold",
        transactions_table="silver_transactions", customers_table="silver_customers",
        products_table="silver_products", as_of=registry.AS_OF, run_date=registry.RUN_DATE))
    import decimal

    import pandas as pd

    con = checks.duckdb_connection(SF)
    keys = {
        "customer_analytics": ["customer_id"],
        "product_analytics": ["product_id"],
        "daily_metrics": ["transaction_date"],
        "monthly_metrics": ["year_month"],
        "cohort_analysis": ["cohort_month", "months_since_first_purchase"],
    }
    for name, key in keys.items():
        want = con.execute(registry.ORACLE[name]).df()
        got = spark.read.parquet(f"{root}/gold/{name}").select(*want.columns).toPandas()
        want = want.sort_values(key).reset_index(drop=True)
        got = got.sort_values(key).reset_index(drop=True)
        for c in want.columns:  # align value types (decimals, dates) before comparing
            for frame in (want, got):
                if frame[c].dtype == object:
                    frame[c] = [float(v) if isinstance(v, decimal.Decimal) else
                                (str(v) if v is not None else None) for v in frame[c]]
            if want[c].dtype != got[c].dtype and "datetime" in str(want[c].dtype) + str(got[c].dtype):
                want[c], got[c] = want[c].astype(str), got[c].astype(str)
        pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-9)


def test_shuffle_partitions_sized_from_input(spark, tmp_path):
    from laminar.session import input_bytes, size_shuffle_partitions

    path = str(tmp_path / "t")
    testdata.transactions(spark, SF).write.parquet(path)
    n_bytes = input_bytes(spark, [path])
    assert n_bytes > 0
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert size_shuffle_partitions(spark, n_bytes) == before  # small input: unchanged
        assert size_shuffle_partitions(spark, n_bytes, target_bytes=max(1, n_bytes // 50)) >= 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))


def test_write_gold_empty_dataset(spark, tmp_path):
    empty = spark.createDataFrame([], "k long, v string")
    res = layers.write_gold(empty, str(tmp_path / "gold"), "ds", run_date=dt.date(2024, 1, 1))
    assert res["record_count"] == 0


def test_scheduler_pool_is_restored(spark):
    from laminar.plans.layers import scheduler_pool

    sc = spark.sparkContext
    before = sc.getLocalProperty("spark.scheduler.pool")
    with scheduler_pool(spark, "p1"):
        assert sc.getLocalProperty("spark.scheduler.pool") == "p1"
    assert sc.getLocalProperty("spark.scheduler.pool") == before


def test_gold_job_needs_transactions(spark, tmp_path):
    import pytest

    from laminar import jobs

    root = str(tmp_path)
    testdata.customers(spark, SF).write.parquet(f"{root}/silver/silver_customers")
    with pytest.raises(ValueError, match="no transaction data"):
        jobs.main(["silver-to-gold", "--silver-root", f"{root}/silver", "--gold-root",
                   f"{root}/gold", "--auto-bind"])


def test_two_run_dates_leave_one_copy(spark, tmp_path):
    root = str(tmp_path)
    bronze = testdata.dirty_bronze_orders(spark, SF)
    for day in (1, 2):
        got = clean_to_silver(bronze, f"{root}/silver", "bronze_orders", "job", run_date=dt.date(2024, 1, day))
        silver = spark.read.parquet(f"{root}/silver/silver_orders")
        assert silver.count() == got["output_rows"]
        assert [r.day for r in silver.select("day").distinct().collect()] == [day]
    import os

    assert os.listdir(f"{root}/silver") == ["silver_orders"]  # nothing staged is left


def test_failed_gate_keeps_the_good_table(spark, tmp_path):
    import pytest

    from laminar.plans.layers import clean_and_gate, key_rules

    root = str(tmp_path)
    good = spark.createDataFrame([(1, "a"), (2, "b")], "transaction_id long, v string")
    rules = key_rules("transaction_id")
    clean_and_gate(good, root, "bronze_tx", "job", run_date=dt.date(2024, 1, 1), rules=rules)
    bad = [good.withColumn("transaction_id", F.lit(None).cast("long")), good.drop("transaction_id"), good.limit(0)]
    for frame in bad:
        with pytest.raises(Exception):
            clean_and_gate(frame, root, "bronze_tx", "job", run_date=dt.date(2024, 1, 2), rules=rules)
        assert spark.read.parquet(f"{root}/silver_tx").count() == 2


def test_observed_count_raises_what_is_not_an_empty_input(spark):
    import pytest
    from pyspark.sql import Observation

    with pytest.raises(Exception):
        layers.observed_count(Observation("never_observed"))
    obs = Observation("no_partitions")
    spark.range(0).where("id < 0").limit(0).observe(obs, F.count(F.lit(1)).alias("rows")).collect()
    assert layers.observed_count(obs) == 0


def test_sized_shuffles_are_bounded_and_set_back(spark):
    from laminar.session import MAX_SHUFFLE_PARTITIONS, default_partitions, sized_shuffles

    before = default_partitions(spark)
    with sized_shuffles(spark, 100 * 10**12):
        assert default_partitions(spark) == MAX_SHUFFLE_PARTITIONS
    assert default_partitions(spark) == before


def test_register_table_leaves_a_table_elsewhere_alone(spark, tmp_path):
    import pytest

    for name in ("a", "b"):
        spark.range(3).withColumn("day", F.lit(1)).write.partitionBy("day").parquet(f"{tmp_path}/{name}")
    assert layers.register_table(spark, "t_place", f"{tmp_path}/a").count() == 3
    spark.range(2).write.parquet(f"{tmp_path}/a/day=2")
    assert layers.register_table(spark, "t_place", f"{tmp_path}/a").count() == 5
    with pytest.raises(ValueError):
        layers.register_table(spark, "t_place", f"{tmp_path}/b")
    assert spark.table("t_place").count() == 5
