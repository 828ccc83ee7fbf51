"""Physical-plan properties the scale design relies on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from laminar.plans import cohort, customer, rfm, timeseries
from laminar.plans.layers import run_partition
from laminar.sources import testdata

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver_tx(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tx") / "silver_transactions")
    testdata.transactions(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_scan_reads_only_used_columns(silver_tx):
    plan = _plan(customer.customer_summary(silver_tx))
    schema = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "product_id" not in schema and "quantity" not in schema
    assert "customer_id" in schema and "amount" in schema


def test_null_customers_filtered_at_the_scan(silver_tx):
    plan = _plan(cohort.cohort_analysis(silver_tx))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert scans and all("IsNotNull(customer_id)" in ln for ln in scans)


def test_no_expand_for_distinct_counts(silver_tx):
    for df in (timeseries.daily_metrics(silver_tx), timeseries.monthly_metrics(silver_tx)):
        assert "Expand" not in _plan(df)


def _scans(df) -> int:
    return _plan(df).split("Initial Plan")[0].count("FileScan parquet")


def test_transactions_are_scanned_once(silver_tx):
    base = customer.customer_base(silver_tx).checkpoint()
    pairs = timeseries.daily_pairs(silver_tx)
    assert _scans(pairs) == 1
    assert _scans(timeseries.daily_metrics(silver_tx)) == 1
    assert _scans(timeseries.monthly_metrics(silver_tx)) == 1
    assert _scans(cohort.cohort_analysis(silver_tx)) == 1  # after the pinned small side
    assert _scans(cohort.cohort_analysis(silver_tx, customers_base=base)) == 1
    pinned = pairs.checkpoint()
    for build in (timeseries.daily_metrics, timeseries.monthly_metrics):
        assert _scans(build(silver_tx, pairs=pinned)) == 0


def test_shared_aggregates_give_the_same_datasets(silver_tx):
    t = silver_tx.selectExpr(
        "transaction_id", "amount", "product_id",
        "if(crc32(transaction_id) % 7 = 0, null, customer_id) as customer_id",
        "if(crc32(transaction_id) % 11 = 0, null, transaction_date) as transaction_date",
    )
    base, pairs = customer.customer_base(t), timeseries.daily_pairs(t)
    for a, b in (
        (timeseries.monthly_metrics(t), timeseries.monthly_metrics(t, pairs=pairs)),
        (timeseries.daily_metrics(t), timeseries.daily_metrics(t, pairs=pairs)),
        (cohort.cohort_analysis(t), cohort.cohort_analysis(t, customers_base=base)),
    ):
        rows = [sorted(map(str, x.collect())) for x in (a, b)]
        assert rows[0] and rows[0] == rows[1]


def test_rfm_cuts_one_subquery(silver_tx):
    df = rfm.rfm_segments(silver_tx)
    df.collect()
    final = _plan(df).split("Initial Plan")[0]
    assert final.count("ReusedSubquery") >= 11  # twelve cut references, one subquery


def test_run_partition_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "silver")
    df = spark.createDataFrame([(1, 2024, 1, d) for d in (1, 2, 3)], "id long, year int, month int, day int")
    df.write.partitionBy("year", "month", "day").parquet(path)
    t = spark.read.parquet(path)
    plan = _plan(t.where(run_partition(t, dt.date(2024, 1, 2))))
    assert "PartitionFilters: [isnotnull(year" in plan and "(day#" in plan
    assert t.where(run_partition(t, dt.date(2024, 1, 2))).count() == 1


def test_months_need_no_second_shuffle_of_the_pairs(silver_tx):
    pairs = timeseries.daily_pairs(silver_tx)
    assert pairs.where("__side > 0 and (__sum is not null or __count > 0)").count() == 0
    months = pairs.where("__side = 2").groupBy("__month", "product_id").count()
    assert months.where("count > 1").count() == 0  # ids travel once per month
    plan = _plan(timeseries.monthly_metrics(silver_tx, pairs=pairs.checkpoint()))
    exchanged = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert exchanged and not any("product_id" in ln for ln in exchanged)


def test_pairs_with_nulls_count_as_plain_groups_do(spark):
    day = dt.datetime(2024, 2, 29, 5)
    rows = [
        ("a", 1, 1, 1.5, day), ("a", 1, 1, 1.5, day), (None, None, 1, None, day), ("b", 2, None, 2.0, None),
        ("c", 2, 3, 4.0, dt.datetime(2024, 2, 1)), ("d", 1, 1, 8.0, dt.datetime(2024, 3, 31)),
        (None, 1, 3, None, dt.datetime(2023, 12, 31)), ("e", 7, 9, 1.0, dt.datetime(1969, 12, 31, 23)),
    ]
    tx = spark.createDataFrame(
        rows, "transaction_id string, customer_id long, product_id long, amount double, transaction_date timestamp_ntz"
    )
    for made, prefix, key in (
        (timeseries.daily_metrics(tx), "daily", "to_date(transaction_date)"),
        (timeseries.monthly_metrics(tx), "monthly", "date_format(transaction_date, 'yyyy-MM')"),
    ):
        plain = tx.groupBy(F.expr(key).alias("k")).agg(
            F.count("transaction_id"), F.sum("amount"), F.count_distinct("customer_id"), F.count_distinct("product_id")
        )
        got = made.select(
            made.columns[0], f"{prefix}_transaction_count", f"{prefix}_revenue",
            f"{prefix}_unique_customers", f"{prefix}_unique_products",
        )
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, plain.collect())))
