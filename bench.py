"""Benchmark: the layered jobs on the test tables.

Silver transactions are written once (lineitem x orders, as the silver layer would
hold them); each gold dataset and the cleaning / quality jobs are then timed with a
``noop`` sink, which runs the whole plan without output cost. Median of
``BENCH_REPEAT`` runs after one warm-up. Prints one JSON line; ``spark_jobs`` counts
the Spark jobs of one run per step (a hardware-free measure; with AQE every shuffle
stage and broadcast is its own job).

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from laminar.operators import cleaning, quality  # noqa: E402
from laminar.plans import cohort, customer, product, rfm, timeseries  # noqa: E402
from laminar.plans.layers import LayerConfig, build_gold, clean_to_silver, run_layers  # noqa: E402
from laminar.session import build_session, fresh_dir  # noqa: E402
from laminar.sources import testdata  # noqa: E402

AS_OF = "2001-08-02"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def count_jobs(spark, name: str, fn) -> int:
    """Spark jobs one run of ``fn`` starts (hardware-free cost measure)."""
    sc = spark.sparkContext
    group = f"bench-{name}"
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def timed(fn, repeat: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="laminar-bench",
        shuffle_partitions=2 * cpus,
        extra_conf={
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    root = fresh_dir(spark, "bench")
    t0 = time.perf_counter()
    testdata.transactions(spark, sf_dir).write.parquet(f"{root}/silver_transactions")
    build_silver = time.perf_counter() - t0

    tx = spark.read.parquet(f"{root}/silver_transactions")
    customers = testdata.customers(spark, sf_dir)
    products = testdata.products(spark, sf_dir)
    bronze = testdata.dirty_bronze_orders(spark, sf_dir)

    jobs = {
        "customer_analytics": lambda: run(customer.customer_analytics(customers, tx, as_of=AS_OF)),
        "product_analytics": lambda: run(product.product_analytics(products, tx)),
        "daily_metrics": lambda: run(timeseries.daily_metrics(tx)),
        "monthly_metrics": lambda: run(timeseries.monthly_metrics(tx)),
        "cohort_analysis": lambda: run(cohort.cohort_analysis(tx)),
        "rfm_customer_segments": lambda: run(rfm.rfm_segments(tx)),
        "rfm_customer_segments_exact": lambda: run(rfm.rfm_segments(tx, relative_error=0.0)),
        "clean_bronze": lambda: run(cleaning.clean_for_silver(bronze)),
        "dq_ruleset": lambda: run(quality.evaluate_ruleset(bronze)),
        "clean_to_silver_write": lambda: clean_to_silver(
            bronze, fresh_dir(spark, "bench-silver"), "bronze_orders", "bench"
        ),
        # all six gold datasets and the summary written, three concurrent jobs
        "build_gold_written": lambda: build_gold(
            tx, fresh_dir(spark, "bench-gold"), customers, products, as_of=AS_OF
        ),
    }
    results = {"build_silver_transactions": round(build_silver, 3)}
    job_counts = {}
    for name, fn in jobs.items():
        results[name] = round(timed(fn, repeat), 3)
        job_counts[name] = count_jobs(spark, name, fn)
    # end to end, once: four bronze tables -> silver (lineage, gate) -> gold -> summary
    bronze_root = f"{root}/bronze"
    for name, df in {
        "bronze_transactions": testdata.transactions(spark, sf_dir),
        "bronze_customers": testdata.customers(spark, sf_dir),
        "bronze_products": testdata.products(spark, sf_dir),
        "bronze_orders": bronze,
    }.items():
        df.write.parquet(f"{bronze_root}/{name}")
    cfg = LayerConfig(
        bronze_tables={n: f"{bronze_root}/{n}" for n in (
            "bronze_transactions", "bronze_customers", "bronze_products", "bronze_orders")},
        silver_root=f"{root}/silver",
        gold_root=f"{root}/gold",
        transactions_table="silver_transactions",
        customers_table="silver_customers",
        products_table="silver_products",
        lineage_path=f"{root}/lineage",
        rules={"silver_orders": ()},  # the dirty table's id would fail the gate by design
        as_of=AS_OF,
    )
    t0 = time.perf_counter()
    run_layers(spark, cfg)
    results["end_to_end_layers"] = round(time.perf_counter() - t0, 3)
    gold = [k for k in results if k in {
        "customer_analytics", "product_analytics", "daily_metrics", "monthly_metrics",
        "cohort_analysis", "rfm_customer_segments",
    }]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "gold_datasets_total",
        "value": round(sum(results[k] for k in gold), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "spark_jobs": job_counts,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
