"""Properties of the gold datasets on the test tables, and the no-master branches."""

import datetime as dt

from pyspark.sql import functions as F

from laminar.plans import cohort, customer, product, rfm, timeseries
from laminar.sources import testdata

SF = "/root/testdata/sf0.001"


def test_revenue_totals_agree(spark):
    tx = testdata.transactions(spark, SF)
    d = timeseries.daily_metrics(tx).agg(F.sum("daily_revenue")).collect()[0][0]
    m = timeseries.monthly_metrics(tx).agg(F.sum("monthly_revenue")).collect()[0][0]
    c = cohort.cohort_analysis(tx).agg(F.sum("revenue")).collect()[0][0]
    assert abs(d - m) < 1e-6 and abs(d - c) < 1e-6


def test_month_zero_equals_cohort_size(spark):
    tx = testdata.transactions(spark, SF)
    rows = cohort.cohort_analysis(tx).where("months_since_first_purchase = 0").collect()
    assert rows and all(r.customers == r.cohort_size for r in rows)


def test_ranks_are_one_to_n(spark):
    tx = testdata.transactions(spark, SF)
    ranks = [r[0] for r in product.product_analytics(None, tx).select("revenue_rank").collect()]
    assert sorted(ranks) == list(range(1, len(ranks) + 1))


def test_scores_in_range(spark):
    tx = testdata.transactions(spark, SF)
    for err in (0.0, 0.05):
        out = rfm.rfm_segments(tx, relative_error=err)
        bad = out.where(
            " OR ".join(f"{c} NOT BETWEEN 1 AND 5 OR {c} IS NULL" for c in ("r_score", "f_score", "m_score"))
        ).count()
        assert bad == 0
        assert out.count() == tx.select("customer_id").distinct().count()


def test_unmatched_customers_and_products(spark):
    tx = testdata.recent_transactions(spark, SF)
    ca = customer.customer_analytics(testdata.customers(spark, SF), tx, as_of=dt.date(2001, 8, 2))
    unmatched = ca.where("last_transaction_date IS NULL").collect()
    assert unmatched
    for r in unmatched:
        assert (r.total_transactions, r.total_amount, r.customer_lifetime_value, r.churn_risk) == (
            0, 0.0, 0.0, "Low")
        assert r.customer_segment is None
    pa = product.product_analytics(testdata.products(spark, SF), tx)
    unsold = pa.where("revenue_rank IS NULL").collect()
    assert unsold and all(r.total_sales == 0 and r.performance_category is None for r in unsold)


def test_empty_transactions(spark):
    tx = testdata.transactions(spark, SF).limit(0)
    assert rfm.rfm_segments(tx, relative_error=0.0).count() == 0
    assert rfm.rfm_segments(tx).count() == 0
    assert cohort.cohort_analysis(tx).count() == 0
    assert timeseries.daily_metrics(tx).count() == 0


def test_zero_previous_month_growth_is_null(spark):
    tx = spark.createDataFrame(
        [("a", 1, 1, 1.0, 0.0, dt.datetime(2001, 1, 5)), ("b", 1, 1, 1.0, 5.0, dt.datetime(2001, 2, 5))],
        "transaction_id string, customer_id long, product_id long, quantity double, "
        "amount double, transaction_date timestamp_ntz",
    )
    rows = timeseries.monthly_metrics(tx).orderBy("year_month").collect()
    assert rows[0].revenue_mom_growth == 0.0 and rows[1].revenue_mom_growth is None


def test_months_between_month_ends(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2000, 1, 31), dt.datetime(2000, 2, 29)),
         (dt.datetime(2000, 1, 30), dt.datetime(2000, 2, 29)),
         (dt.datetime(2000, 1, 15), dt.datetime(2000, 2, 15))],
        "f timestamp_ntz, b timestamp_ntz",
    )
    from laminar.functions import months_since

    assert [r[0] for r in df.select(months_since(F.col("b"), F.col("f"))).collect()] == [1, 0, 1]


def test_null_period_keeps_distinct_counts(spark):
    rows = [("a", 1, 10, 1.0, 2.0, None), ("b", 2, 10, 1.0, 3.0, None),
            ("c", 1, 11, 1.0, 4.0, dt.datetime(2001, 1, 5)), ("d", None, None, 1.0, 1.0, dt.datetime(2001, 1, 5))]
    tx = spark.createDataFrame(
        rows, "transaction_id string, customer_id long, product_id long, quantity double, "
              "amount double, transaction_date timestamp_ntz")
    got = {r.transaction_date: (r.daily_transaction_count, r.daily_unique_customers, r.daily_unique_products)
           for r in timeseries.daily_metrics(tx).collect()}
    assert got == {None: (2, 2, 1), dt.date(2001, 1, 5): (2, 1, 1)}


def test_approx_cuts_within_rank_error(spark):
    """Default (approximate) cuts: each cut's rank is within relative_error * n of the
    target rank p * n, the sketch's guarantee."""
    import bisect

    base = rfm.rfm_base(testdata.transactions(spark, "/root/testdata/sf0.01"))
    cuts = rfm.rfm_cut_table(base, relative_error=0.05).collect()
    values = {m: sorted(r[m] for r in base.select(m).collect() if r[m] is not None)
              for m in rfm.RFM_VALUES}
    for r in cuts:
        vals = values[r.measure]
        n = len(vals)
        lo, hi = bisect.bisect_left(vals, r.cut), bisect.bisect_right(vals, r.cut)
        target = r.probability * n
        # some rank in [lo+1, hi] held by the cut value must be close to the target
        assert lo + 1 - 0.05 * n - 1 <= target <= hi + 0.05 * n + 1, (r, lo, hi, n)


def test_shared_customer_base_gives_same_results(spark):
    tx = testdata.hot_customer_transactions(spark, SF)
    base = customer.customer_base(tx)
    for err in (0.0,):
        a = rfm.rfm_segments(tx, relative_error=err)
        b = rfm.rfm_segments(tx, relative_error=err, customers_base=base)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a = customer.customer_analytics(None, tx, as_of="2001-08-02")
    b = customer.customer_analytics(None, tx, as_of="2001-08-02", base=base)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
