"""Registered queries: one per operator of the layered platform, over the test tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL over the
same tables as views) must agree in row count, column names and values. Queries
that write and read back use a fresh folder under the shared root
(``spark.checkpoint.dir``). Clock columns (current time / date) are pinned or
dropped so results are reproducible.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.operators import cleaning, quality
from laminar.operators.ranking import global_rank
from laminar.plans import cohort, customer, product, rfm, timeseries
from laminar.sources import testdata

QueryFn = Callable[[SparkSession, str], DataFrame]

# The pinned "today" of the oracle queries (one day after the last order)
# and the pinned run date of the cleaning and gold writes.
AS_OF = _dt.date(2001, 8, 2)
RUN_DATE = _dt.date(2001, 8, 2)

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# --------------------------------------------------------------------------- SQL parts

def _tx_cte(where: str = "", customer: str = "o_custkey") -> str:
    return f"""tx AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS transaction_id,
         {customer} AS customer_id,
         l_partkey AS product_id,
         CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
           * CAST(0.004 AS DECIMAL(4,3)) AS amount,
         o_orderdate AS transaction_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey {where})"""


TX = _tx_cte()
TX_RECENT = _tx_cte("WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'")
TX_HOT = _tx_cte(customer="CASE WHEN o_orderstatus = 'O' THEN CAST(0 AS BIGINT) ELSE o_custkey END")

CUSTOMERS_CTE = """customers AS (
  SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment,
         c_nationkey AS nation_id, c_acctbal AS balance FROM customer)"""

PRODUCTS_CTE = """products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_brand AS brand, p_type AS type,
         p_size AS size, p_retailprice AS list_price FROM part)"""

CUSTOMER_SUMMARY_CTE = """csum AS (
  SELECT customer_id, count(transaction_id) AS total_transactions,
         CAST(sum(amount) AS DOUBLE) AS total_amount,
         CASE WHEN count(amount) = 0 THEN NULL
              ELSE CAST(sum(amount) AS DOUBLE) / CAST(count(amount) AS DOUBLE) END
           AS avg_transaction_amount,
         max(transaction_date) AS last_transaction_date,
         min(transaction_date) AS first_transaction_date
  FROM tx GROUP BY customer_id)"""

CUSTOMER_SEGMENTS_CTE = """cseg AS (
  SELECT *,
         CASE WHEN total_amount >= 10000 THEN 'Premium' WHEN total_amount >= 5000 THEN 'Gold'
              WHEN total_amount >= 1000 THEN 'Silver' ELSE 'Bronze' END AS customer_segment,
         CASE WHEN total_transactions >= 50 THEN 'High' WHEN total_transactions >= 20 THEN 'Medium'
              ELSE 'Low' END AS transaction_frequency
  FROM csum)"""


def _customer_derived(src: str, extra: str = "") -> str:
    return f"""SELECT *,{extra}
  total_amount * CASE WHEN customer_segment = 'Premium' THEN 1.5
                      WHEN customer_segment = 'Gold' THEN 1.3
                      WHEN customer_segment = 'Silver' THEN 1.1 ELSE 1.0 END
    AS customer_lifetime_value,
  CASE WHEN days_since_last_transaction > 90 THEN 'High'
       WHEN days_since_last_transaction > 30 THEN 'Medium' ELSE 'Low' END AS churn_risk
FROM (SELECT *, CAST(date_diff('day', CAST(last_transaction_date AS DATE),
                                DATE '{AS_OF.isoformat()}') AS INTEGER)
                  AS days_since_last_transaction FROM {src}) d"""


def _customer_analytics_parts(tx: str, extra: str = "") -> tuple[str, str]:
    """(CTE list, final SELECT) of the G1 oracle."""
    ctes = f"""{tx}, {CUSTOMERS_CTE}, {CUSTOMER_SUMMARY_CTE}, {CUSTOMER_SEGMENTS_CTE},
joined AS (
  SELECT c.*, coalesce(s.total_transactions, 0) AS total_transactions,
         coalesce(s.total_amount, 0.0) AS total_amount, s.avg_transaction_amount,
         s.last_transaction_date, s.first_transaction_date, s.customer_segment,
         s.transaction_frequency
  FROM customers c LEFT JOIN cseg s ON c.customer_id = s.customer_id)"""
    return ctes, _customer_derived("joined", extra)


def _customer_analytics_sql(tx: str, extra: str = "") -> str:
    ctes, select = _customer_analytics_parts(tx, extra)
    return f"WITH {ctes}\n{select}"


PRODUCT_SUMMARY_CTE = """psum AS (
  SELECT product_id, count(transaction_id) AS total_sales,
         CAST(sum(quantity) AS DOUBLE) AS total_quantity_sold,
         CAST(sum(amount) AS DOUBLE) AS total_revenue,
         CASE WHEN count(amount) = 0 THEN NULL
              ELSE CAST(sum(amount) AS DOUBLE) / CAST(count(amount) AS DOUBLE) END AS avg_sale_amount,
         count(DISTINCT customer_id) AS unique_customers
  FROM tx GROUP BY product_id)"""

PRODUCT_PERF_CTE = """prank AS (
  SELECT *,
    CAST(row_number() OVER (ORDER BY total_revenue DESC NULLS LAST, product_id) AS BIGINT)
      AS revenue_rank,
    percent_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) * 100 AS revenue_percentile
  FROM psum),
pperf AS (
  SELECT *,
    CASE WHEN revenue_percentile >= 80 THEN 'Top Performer'
         WHEN revenue_percentile >= 60 THEN 'Good Performer'
         WHEN revenue_percentile >= 40 THEN 'Average Performer'
         WHEN revenue_percentile >= 20 THEN 'Below Average'
         ELSE 'Poor Performer' END AS performance_category
  FROM prank)"""


def _product_analytics_sql(tx: str) -> str:
    return f"""WITH {tx}, {PRODUCTS_CTE}, {PRODUCT_SUMMARY_CTE}, {PRODUCT_PERF_CTE}
SELECT p.*, coalesce(f.total_sales, 0) AS total_sales, f.total_quantity_sold,
       coalesce(f.total_revenue, 0.0) AS total_revenue, f.avg_sale_amount, f.unique_customers,
       f.revenue_rank, f.revenue_percentile, f.performance_category
FROM products p LEFT JOIN pperf f ON p.product_id = f.product_id"""


def _period_sql(key_expr: str, key: str, prefix: str) -> str:
    return f"""SELECT {key_expr} AS {key},
         count(transaction_id) AS {prefix}_transaction_count,
         sum(amount) AS sm, count(amount) AS n,
         count(DISTINCT customer_id) AS {prefix}_unique_customers,
         count(DISTINCT product_id) AS {prefix}_unique_products
  FROM tx GROUP BY 1"""


DAILY_SQL = f"""WITH {TX}, d AS ({_period_sql('CAST(transaction_date AS DATE)', 'transaction_date', 'daily')})
SELECT transaction_date, daily_transaction_count, CAST(sm AS DOUBLE) AS daily_revenue,
  CAST(sm AS DOUBLE) / CAST(n AS DOUBLE) AS daily_avg_transaction,
  daily_unique_customers, daily_unique_products,
  CAST(sum(sm) OVER w7 AS DOUBLE) / CAST(count(sm) OVER w7 AS DOUBLE) AS revenue_7d_avg,
  CAST(sum(sm) OVER w30 AS DOUBLE) / CAST(count(sm) OVER w30 AS DOUBLE) AS revenue_30d_avg,
  CAST(sum(daily_transaction_count) OVER w7 AS DOUBLE)
    / CAST(count(daily_transaction_count) OVER w7 AS DOUBLE) AS transaction_count_7d_avg,
  CAST(sum(daily_transaction_count) OVER w30 AS DOUBLE)
    / CAST(count(daily_transaction_count) OVER w30 AS DOUBLE) AS transaction_count_30d_avg
FROM d
WINDOW w7 AS (ORDER BY transaction_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (ORDER BY transaction_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""

MONTHLY_SQL = f"""WITH {TX}, m AS ({_period_sql("strftime(transaction_date, '%Y-%m')", 'year_month', 'monthly')}),
m2 AS (
  SELECT year_month, monthly_transaction_count, CAST(sm AS DOUBLE) AS monthly_revenue,
    CAST(sm AS DOUBLE) / CAST(n AS DOUBLE) AS monthly_avg_transaction,
    monthly_unique_customers, monthly_unique_products,
    CAST(substr(year_month, 1, 4) AS INTEGER) AS year,
    CAST(substr(year_month, 6, 2) AS INTEGER) AS month
  FROM m),
m3 AS (SELECT *, lag(monthly_revenue) OVER (ORDER BY year_month) AS prev_month_revenue FROM m2)
SELECT *, CASE WHEN prev_month_revenue IS NULL THEN 0.0
               WHEN prev_month_revenue = 0 THEN NULL
               ELSE (monthly_revenue - prev_month_revenue) / prev_month_revenue * 100 END
            AS revenue_mom_growth
FROM m3"""

FIRST_PURCHASE_CTE = """fp AS (
  SELECT customer_id, min(transaction_date) AS first_purchase_date FROM tx GROUP BY customer_id)"""

COHORT_SIZES_CTE = """sizes AS (
  SELECT strftime(first_purchase_date, '%Y-%m') AS cohort_month,
         count(DISTINCT customer_id) AS cohort_size
  FROM fp WHERE customer_id IS NOT NULL GROUP BY 1)"""

# Spark months_between on whole-day timestamps: whole months when the days of month
# match or both are month ends, otherwise months plus day difference over 31, truncated.
MONTHS_SINCE_SQL = """CAST(CASE
    WHEN day(f) = day(b) OR (CAST(f AS DATE) = last_day(f) AND CAST(b AS DATE) = last_day(b))
      THEN (year(b) - year(f)) * 12 + month(b) - month(f)
    ELSE trunc((year(b) - year(f)) * 12 + month(b) - month(f) + (day(b) - day(f)) / 31.0)
  END AS INTEGER)"""

def _cohort_sql(tx: str) -> str:
    return f"""WITH {tx}, {FIRST_PURCHASE_CTE}, {COHORT_SIZES_CTE},
j AS (SELECT tx.customer_id, tx.amount, tx.transaction_id, tx.transaction_date AS b,
             fp.first_purchase_date AS f
      FROM tx JOIN fp ON tx.customer_id = fp.customer_id),
cells AS (
  SELECT strftime(f, '%Y-%m') AS cohort_month, {MONTHS_SINCE_SQL} AS months_since_first_purchase,
         count(DISTINCT customer_id) AS customers, CAST(sum(amount) AS DOUBLE) AS revenue,
         count(transaction_id) AS transactions
  FROM j GROUP BY 1, 2)
SELECT c.*, s.cohort_size,
       CAST(c.customers / s.cohort_size * 100 AS DECIMAL(5,2)) AS retention_rate
FROM cells c JOIN sizes s ON c.cohort_month = s.cohort_month"""


COHORT_SQL = _cohort_sql(TX)

RFM_BASE_CTE = """base AS (
  SELECT customer_id,
         CAST(date_diff('day', CAST(max(transaction_date) AS DATE),
                        (SELECT CAST(max(transaction_date) AS DATE) FROM tx)) AS INTEGER) AS recency,
         count(transaction_id) AS frequency,
         CAST(sum(amount) AS DOUBLE) AS monetary
  FROM tx GROUP BY customer_id)"""

RFM_CUTS_CTE = """cuts AS (
  SELECT quantile_disc(recency, [0.2, 0.4, 0.6, 0.8]) AS rq,
         quantile_disc(frequency, [0.2, 0.4, 0.6, 0.8]) AS fq,
         quantile_disc(monetary, [0.2, 0.4, 0.6, 0.8]) AS mq
  FROM base)"""


def _rfm_sql(recency_case: str, tx: str = TX) -> str:
    hi = lambda c, q: (
        f"CASE WHEN {c} >= {q}[4] THEN 5 WHEN {c} >= {q}[3] THEN 4 WHEN {c} >= {q}[2] THEN 3 "
        f"WHEN {c} >= {q}[1] THEN 2 ELSE 1 END"
    )
    return f"""WITH {tx}, {RFM_BASE_CTE}, {RFM_CUTS_CTE},
scored AS (
  SELECT b.*, {recency_case} AS r_score, {hi('frequency', 'fq')} AS f_score,
         {hi('monetary', 'mq')} AS m_score
  FROM base b, cuts)
SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR)
            AS rfm_score,
  CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
       WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
       WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
       WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
       WHEN r_score <= 2 AND f_score <= 2 AND m_score >= 3 THEN 'Cannot Lose Them'
       WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost Customers'
       ELSE 'Others' END AS customer_segment
FROM scored"""


RECENCY_STANDARD_SQL = (
    "CASE WHEN recency <= rq[1] THEN 5 WHEN recency <= rq[2] THEN 4 WHEN recency <= rq[3] THEN 3 "
    "WHEN recency <= rq[4] THEN 2 ELSE 1 END"
)
RECENCY_AS_WRITTEN_SQL = (
    "CASE WHEN recency <= rq[1] THEN 1 WHEN recency <= rq[1] THEN 2 WHEN recency <= rq[2] THEN 3 "
    "WHEN recency <= rq[3] THEN 4 ELSE 5 END"
)


# --------------------------------------------------------------------------- G1 customers

@register("customer_summary", f"""WITH {TX}, {CUSTOMER_SUMMARY_CTE} SELECT * FROM csum""")
def q_customer_summary(spark, sf_dir):
    """A1 per-customer summary."""
    return customer.customer_summary(testdata.transactions(spark, sf_dir))


@register(
    "customer_segments",
    f"""WITH {TX}, {CUSTOMER_SUMMARY_CTE}, {CUSTOMER_SEGMENTS_CTE} SELECT * FROM cseg""",
)
def q_customer_segments(spark, sf_dir):
    """A1 then E1, E2 (spend tier, frequency band)."""
    return customer.customer_segments(
        customer.customer_summary(testdata.transactions(spark, sf_dir))
    )


@register("customer_analytics", _customer_analytics_sql(TX))
def q_customer_analytics(spark, sf_dir):
    """G1 with the customer master (J1 left join, E3-E5)."""
    return customer.customer_analytics(
        testdata.customers(spark, sf_dir), testdata.transactions(spark, sf_dir), as_of=AS_OF
    )


@register("customer_analytics_recent", _customer_analytics_sql(TX_RECENT))
def q_customer_analytics_recent(spark, sf_dir):
    """G1 on recent transactions only: unmatched customers get 0 / 0.0 / Low."""
    return customer.customer_analytics(
        testdata.customers(spark, sf_dir),
        testdata.recent_transactions(spark, sf_dir),
        as_of=AS_OF,
    )


@register(
    "customer_analytics_no_master",
    f"""WITH {TX}, {CUSTOMER_SUMMARY_CTE}, {CUSTOMER_SEGMENTS_CTE} {_customer_derived('cseg')}""",
)
def q_customer_analytics_no_master(spark, sf_dir):
    """G1 without a customer master."""
    return customer.customer_analytics(None, testdata.transactions(spark, sf_dir), as_of=AS_OF)


# --------------------------------------------------------------------------- G2 products

@register("product_summary", f"""WITH {TX}, {PRODUCT_SUMMARY_CTE} SELECT * FROM psum""")
def q_product_summary(spark, sf_dir):
    """A2 per-product summary (one distinct count)."""
    return product.product_summary(testdata.transactions(spark, sf_dir))


@register(
    "product_rank",
    f"""WITH {TX}, {PRODUCT_SUMMARY_CTE}, {PRODUCT_PERF_CTE}
SELECT product_id, total_revenue, revenue_rank, revenue_percentile FROM prank""",
)
def q_product_rank(spark, sf_dir):
    """W1 row number and W2 percent rank by revenue, distributed."""
    summary = product.product_summary(testdata.transactions(spark, sf_dir))
    return product.rank_products(summary.select("product_id", "total_revenue"))


@register(
    "product_rank_distributed",
    f"""WITH {TX}, {PRODUCT_SUMMARY_CTE}, {PRODUCT_PERF_CTE}
SELECT product_id, total_revenue, revenue_rank, revenue_percentile FROM prank""",
)
def q_product_rank_distributed(spark, sf_dir):
    """W1/W2 spread over 64 range partitions: offsets across many partitions."""
    summary = product.product_summary(testdata.transactions(spark, sf_dir))
    return product.rank_products(summary.select("product_id", "total_revenue"), n_partitions=64)


@register(
    "product_rank_ties",
    f"""WITH {TX}, {PRODUCT_SUMMARY_CTE}
SELECT product_id, total_sales,
  CAST(row_number() OVER (ORDER BY total_sales DESC NULLS LAST, product_id) AS BIGINT) AS sales_rank,
  CAST(rank() OVER (ORDER BY total_sales DESC NULLS LAST) AS BIGINT) AS sales_rank_tied,
  percent_rank() OVER (ORDER BY total_sales DESC NULLS LAST) * 100 AS sales_percentile
FROM psum""",
)
def q_product_rank_ties(spark, sf_dir):
    """W1/W2 on sale counts: few distinct values, so tie groups cross range partitions."""
    summary = product.product_summary(testdata.transactions(spark, sf_dir))
    ranked = global_rank(
        summary.select("product_id", "total_sales"),
        "total_sales",
        ["product_id"],
        descending=True,
        row_number_col="sales_rank",
        rank_col="sales_rank_tied",
        percent_rank_col="__pr",
    )
    return ranked.withColumn("sales_percentile", F.col("__pr") * 100).drop("__pr")


@register("product_analytics", _product_analytics_sql(TX))
def q_product_analytics(spark, sf_dir):
    """G2 with the product master (J2 left join, E6)."""
    return product.product_analytics(
        testdata.products(spark, sf_dir), testdata.transactions(spark, sf_dir)
    )


@register("product_analytics_recent", _product_analytics_sql(TX_RECENT))
def q_product_analytics_recent(spark, sf_dir):
    """G2 on recent transactions only: unsold products keep null ranks."""
    return product.product_analytics(
        testdata.products(spark, sf_dir), testdata.recent_transactions(spark, sf_dir)
    )


@register(
    "product_analytics_no_master",
    f"""WITH {TX}, {PRODUCT_SUMMARY_CTE}, {PRODUCT_PERF_CTE} SELECT * FROM pperf""",
)
def q_product_analytics_no_master(spark, sf_dir):
    """G2 without a product master."""
    return product.product_analytics(None, testdata.transactions(spark, sf_dir))


# --------------------------------------------------------------------------- G3, G4 time series

@register("daily_metrics", DAILY_SQL)
def q_daily_metrics(spark, sf_dir):
    """A3 per day, W3 trailing 7 / 30 present-day averages."""
    return timeseries.daily_metrics(testdata.transactions(spark, sf_dir))


@register("monthly_metrics", MONTHLY_SQL)
def q_monthly_metrics(spark, sf_dir):
    """A4 per month, W4 previous month, E7 growth."""
    return timeseries.monthly_metrics(testdata.transactions(spark, sf_dir))


# --------------------------------------------------------------------------- G5 cohorts

@register("first_purchase", f"""WITH {TX}, {FIRST_PURCHASE_CTE} SELECT * FROM fp""")
def q_first_purchase(spark, sf_dir):
    """A5 first purchase per customer."""
    return cohort.first_purchase(testdata.transactions(spark, sf_dir))


@register(
    "cohort_sizes", f"""WITH {TX}, {FIRST_PURCHASE_CTE}, {COHORT_SIZES_CTE} SELECT * FROM sizes"""
)
def q_cohort_sizes(spark, sf_dir):
    """A7 customers per first-purchase month."""
    return cohort.cohort_sizes(cohort.first_purchase(testdata.transactions(spark, sf_dir)))


@register("cohort_analysis", COHORT_SQL)
def q_cohort_analysis(spark, sf_dir):
    """J3 (hot customers split), E8, E9, A6, J4, E10."""
    return cohort.cohort_analysis(testdata.transactions(spark, sf_dir))


# --------------------------------------------------------------------------- G6 RFM

@register("rfm_base", f"""WITH {TX}, {RFM_BASE_CTE} SELECT * FROM base""")
def q_rfm_base(spark, sf_dir):
    """A8 reference date (scalar subquery) and A9 recency, frequency, monetary."""
    return rfm.rfm_base(testdata.transactions(spark, sf_dir))


@register(
    "rfm_cuts",
    f"""WITH {TX}, {RFM_BASE_CTE}, {RFM_CUTS_CTE}
SELECT measure, probability, cut FROM (
  SELECT 'recency' AS measure, unnest(CAST([0.2, 0.4, 0.6, 0.8] AS DOUBLE[])) AS probability,
         unnest(CAST(rq AS DOUBLE[])) AS cut FROM cuts
  UNION ALL
  SELECT 'frequency', unnest(CAST([0.2, 0.4, 0.6, 0.8] AS DOUBLE[])), unnest(CAST(fq AS DOUBLE[])) FROM cuts
  UNION ALL
  SELECT 'monetary', unnest(CAST([0.2, 0.4, 0.6, 0.8] AS DOUBLE[])), unnest(CAST(mq AS DOUBLE[])) FROM cuts) u""",
)
def q_rfm_cuts(spark, sf_dir):
    """A10 exact quintile cuts of the three measures, one row per cut."""
    return rfm.rfm_cut_table(rfm.rfm_base(testdata.transactions(spark, sf_dir)), relative_error=0.0)


@register("rfm_customer_segments", _rfm_sql(RECENCY_STANDARD_SQL))
def q_rfm_customer_segments(spark, sf_dir):
    """G6 with exact cuts: E11 scores, E12 code, E13 segment."""
    return rfm.rfm_segments(testdata.transactions(spark, sf_dir), relative_error=0.0)


@register("rfm_as_written", _rfm_sql(RECENCY_AS_WRITTEN_SQL))
def q_rfm_as_written(spark, sf_dir):
    """G6 with the published recency chain."""
    return rfm.rfm_segments(
        testdata.transactions(spark, sf_dir), relative_error=0.0, recency_mode="as_written"
    )


@register("rfm_customer_segments_approx")
def q_rfm_customer_segments_approx(spark, sf_dir):
    """The published setting (approximate cuts, relative error 0.05): no exact oracle;
    one row per customer regardless of the cuts."""
    return rfm.rfm_segments(testdata.transactions(spark, sf_dir))


@register("rfm_customer_segments_sketch", _rfm_sql(RECENCY_STANDARD_SQL))
def q_rfm_customer_segments_sketch(spark, sf_dir):
    """G6 by the default road (sketched cuts) at an error below one rank of the check's
    number of customers, where the sketch's cuts are the exact ones."""
    return rfm.rfm_segments(testdata.transactions(spark, sf_dir), relative_error=1e-6)


# --------------------------------------------------------------------------- C cleaning

BRONZE_CTE = """dirty AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS id,
    CASE WHEN o_orderkey % 89 = 0 THEN 'bad'
         WHEN o_orderkey % 83 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS "Transaction_Date",
    CASE WHEN o_orderkey % 79 = 0 THEN 'n/a'
         WHEN o_orderkey % 73 = 0 THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS "Amount",
    CASE WHEN o_orderkey % 71 = 0 THEN 'not-an-email'
         WHEN o_orderkey % 67 = 0 THEN NULL
         ELSE 'user' || CAST(o_custkey AS VARCHAR) || '@example.com' END AS email,
    o_orderstatus AS "Order-Status", o_orderpriority AS "Order Priority", o_orderkey AS k
  FROM orders),
bronze AS (
  SELECT * EXCLUDE (k) FROM dirty
  UNION ALL SELECT * EXCLUDE (k) FROM dirty WHERE "Order Priority" = '1-URGENT')"""

DEDUP_CTE = "dedup AS (SELECT DISTINCT * FROM bronze)"
KEYED_CTE = "keyed AS (SELECT * FROM dedup WHERE id IS NOT NULL)"
NAMED_CTE = """named AS (
  SELECT id, "Transaction_Date" AS transaction_date, "Amount" AS amount, email,
         "Order-Status" AS order_status, "Order Priority" AS order_priority FROM keyed)"""
EMAIL_SQL = (
    "coalesce(regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$'), false)"
)
CLEANED_CTE = f"""cleaned AS (
  SELECT id, try_strptime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_date,
         coalesce(TRY_CAST(amount AS DOUBLE), 0.0) AS amount, email, order_status, order_priority,
         'bronze_layer' AS data_source, {EMAIL_SQL} AS email_valid
  FROM named)"""
CLEAN_CHAIN = f"WITH {BRONZE_CTE}, {DEDUP_CTE}, {KEYED_CTE}, {NAMED_CTE}"
SILVER_CTES = f"""{BRONZE_CTE}, {DEDUP_CTE}, {KEYED_CTE}, {NAMED_CTE}, {CLEANED_CTE},
silver AS (
  SELECT *, DATE '{RUN_DATE.isoformat()}' AS processing_date,
         {RUN_DATE.year} AS year, {RUN_DATE.month} AS month, {RUN_DATE.day} AS day
  FROM cleaned)"""
SILVER_SQL = f"WITH {SILVER_CTES} SELECT * FROM silver"

CLOCK_COLUMNS = ("processed_timestamp",)


def _bronze(spark, sf_dir):
    return testdata.dirty_bronze_orders(spark, sf_dir)


def _named(spark, sf_dir):
    out = cleaning.drop_null_keys(cleaning.drop_exact_duplicates(_bronze(spark, sf_dir)))
    return cleaning.normalize_column_names(out)


def _silver(spark, sf_dir):
    return cleaning.clean_for_silver(_bronze(spark, sf_dir), run_date=RUN_DATE).drop(*CLOCK_COLUMNS)


@register("clean_dedup", f"WITH {BRONZE_CTE}, {DEDUP_CTE} SELECT * FROM dedup")
def q_clean_dedup(spark, sf_dir):
    """C1 exact duplicates removed."""
    return cleaning.drop_exact_duplicates(_bronze(spark, sf_dir))


@register("clean_null_key", f"WITH {BRONZE_CTE}, {DEDUP_CTE}, {KEYED_CTE} SELECT * FROM keyed")
def q_clean_null_key(spark, sf_dir):
    """C1 then C2 (null id removed)."""
    return cleaning.drop_null_keys(cleaning.drop_exact_duplicates(_bronze(spark, sf_dir)))


@register("clean_names", f"{CLEAN_CHAIN} SELECT * FROM named")
def q_clean_names(spark, sf_dir):
    """C1, C2, then C3 name normalization."""
    return _named(spark, sf_dir)


@register(
    "clean_dates",
    f"""{CLEAN_CHAIN}
SELECT * REPLACE (try_strptime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_date)
FROM named""",
)
def q_clean_dates(spark, sf_dir):
    """C1-C3 then C5 date parsing (bad and date-only text become null)."""
    return cleaning.parse_dates(_named(spark, sf_dir))


@register(
    "clean_numbers",
    f"""{CLEAN_CHAIN}
SELECT * REPLACE (coalesce(TRY_CAST(amount AS DOUBLE), 0.0) AS amount) FROM named""",
)
def q_clean_numbers(spark, sf_dir):
    """C1-C3 then C6 numbers (bad or null become 0.0)."""
    return cleaning.coerce_numbers(_named(spark, sf_dir))


@register("clean_email", f"{CLEAN_CHAIN} SELECT *, {EMAIL_SQL} AS email_valid FROM named")
def q_clean_email(spark, sf_dir):
    """C1-C3 then C7 e-mail flag."""
    return cleaning.flag_emails(_named(spark, sf_dir))


@register("clean_audit", f"{CLEAN_CHAIN}, {CLEANED_CTE} SELECT * FROM cleaned")
def q_clean_audit(spark, sf_dir):
    """C0 in full; the two clock columns (current timestamp and date) are left out."""
    return cleaning.apply_quality_rules(_bronze(spark, sf_dir)).drop(
        "processed_timestamp", "processing_date"
    )


@register("clean_partition_cols", SILVER_SQL)
def q_clean_partition_cols(spark, sf_dir):
    """C0 + C8 with the run date pinned."""
    return _silver(spark, sf_dir)


@register(
    "clean_report",
    f"""WITH {BRONZE_CTE},
g AS (SELECT id, count(*) AS n FROM bronze
      GROUP BY id, "Transaction_Date", "Amount", email, "Order-Status", "Order Priority")
SELECT CAST(sum(n) AS BIGINT) AS input_rows,
       CAST(sum(n) - count(*) AS BIGINT) AS duplicates_removed,
       CAST(sum(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_keys_removed,
       CAST(count(*) - sum(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS output_rows
FROM g""",
)
def q_clean_report(spark, sf_dir):
    """C9 counts from one grouping of the raw rows."""
    return cleaning.cleaning_report(_bronze(spark, sf_dir))


# --------------------------------------------------------------------------- Q quality

def _dq_sql(source_cte: str, table: str, key: str, n_columns: int) -> str:
    return f"""WITH {source_cte},
g AS (SELECT {key} AS v, count(*) AS n FROM {table} GROUP BY {key}),
s AS (SELECT CAST(sum(n) AS DOUBLE) AS total,
             CAST(coalesce(sum(CASE WHEN v IS NOT NULL THEN n END), 0) AS DOUBLE) AS non_null,
             CAST(coalesce(sum(CASE WHEN v IS NOT NULL AND n = 1 THEN 1 END), 0) AS DOUBLE) AS singles
      FROM g)
SELECT 'ColumnCount' AS rule, CAST(NULL AS VARCHAR) AS "column",
       CAST({n_columns} AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold,
       {n_columns} > 0 AS passed FROM s
UNION ALL
SELECT 'Completeness', '{key}', non_null / total, CAST(0.95 AS DOUBLE),
       coalesce(non_null / total > 0.95, false) FROM s
UNION ALL
SELECT 'Uniqueness', '{key}', singles / non_null, CAST(0.99 AS DOUBLE),
       coalesce(singles / non_null > 0.99, false) FROM s"""


def _ruleset(key: str):
    return (
        quality.Rule("ColumnCount", None, 0.0),
        quality.Rule("Completeness", key, 0.95),
        quality.Rule("Uniqueness", key, 0.99),
    )


@register("dq_ruleset", _dq_sql(BRONZE_CTE, "bronze", "id", 6))
def q_dq_ruleset(spark, sf_dir):
    """Q1-Q4 on the raw table: completeness and uniqueness of ``id`` fail."""
    return quality.evaluate_ruleset(_bronze(spark, sf_dir))


@register("dq_ruleset_silver", _dq_sql(SILVER_CTES, "silver", "id", 13))
def q_dq_ruleset_silver(spark, sf_dir):
    """Q1-Q4 on the cleaned table (13 columns): every rule passes."""
    return quality.evaluate_ruleset(
        cleaning.clean_for_silver(_bronze(spark, sf_dir), run_date=RUN_DATE)
    )


@register("dq_ruleset_labels", _dq_sql("t AS (SELECT * FROM labels)", "t", "doc_id", 3))
def q_dq_ruleset_labels(spark, sf_dir):
    """Q1-Q4 keyed on doc_id: every rule passes."""
    return quality.evaluate_ruleset(testdata.table(spark, sf_dir, "labels"), _ruleset("doc_id"))


@register("dq_ruleset_events", _dq_sql("t AS (SELECT * FROM events)", "t", "user_id", 6))
def q_dq_ruleset_events(spark, sf_dir):
    """A repeated key: uniqueness 0, the gate would stop here."""
    return quality.evaluate_ruleset(testdata.table(spark, sf_dir, "events"), _ruleset("user_id"))


# --------------------------------------------------------------------------- S sinks and catalog

def _fresh(spark, label):
    from laminar.session import fresh_dir

    return fresh_dir(spark, label)


def _land(spark, tables, root):
    """Each table written to its folder under ``root``; the shuffles of their joins go then."""
    from laminar.session import shuffles_removed

    with shuffles_removed(spark):
        for name, df in tables.items():
            df.write.parquet(f"{root}/{name}")


def _landed(spark, df, path):
    """The rows written once and read back, so that later reads repeat no join."""
    df.write.parquet(path)
    return spark.read.parquet(path)


@register("silver_roundtrip", SILVER_SQL)
def q_silver_roundtrip(spark, sf_dir):
    """S6 then S1/S2: the cleaned table written as partitioned Parquet and read back
    (partition columns come back from the folder names)."""
    from laminar.sources import layers

    root = _fresh(spark, "silver")
    layers.write_layer(
        cleaning.clean_for_silver(_bronze(spark, sf_dir), run_date=RUN_DATE), f"{root}/orders"
    )
    return layers.read_table(spark, f"{root}/orders").drop(*CLOCK_COLUMNS)


GOLD_META_SQL = (
    f" 'customer_analytics' AS dataset_name, {RUN_DATE.year} AS year,"
    f" {RUN_DATE.month} AS month, {RUN_DATE.day} AS day,"
)


@register("gold_roundtrip", _customer_analytics_sql(TX, GOLD_META_SQL))
def q_gold_roundtrip(spark, sf_dir):
    """A gold dataset with its metadata, written for the run date and read back."""
    from laminar.sources import layers

    root = _fresh(spark, "gold")
    df = customer.customer_analytics(
        testdata.customers(spark, sf_dir), testdata.transactions(spark, sf_dir), as_of=AS_OF
    )
    layers.write_gold(df, root, "customer_analytics", run_date=RUN_DATE)
    return layers.read_table(spark, f"{root}/customer_analytics").drop("created_timestamp")


@register(
    "lineage",
    f"""WITH {SILVER_CTES}
SELECT 'bronze_orders' AS source_table, 'silver_orders' AS target_table,
       'bronze_to_silver' AS transformation_type, 'bronze_to_silver' AS job_name,
       count(*) AS record_count
FROM silver""",
)
def q_lineage(spark, sf_dir):
    """Cleaning job writes silver and appends its lineage row; the lineage
    table is read back (time columns left out)."""
    from laminar.plans.layers import clean_to_silver
    from laminar.sources import layers

    root = _fresh(spark, "lineage")
    clean_to_silver(
        _bronze(spark, sf_dir), f"{root}/silver", "bronze_orders", "bronze_to_silver",
        lineage_path=f"{root}/lineage", run_date=RUN_DATE,
    )
    return layers.read_table(spark, f"{root}/lineage").select(
        "source_table", "target_table", "transformation_type", "job_name", "record_count"
    )


def _gold_counts_sql() -> str:
    parts = [
        ("customer_analytics", "SELECT count(*) FROM customer"),
        ("product_analytics", "SELECT count(*) FROM part"),
        ("daily_metrics", "SELECT count(DISTINCT CAST(transaction_date AS DATE)) FROM tx"),
        ("monthly_metrics", "SELECT count(DISTINCT strftime(transaction_date, '%Y-%m')) FROM tx"),
        (
            "cohort_analysis",
            f"SELECT count(*) FROM (SELECT DISTINCT strftime(f, '%Y-%m'), {MONTHS_SINCE_SQL} "
            "FROM (SELECT t.transaction_date AS b, fp.first_purchase_date AS f FROM tx t "
            "JOIN fp ON t.customer_id = fp.customer_id) j) c",
        ),
        ("rfm_customer_segments", "SELECT count(DISTINCT customer_id) FROM tx"),
    ]
    union = "\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset_name, ({q}) AS record_count, 'silver_to_gold' AS job_name"
        for name, q in parts
    )
    return f"WITH {TX}, {FIRST_PURCHASE_CTE}\n{union}"


@register("job_summary", _gold_counts_sql())
def q_job_summary(spark, sf_dir):
    """All six gold datasets written, then summarized by the counts of their written
    files (processing time and timestamps left out)."""
    from laminar.plans.layers import JOB_SUMMARY, build_gold
    from laminar.sources import layers

    root = _fresh(spark, "gold")
    build_gold(
        _landed(spark, testdata.transactions(spark, sf_dir), f"{root}-transactions"),
        root,
        testdata.customers(spark, sf_dir),
        testdata.products(spark, sf_dir),
        as_of=AS_OF,
        run_date=RUN_DATE,
    )
    return layers.read_table(spark, f"{root}/{JOB_SUMMARY}").select(
        "dataset_name", "record_count", "job_name"
    )


@register(
    "catalog_sql",
    f"""SELECT customer_segment, transaction_frequency, count(*) AS customers
FROM ({_customer_analytics_sql(TX)}) x
GROUP BY customer_segment, transaction_frequency""",
)
def q_catalog_sql(spark, sf_dir):
    """A written gold folder registered as a catalog table (partitions
    recovered), then queried with SQL."""
    from laminar.sources import layers

    root = _fresh(spark, "catalog")
    df = customer.customer_analytics(
        testdata.customers(spark, sf_dir), testdata.transactions(spark, sf_dir), as_of=AS_OF
    )
    layers.write_gold(df, root, "customer_analytics", run_date=RUN_DATE)
    name = f"gold_customer_analytics_{root.rsplit('-', 1)[-1]}"  # the folder is new each time
    layers.register_table(spark, name, f"{root}/customer_analytics")
    return spark.sql(
        "SELECT customer_segment, transaction_frequency, count(*) AS customers "
        f"FROM {name} WHERE year = 2001 AND month = 8 AND day = 2 "
        "GROUP BY customer_segment, transaction_frequency"
    )


# --------------------------------------------------------------------------- S5 incremental

@register(
    "incremental_silver",
    f"""SELECT *, 'bronze_layer' AS data_source, DATE '{RUN_DATE.isoformat()}' AS processing_date,
       {RUN_DATE.year} AS year, {RUN_DATE.month} AS month, {RUN_DATE.day} AS day
FROM events""",
)
def q_incremental_silver(spark, sf_dir):
    """Events land in two drops (earlier half of the time range, then the later
    half); three incremental runs (the last finds nothing new) leave every event in
    silver exactly once."""
    from laminar.streaming.incremental import load_increment

    events = testdata.table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    midpoint = events.select(((F.min(micros) + F.max(micros)) / 2).alias("m")).scalar()
    root = _fresh(spark, "incremental")
    landing, silver, ckpt = f"{root}/landing", f"{root}/silver", f"{root}/_checkpoint"
    early = F.coalesce(micros < midpoint, F.lit(False))  # a null time lands in the second drop
    drops = [events.where(early), events.where(~early)]
    for drop in drops + [None]:
        if drop is not None:
            drop.write.mode("append").parquet(landing)
        load_increment(spark, landing, events.schema, silver, ckpt, run_date=RUN_DATE)
    return spark.read.parquet(silver).drop("processed_timestamp", "batch_id")



NEXT_DAY = RUN_DATE + _dt.timedelta(days=1)


@register(
    "incremental_replay_next_day",
    f"""SELECT *, 'bronze_layer' AS data_source, DATE '{NEXT_DAY.isoformat()}' AS processing_date,
       {NEXT_DAY.year} AS year, {NEXT_DAY.month} AS month, {NEXT_DAY.day} AS day
FROM events""",
)
def q_incremental_replay_next_day(spark, sf_dir):
    """A batch that was written but not committed is replayed on the next day: its
    folder is replaced, whatever date it held."""
    from laminar.streaming.incremental import load_increment

    events = testdata.table(spark, sf_dir, "events")
    root = _fresh(spark, "replay")
    events.write.parquet(f"{root}/landing")
    for day in (RUN_DATE, NEXT_DAY):
        checkpoint = f"{root}/_checkpoint-{day}"  # the first one's commit is lost
        load_increment(spark, f"{root}/landing", events.schema, f"{root}/silver", checkpoint, run_date=day)
    return spark.read.parquet(f"{root}/silver").drop("processed_timestamp", "batch_id")


# --------------------------------------------------------------------------- hot key

@register("customer_analytics_hot_customer", _customer_analytics_sql(TX_HOT))
def q_customer_analytics_hot_customer(spark, sf_dir):
    """G1 when one customer holds a third of all transactions."""
    return customer.customer_analytics(
        testdata.customers(spark, sf_dir),
        testdata.hot_customer_transactions(spark, sf_dir),
        as_of=AS_OF,
    )


@register("cohort_analysis_hot_customer", _cohort_sql(TX_HOT))
def q_cohort_analysis_hot_customer(spark, sf_dir):
    """G5 when one customer holds a third of all transactions."""
    return cohort.cohort_analysis(testdata.hot_customer_transactions(spark, sf_dir))


@register("rfm_customer_segments_hot_customer", _rfm_sql(RECENCY_STANDARD_SQL, TX_HOT))
def q_rfm_customer_segments_hot_customer(spark, sf_dir):
    """G6 (exact cuts) when one customer holds a third of all transactions."""
    return rfm.rfm_segments(testdata.hot_customer_transactions(spark, sf_dir), relative_error=0.0)


# --------------------------------------------------------------------------- whole flow

def _run_whole_flow(spark, sf_dir, run_dates) -> str:
    """The flow on the same bronze tables, once per run date; the gold folder."""
    from laminar.plans.layers import LayerConfig, run_layers

    root = _fresh(spark, "layers")
    bronze = {
        "bronze_transactions": testdata.transactions(spark, sf_dir),
        "bronze_customers": testdata.customers(spark, sf_dir),
        "bronze_products": testdata.products(spark, sf_dir),
    }
    _land(spark, bronze, f"{root}/bronze")
    for run_date in run_dates:
        cfg = LayerConfig(
            bronze_tables={name: f"{root}/bronze/{name}" for name in bronze},
            silver_root=f"{root}/silver",
            gold_root=f"{root}/gold",
            transactions_table="silver_transactions",
            customers_table="silver_customers",
            products_table="silver_products",
            lineage_path=f"{root}/lineage",
            gate_keys={
                "silver_transactions": "transaction_id",
                "silver_customers": "customer_id",
                "silver_products": "product_id",
            },
            as_of=AS_OF,
            run_date=run_date,
        )
        run_layers(spark, cfg)
    return f"{root}/gold"


@register("layers_end_to_end", _gold_counts_sql())
def q_layers_end_to_end(spark, sf_dir):
    """Bronze tables -> cleaning -> silver (quality gate) -> six gold datasets -> job
    summary, as one run; the summary counts are compared."""
    gold = _run_whole_flow(spark, sf_dir, [RUN_DATE])
    return spark.read.parquet(f"{gold}/job_summary").select(
        "dataset_name", "record_count", "job_name"
    )


@register(
    "layers_two_run_dates",
    # amounts have seven decimals: rounded there, sums of doubles and of decimals agree
    f"""SELECT customer_id, total_transactions, CAST(round(total_amount, 7) AS DECIMAL(24, 7)) AS total_amount
FROM ({_customer_analytics_sql(TX)}) x""",
)
def q_layers_two_run_dates(spark, sf_dir):
    """The flow on two run dates over the same bronze: the second day's gold values are
    those of one run (silver is replaced, not doubled)."""
    gold = _run_whole_flow(spark, sf_dir, [RUN_DATE, NEXT_DAY])
    df = spark.read.parquet(f"{gold}/customer_analytics")
    return df.where((F.col("year") == NEXT_DAY.year) & (F.col("month") == NEXT_DAY.month) & (F.col("day") == NEXT_DAY.day)).select(
        "customer_id", "total_transactions", F.round("total_amount", 7).cast("decimal(24,7)").alias("total_amount")
    )


@register(
    "job_summary_empty",
    "SELECT unnest(['customer_analytics', 'product_analytics', 'daily_metrics', 'monthly_metrics', "
    "'cohort_analysis', 'rfm_customer_segments']) AS dataset_name, CAST(0 AS BIGINT) AS record_count "
    "FROM (SELECT count(*) FROM lineitem) x",
)
def q_job_summary_empty(spark, sf_dir):
    """A re-run of the day without transactions: zero rows each, the earlier rows gone."""
    from laminar.plans.layers import GOLD_DATASETS, JOB_SUMMARY, build_gold

    root = _fresh(spark, "gold")
    tx = _landed(spark, testdata.transactions(spark, sf_dir), f"{root}-transactions")
    for rows in (tx, tx.where("transaction_id is null")):
        build_gold(rows, root, as_of=AS_OF, run_date=RUN_DATE, gate=True)
    left = spark.read.schema("dataset_name string").option("recursiveFileLookup", "true")
    stale = left.parquet(*[f"{root}/{d}" for d in GOLD_DATASETS]).groupBy("dataset_name").count()
    summary = spark.read.parquet(f"{root}/{JOB_SUMMARY}").join(stale, "dataset_name", "left")
    rows = F.col("record_count") + F.coalesce("count", F.lit(0))
    return summary.select("dataset_name", rows.alias("record_count"))


_GOLD_CTES, _GOLD_SELECT = _customer_analytics_parts(TX)


@register("dq_ruleset_gold", _dq_sql(f"{_GOLD_CTES}, ca AS ({_GOLD_SELECT})", "ca", "customer_id", 15))
def q_dq_ruleset_gold(spark, sf_dir):
    """Q1-Q4 on a gold dataset, keyed on its own key (customer_id): every rule passes."""
    from laminar.plans.layers import default_rules

    df = customer.customer_analytics(
        testdata.customers(spark, sf_dir), testdata.transactions(spark, sf_dir), as_of=AS_OF
    )
    return quality.evaluate_ruleset(df, default_rules(df, "customer_id"))


# whole flows are registered by a module of their own
from laminar import registry_flows  # noqa: E402, F401
