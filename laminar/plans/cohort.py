"""G5 cohort analysis: A5 -> J3 -> E8, E9 -> A6; A7 -> J4 -> E10.

Transactions are first collapsed to one row per (customer, timestamp) with partial
aggregation, so the join with first purchases moves far fewer rows. A customer
that still holds a large share of those rows is split over several join tasks by
salting (:func:`laminar.operators.skew.split_hot_key_join`); the hot-key table is
bounded by a parameter and broadcast. Cohort sizes (one row per month) are
broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.functions import month_key, months_since, retention_rate
from laminar.operators.skew import MAX_HOT_KEYS, MIN_SPLIT_ROWS, split_hot_key_join


def first_purchase(tx: DataFrame) -> DataFrame:
    """A5 earliest transaction date per customer."""
    return tx.groupBy("customer_id").agg(
        F.min("transaction_date").alias("first_purchase_date")
    )


def cohort_sizes(first: DataFrame) -> DataFrame:
    """A7 distinct customers per first-purchase month. ``first`` has one row per
    customer, so a count is the distinct count (no second shuffle)."""
    return (
        first.where(F.col("customer_id").isNotNull())
        .groupBy(month_key(F.col("first_purchase_date")).alias("cohort_month"))
        .agg(F.count("customer_id").alias("cohort_size"))
    )


def _per_timestamp(tx: DataFrame) -> DataFrame:
    """Transactions summed per (customer, timestamp); null customers drop out (J3 is
    an inner join in the published job)."""
    return (
        tx.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "transaction_date")
        .agg(
            F.sum("amount").alias("__rev"),
            F.count("transaction_id").alias("__cnt"),
        )
    )


def _first_with_counts(tx: DataFrame) -> DataFrame:
    """A5 with how many transactions each customer has (they bound the rows per customer
    that J3 meets; the number only sets the salts)."""
    return (
        tx.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.min("transaction_date").alias("first_purchase_date"),
            F.count(F.lit(1)).alias("__rows"),
        )
    )


def _first_of_base(customers_base: DataFrame) -> DataFrame:
    """The same from per-customer aggregates (transactions with an id or an amount)."""
    return customers_base.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        F.col("first_transaction_date").alias("first_purchase_date"),
        F.greatest("total_transactions", "__n").alias("__rows"),
    )


def _parts(tx: DataFrame, customers_base: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """J3's two sides. The small one is read three times (threshold, join, cohort sizes):
    it comes from ``customers_base``, or is written once to the shared checkpoint folder
    (one row per customer, from a scan of two columns). The big one is read once, by the
    join; it hardly shrinks, so writing it would cost more than that second scan."""
    if customers_base is not None:
        return _per_timestamp(tx), _first_of_base(customers_base)
    from laminar.session import shared_root

    shared_root(tx.sparkSession)
    return _per_timestamp(tx), _first_with_counts(tx).checkpoint(eager=True)


def cohort_cells(
    tx: DataFrame,
    max_hot_keys: int = MAX_HOT_KEYS,
    min_split_rows: int = MIN_SPLIT_ROWS,
    _pre: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """A6 per (cohort month, months since first purchase): customers, revenue,
    transactions. J3 splits customers holding a large share of the rows (see
    :mod:`laminar.operators.skew`)."""
    per_ts, first = _pre if _pre is not None else _parts(tx, None)
    joined = split_hot_key_join(
        per_ts, first, "customer_id", "__rows", F.col("transaction_date"),
        max_hot_keys, min_split_rows,
    )
    return (
        joined.groupBy(
            month_key(F.col("first_purchase_date")).alias("cohort_month"),
            months_since(F.col("transaction_date"), F.col("first_purchase_date")).alias(
                "months_since_first_purchase"
            ),
        )
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            F.sum("__rev").alias("__rev"),
            F.sum("__cnt").alias("transactions"),
        )
        .select(
            "cohort_month",
            "months_since_first_purchase",
            "customers",
            F.col("__rev").cast("double").alias("revenue"),
            "transactions",
        )
    )


def cohort_analysis(
    tx: DataFrame,
    max_hot_keys: int = MAX_HOT_KEYS,
    min_split_rows: int = MIN_SPLIT_ROWS,
    customers_base: DataFrame | None = None,
) -> DataFrame:
    """Cohort cells with cohort size and retention rate (decimal(5,2) percent).
    ``customers_base`` (:func:`laminar.plans.customer.customer_base`, pinned by the
    caller) gives the first purchases; without it a pinning job runs when this is called."""
    per_ts, first = _parts(tx, customers_base)
    cells = cohort_cells(tx, max_hot_keys, min_split_rows, _pre=(per_ts, first))
    sizes = cohort_sizes(first)
    return cells.join(F.broadcast(sizes), "cohort_month", "inner").withColumn(
        "retention_rate", retention_rate(F.col("customers"), F.col("cohort_size"))
    )
