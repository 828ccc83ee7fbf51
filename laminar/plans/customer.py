"""G1 customer analytics: A1 -> E1, E2 -> J1 -> E3, E4, E5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.functions import (
    churn_risk,
    days_since,
    lifetime_value,
    safe_mean,
    spend_tier,
    transaction_frequency,
)


def customer_base(tx: DataFrame) -> DataFrame:
    """Per-customer aggregates shared by A1 (customer summary) and A9 (RFM): count of
    transaction ids, exact sum and count of amounts, last and first date. A null
    customer id forms its own group."""
    return tx.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum("amount").alias("__sum"),
        F.count("amount").alias("__n"),
        F.max("transaction_date").alias("last_transaction_date"),
        F.min("transaction_date").alias("first_transaction_date"),
    )


def customer_summary(tx: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """A1 per customer: count of transaction ids, sum and mean amount, first and last date.

    The sum keeps the input's type until the final cast: totals of decimals do not depend
    on summation order, totals of cleaned amounts (doubles, C6) can in their last
    digits. ``base`` (from :func:`customer_base`) skips the aggregation.
    """
    agg = base if base is not None else customer_base(tx)
    return agg.select(
        "customer_id",
        "total_transactions",
        F.col("__sum").cast("double").alias("total_amount"),
        safe_mean(F.col("__sum"), F.col("__n")).alias("avg_transaction_amount"),
        "last_transaction_date",
        "first_transaction_date",
    )


def customer_segments(summary: DataFrame) -> DataFrame:
    """E1 spend tier and E2 frequency band."""
    return summary.withColumns(
        {
            "customer_segment": spend_tier(F.col("total_amount")),
            "transaction_frequency": transaction_frequency(F.col("total_transactions")),
        }
    )


def customer_analytics(
    customers: DataFrame | None,
    tx: DataFrame,
    as_of=None,
    base: DataFrame | None = None,
) -> DataFrame:
    """G1. With a customer master, every customer is kept (left join) and customers
    without transactions get 0 transactions and 0.0 amount; without one, the segments
    alone. ``as_of`` (date, ISO string or Column; default today) anchors E3.
    ``base`` (from :func:`customer_base`) reuses precomputed per-customer aggregates."""
    seg = customer_segments(customer_summary(tx, base))
    if customers is not None:
        out = customers.join(seg, "customer_id", "left").fillna(
            0, ["total_transactions", "total_amount"]
        )
    else:
        out = seg
    out = out.withColumn(
        "days_since_last_transaction", days_since(as_of, F.col("last_transaction_date"))
    )
    return out.withColumns(
        {
            "customer_lifetime_value": lifetime_value(
                F.col("total_amount"), F.col("customer_segment")
            ),
            "churn_risk": churn_risk(F.col("days_since_last_transaction")),
        }
    )
