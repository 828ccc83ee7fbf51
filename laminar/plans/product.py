"""G2 product analytics: A2 -> W1, W2 -> E6 -> J2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.functions import performance_category, safe_mean
from laminar.operators.ranking import global_rank


def product_summary(tx: DataFrame) -> DataFrame:
    """A2 per product: sales, quantity, revenue, mean sale, distinct customers."""
    agg = tx.groupBy("product_id").agg(
        F.count("transaction_id").alias("total_sales"),
        F.sum("quantity").alias("__qty"),
        F.sum("amount").alias("__sum"),
        F.count("amount").alias("__n"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    return agg.select(
        "product_id",
        "total_sales",
        F.col("__qty").cast("double").alias("total_quantity_sold"),
        F.col("__sum").cast("double").alias("total_revenue"),
        safe_mean(F.col("__sum"), F.col("__n")).alias("avg_sale_amount"),
        "unique_customers",
    )


def rank_products(
    summary: DataFrame,
    by: str = "total_revenue",
    n_partitions: int | None = None,
    rank_col: str = "revenue_rank",
    percentile_col: str = "revenue_percentile",
) -> DataFrame:
    """W1 row number and W2 percent rank x 100, best first; ties in the row number
    are broken by product id. Distributed: no step holds all products in one task."""
    ranked = global_rank(
        summary, by, ["product_id"], descending=True, n_partitions=n_partitions,
        row_number_col=rank_col, rank_col=None, percent_rank_col="__pr",
    )
    return ranked.withColumn(percentile_col, F.col("__pr") * 100).drop("__pr")


def product_performance(summary: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """W1, W2 then E6 (percentile measured from the best seller, as published)."""
    ranked = rank_products(summary, n_partitions=n_partitions)
    return ranked.withColumn(
        "performance_category", performance_category(F.col("revenue_percentile"))
    )


def product_analytics(
    products: DataFrame | None,
    tx: DataFrame,
    n_partitions: int | None = None,
) -> DataFrame:
    """G2. With a product master, unsold products are kept with 0 sales and 0.0
    revenue (rank, percentile and category stay null)."""
    perf = product_performance(product_summary(tx), n_partitions)
    if products is None:
        return perf
    return products.join(perf, "product_id", "left").fillna(0, ["total_sales", "total_revenue"])
