"""Silver- and bronze-shaped inputs derived from the TPC-H-like test tables.

The analytics layer expects a transactions table (transaction_id, customer_id,
product_id, quantity, amount, transaction_date) plus optional customer and product
masters. The test data has none of these, so they are projections of lineitem,
orders, customer and part. Amounts are exact decimals so that sums agree with any
SQL engine; the gold datasets cast to double at the end.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: scale that turns order prices into amounts spread over every spend tier.
AMOUNT_SCALE = "0.004"
# Fixed value: first day of the "recent" transactions variant (leaves customers unmatched).
RECENT_SINCE = _dt.datetime(2001, 1, 1)
# The skewed variant books every order of this status to one customer.
HOT_STATUS = "O"
HOT_CUSTOMER = 0
# Fixed value: orders of this priority arrive twice in the dirty bronze table.
DUPLICATED_PRIORITY = "1-URGENT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(
    spark: SparkSession,
    sf_dir: str,
    since: _dt.datetime | None = None,
    hot_customer: int | None = None,
) -> DataFrame:
    """lineitem joined with orders on the order key: one row per line item.

    ``hot_customer``: every open order (status 'O', a third of the line items) is
    booked to that one customer, to exercise a key holding a third of all rows.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount",
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"
    )
    if since is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(since))
    if hot_customer is not None:
        orders = orders.withColumn(
            "o_custkey",
            F.when(F.col("o_orderstatus") == HOT_STATUS, F.lit(hot_customer).cast("bigint"))
            .otherwise(F.col("o_custkey")),
        )
    tx = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    amount = (
        F.col("l_extendedprice").cast("decimal(12,2)")
        * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
        * F.lit(AMOUNT_SCALE).cast("decimal(4,3)")
    )
    return tx.select(
        F.concat_ws(
            "-",
            F.col("l_orderkey").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            F.col("l_linenumber").cast("string"),
        ).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        amount.alias("amount"),
        F.col("o_orderdate").alias("transaction_date"),
    )


def recent_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant with only the latest orders, so some customers and products go unmatched."""
    return transactions(spark, sf_dir, since=RECENT_SINCE)


def hot_customer_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skewed variant: one customer holds a third of all transactions."""
    return transactions(spark, sf_dir, hot_customer=HOT_CUSTOMER)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").alias("balance"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("list_price"),
    )


def dirty_bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-looking orders: string-typed dates and amounts, bad values, null keys, mixed
    column names, and the urgent orders landed twice. The dirt is injected by fixed
    rules on the order key; every order is present."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ts_text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    date_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    price_text = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    email_text = F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("@example.com"))
    dirty = o.select(
        F.when(k % 97 == 0, F.lit(None).cast("bigint")).otherwise(k).alias("id"),
        F.when(k % 89 == 0, F.lit("bad"))
        .when(k % 83 == 0, date_text)
        .otherwise(ts_text)
        .alias("Transaction_Date"),
        F.when(k % 79 == 0, F.lit("n/a"))
        .when(k % 73 == 0, F.lit(None).cast("string"))
        .otherwise(price_text)
        .alias("Amount"),
        F.when(k % 71 == 0, F.lit("not-an-email"))
        .when(k % 67 == 0, F.lit(None).cast("string"))
        .otherwise(email_text)
        .alias("email"),
        F.col("o_orderstatus").alias("Order-Status"),
        F.col("o_orderpriority").alias("Order Priority"),
        k.alias("__k"),
    )
    # urgent orders were sent twice by the source: exact duplicate rows
    again = dirty.where(F.col("Order Priority") == DUPLICATED_PRIORITY)
    return dirty.unionByName(again).drop("__k")
