"""G3 daily and G4 monthly metrics: A3 -> W3, A4 -> W4 -> E7.

The moving-average and lag windows are unpartitioned on purpose: they run over one
row per calendar day or month, a size bounded by the calendar, not by the data.
Moving averages are windowed sums of the daily sums divided by the number of present
days. Where amounts are decimals these sums are exact, whatever their order; cleaned
amounts (C6) are doubles, whose last digits can differ from run to run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.functions import growth_pct, month_key, safe_mean

# Moving-average widths in rows (present days, not calendar days).
SHORT_WINDOW_ROWS = 7
LONG_WINDOW_ROWS = 30


_MONTH, _SIDE, _DAY, _DAYS = "__month", "__side", "__day", "__days"


def daily_pairs(tx: DataFrame) -> DataFrame:
    """All that G3 and G4 need of the transactions, from one scan and one shuffle, summed per
    task before it. Three kinds of rows (``__side``): 0 the sums of a day; 1 a customer and 2 a
    product in a month, with the set of its days as bits (bit 0: transactions without a date).
    Ids travel once per month, without amounts, and months need no second grouping."""
    types = tx.schema
    day = F.to_date("transaction_date")
    none = lambda c: F.lit(None).cast(types[c].dataType).alias(c)
    no_day, bit = F.lit(None).cast("date").alias(_DAY), F.lit(1).cast("long")
    in_days = F.coalesce(F.call_function("shiftleft", bit, F.dayofmonth(day)), bit).alias(_DAYS)
    no_days = F.lit(0).cast("long").alias(_DAYS)
    ids = [none("transaction_id"), none("amount")]
    sides = F.array(
        F.struct(F.lit(0).alias(_SIDE), day.alias(_DAY), none("customer_id"), none("product_id"),
                 F.col("transaction_id"), F.col("amount"), no_days),
        F.struct(F.lit(1).alias(_SIDE), no_day, F.col("customer_id"), none("product_id"), *ids, in_days),
        F.struct(F.lit(2).alias(_SIDE), no_day, none("customer_id"), F.col("product_id"), *ids, in_days),
    )
    keyed = tx.select(F.trunc(day, "month").alias(_MONTH), F.inline(sides))
    return keyed.groupBy(_MONTH, _SIDE, _DAY, "customer_id", "product_id").agg(
        F.count("transaction_id").alias("__count"),
        F.sum("amount").alias("__sum"),
        F.count("amount").alias("__n"),
        F.bit_or(_DAYS).alias(_DAYS),
    )


def _by_day(pairs: DataFrame) -> DataFrame:
    """A row per day of each pair; a day's sums stay one row."""
    has = lambda d: F.getbit(F.col(_DAYS), d) == 1
    date = lambda d: F.when(d > 0, F.date_add(F.col(_MONTH), d - 1))
    in_days = F.transform(F.filter(F.sequence(F.lit(0), F.lit(31)), has), date)
    days = F.when(F.col(_SIDE) == 0, F.array(_DAY)).otherwise(in_days)
    return pairs.select(
        F.explode(days).alias(_DAY), _SIDE, "customer_id", "product_id", "__count", "__sum", "__n"
    )


def _period_aggregates(rows: DataFrame, period: Column, key_name: str, prefix: str) -> DataFrame:
    """Counts, sums and two distinct counts per period: every pair is one row, so that
    plain counts of the ids are distinct counts."""
    side = lambda k, c: F.when(F.col(_SIDE) == k, F.col(c))
    return rows.groupBy(period.alias(key_name)).agg(
        F.sum(side(0, "__count")).alias(f"{prefix}_transaction_count"),
        F.sum(side(0, "__sum")).alias("__sum"),
        F.sum(side(0, "__n")).alias("__n"),
        F.count(side(1, "customer_id")).alias(f"{prefix}_unique_customers"),
        F.count(side(2, "product_id")).alias(f"{prefix}_unique_products"),
    )


def daily_metrics(
    tx: DataFrame,
    short_rows: int = SHORT_WINDOW_ROWS,
    long_rows: int = LONG_WINDOW_ROWS,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Per calendar day, plus trailing averages over the last 7 and 30 present days.
    ``pairs`` (from :func:`daily_pairs`) skips the scan of the transactions."""
    days = _by_day(daily_pairs(tx) if pairs is None else pairs)
    daily = _period_aggregates(days, F.col(_DAY), "transaction_date", "daily")
    order = Window.orderBy("transaction_date")
    w_short = order.rowsBetween(-(short_rows - 1), Window.currentRow)
    w_long = order.rowsBetween(-(long_rows - 1), Window.currentRow)

    def moving(col, w):
        return safe_mean(F.sum(col).over(w), F.count(col).over(w))

    return daily.select(
        "transaction_date",
        "daily_transaction_count",
        F.col("__sum").cast("double").alias("daily_revenue"),
        safe_mean(F.col("__sum"), F.col("__n")).alias("daily_avg_transaction"),
        "daily_unique_customers",
        "daily_unique_products",
        moving("__sum", w_short).alias("revenue_7d_avg"),
        moving("__sum", w_long).alias("revenue_30d_avg"),
        moving("daily_transaction_count", w_short).alias("transaction_count_7d_avg"),
        moving("daily_transaction_count", w_long).alias("transaction_count_30d_avg"),
    )


def monthly_metrics(tx: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Per ``yyyy-MM``, with int year and month, previous present month's revenue
    and month-over-month growth in percent (first month: 0.0). ``pairs`` (from
    :func:`daily_pairs`) skips the scan of the transactions."""
    months = daily_pairs(tx) if pairs is None else pairs
    month = month_key(F.col(_MONTH))
    monthly = _period_aggregates(months, month, "year_month", "monthly").select(
        "year_month",
        "monthly_transaction_count",
        F.col("__sum").cast("double").alias("monthly_revenue"),
        safe_mean(F.col("__sum"), F.col("__n")).alias("monthly_avg_transaction"),
        "monthly_unique_customers",
        "monthly_unique_products",
        F.substring("year_month", 1, 4).cast("int").alias("year"),
        F.substring("year_month", 6, 2).cast("int").alias("month"),
    )
    prev = F.lag("monthly_revenue").over(Window.orderBy("year_month"))
    return monthly.withColumn("prev_month_revenue", prev).withColumn(
        "revenue_mom_growth", growth_pct(F.col("monthly_revenue"), F.col("prev_month_revenue"))
    )
