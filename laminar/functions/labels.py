"""Threshold labels for the gold datasets.

Every label is a single CASE expression, so it stays inside whole-stage codegen.
Thresholds are parameters; the defaults below are the published ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spend tiers on total amount (greater or equal), first match wins.
SPEND_TIERS = ((10000, "Premium"), (5000, "Gold"), (1000, "Silver"))
SPEND_TIER_OTHERWISE = "Bronze"

# Frequency bands on transaction count (greater or equal).
FREQUENCY_BANDS = ((50, "High"), (20, "Medium"))
FREQUENCY_OTHERWISE = "Low"

# Lifetime-value multiplier per spend tier.
LIFETIME_MULTIPLIERS = (("Premium", 1.5), ("Gold", 1.3), ("Silver", 1.1))
LIFETIME_OTHERWISE = 1.0

# Churn bands on days since last transaction (strictly greater).
CHURN_BANDS = ((90, "High"), (30, "Medium"))
CHURN_OTHERWISE = "Low"

# Performance bands on revenue percentile (greater or equal).
PERFORMANCE_BANDS = (
    (80, "Top Performer"),
    (60, "Good Performer"),
    (40, "Average Performer"),
    (20, "Below Average"),
)
PERFORMANCE_OTHERWISE = "Poor Performer"

# RFM segment names.
SEGMENT_CHAMPIONS = "Champions"
SEGMENT_LOYAL = "Loyal Customers"
SEGMENT_NEW = "New Customers"
SEGMENT_AT_RISK = "At Risk"
SEGMENT_CANNOT_LOSE = "Cannot Lose Them"
SEGMENT_LOST = "Lost Customers"
SEGMENT_OTHERS = "Others"


def threshold_label(
    value: Column,
    bands: Sequence[tuple[float, str]],
    otherwise: str,
    strict: bool = False,
) -> Column:
    """First band whose threshold the value reaches (``>``, or ``>=`` when not strict)."""
    expr = None
    for threshold, label in bands:
        cond = value > threshold if strict else value >= threshold
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(otherwise) if expr is None else expr.otherwise(otherwise)


def spend_tier(total_amount: Column, bands=SPEND_TIERS, otherwise=SPEND_TIER_OTHERWISE) -> Column:
    """E1 customer segment."""
    return threshold_label(total_amount, bands, otherwise)


def transaction_frequency(
    total_transactions: Column, bands=FREQUENCY_BANDS, otherwise=FREQUENCY_OTHERWISE
) -> Column:
    """E2 frequency band."""
    return threshold_label(total_transactions, bands, otherwise)


def lifetime_value(
    total_amount: Column,
    segment: Column,
    multipliers=LIFETIME_MULTIPLIERS,
    otherwise: float = LIFETIME_OTHERWISE,
) -> Column:
    """E4 total amount scaled by the segment's multiplier (unknown segment: 1.0)."""
    factor = None
    for name, mult in multipliers:
        cond = segment == name
        factor = F.when(cond, F.lit(mult)) if factor is None else factor.when(cond, F.lit(mult))
    factor = F.lit(otherwise) if factor is None else factor.otherwise(F.lit(otherwise))
    return total_amount * factor


def churn_risk(days_since_last: Column, bands=CHURN_BANDS, otherwise=CHURN_OTHERWISE) -> Column:
    """E5: a null day count (no transactions) falls through to the last label."""
    return threshold_label(days_since_last, bands, otherwise, strict=True)


def performance_category(
    percentile: Column, bands=PERFORMANCE_BANDS, otherwise=PERFORMANCE_OTHERWISE
) -> Column:
    """E6 performance category from the revenue percentile."""
    return threshold_label(percentile, bands, otherwise)


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """First matching rule wins."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), SEGMENT_CHAMPIONS)
        .when((r >= 3) & (f >= 3) & (m >= 3), SEGMENT_LOYAL)
        .when((r >= 4) & (f <= 2), SEGMENT_NEW)
        .when((r <= 2) & (f >= 3) & (m >= 3), SEGMENT_AT_RISK)
        .when((r <= 2) & (f <= 2) & (m >= 3), SEGMENT_CANNOT_LOSE)
        .when((r <= 2) & (f <= 2) & (m <= 2), SEGMENT_LOST)
        .otherwise(SEGMENT_OTHERS)
    )
