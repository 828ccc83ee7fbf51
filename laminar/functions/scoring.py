"""Scores and ratios (E7, E10, E11, E12) as CASE expressions.

Cut points arrive as Columns, usually scalar subqueries over a quantile plan, so the
scoring never needs the cuts on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

RECENCY_MODES = ("standard", "as_written")


def safe_mean(total: Column, count: Column) -> Column:
    """sum / count as double; an empty group gives null, not a division error."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def growth_pct(current: Column, previous: Column) -> Column:
    """E7 period-over-period growth in percent; no previous period gives 0, a zero
    previous value gives null."""
    cur = current.cast("double")
    prev = previous.cast("double")
    return F.when(prev.isNotNull(), F.try_divide(cur - prev, prev) * F.lit(100.0)).otherwise(
        F.lit(0.0)
    )


def retention_rate(customers: Column, cohort_size: Column) -> Column:
    """E10 share of the cohort, percent, decimal(5,2) rounded half-up."""
    return (customers / cohort_size * 100).cast("decimal(5,2)")


def higher_is_better_score(value: Column, cuts: Sequence[Column]) -> Column:
    """E11 for frequency and monetary: >= q80 -> 5, >= q60 -> 4, >= q40 -> 3, >= q20 -> 2, else 1."""
    q20, q40, q60, q80 = cuts
    return (
        F.when(value >= q80, 5)
        .when(value >= q60, 4)
        .when(value >= q40, 3)
        .when(value >= q20, 2)
        .otherwise(1)
    )


def recency_score(value: Column, cuts: Sequence[Column], mode: str = "standard") -> Column:
    """E11 for recency (fewer days is better).

    ``standard``: <= q20 -> 5, <= q40 -> 4, <= q60 -> 3, <= q80 -> 2, else 1.
    ``as_written``: the published chain, which scores upwards and reuses the first cut:
    <= q20 -> 1, (<= q20 -> 2, unreachable), <= q40 -> 3, <= q60 -> 4, else 5.
    A null recency takes the last branch in both modes.
    """
    q20, q40, q60, q80 = cuts
    if mode == "standard":
        return (
            F.when(value <= q20, 5)
            .when(value <= q40, 4)
            .when(value <= q60, 3)
            .when(value <= q80, 2)
            .otherwise(1)
        )
    if mode == "as_written":
        return (
            F.when(value <= q20, 1)
            .when(value <= q20, 2)
            .when(value <= q40, 3)
            .when(value <= q60, 4)
            .otherwise(5)
        )
    raise ValueError(f"recency mode must be one of {RECENCY_MODES}, got {mode!r}")


def rfm_code(r: Column, f: Column, m: Column) -> Column:
    """E12 three digits as a string."""
    return F.concat(r.cast("string"), f.cast("string"), m.cast("string"))
