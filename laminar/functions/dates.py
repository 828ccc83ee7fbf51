"""Date arithmetic (E3, E8, E9) on built-in functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the month key format of the monthly and cohort datasets.
MONTH_KEY_FORMAT = "yyyy-MM"


def as_date_column(as_of: _dt.date | str | Column | None) -> Column:
    """``as_of`` as a date column; ``None`` means today (the reference's behaviour)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def days_since(as_of: _dt.date | str | Column | None, last: Column) -> Column:
    """E3 whole days from ``last`` to ``as_of``."""
    return F.datediff(as_date_column(as_of), last)


def month_key(ts: Column) -> Column:
    """E8 ``yyyy-MM`` key."""
    return F.date_format(ts, MONTH_KEY_FORMAT)


def months_since(later: Column, first: Column) -> Column:
    """E9 Spark ``months_between`` truncated to int (whole months when days match)."""
    return F.months_between(later, first).cast("int")
