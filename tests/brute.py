"""Brute-force references for tests: the plain unpartitioned windows (one task)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laminar.operators.ranking import _sort_key


def window_rank(
    df: DataFrame,
    value: str,
    tie_breakers: Sequence[str],
    descending: bool = True,
    row_number_col: str | None = "row_number",
    rank_col: str | None = "rank",
    percent_rank_col: str | None = "percent_rank",
) -> DataFrame:
    """The plain unpartitioned window (one task): the check for ``global_rank``."""
    order = _sort_key(value, descending, tie_breakers)
    w = Window.orderBy(*order)
    w_rank = Window.orderBy(order[0])
    out = df
    if row_number_col:
        out = out.withColumn(row_number_col, F.row_number().over(w))
    if rank_col:
        out = out.withColumn(rank_col, F.rank().over(w_rank))
    if percent_rank_col:
        out = out.withColumn(percent_rank_col, F.percent_rank().over(w_rank))
    return out
