"""Global ranking without a single-partition window and with one shuffle of the ranked rows.

``row_number()`` / ``rank()`` / ``percent_rank()`` over an unpartitioned window send
every row to one task. Here the rows are dealt to buckets by ranges of the full sort key
(value plus a unique tie-breaker, so one hot value still spreads over many buckets),
ranked inside each bucket, and shifted by per-bucket offsets.

The borders are every ``PER_BUCKET``-th row of a sample: the rows whose tie-breakers have
the smallest hashes, so that the same rows always give the same borders. They are one row
with an array of at most ``MAX_BUCKETS`` keys, looked up by binary search. The number of
buckets follows the number of ranked rows. Rows go to the partition of their bucket
(``repartitionById``), which is also the window's partitioning: no second exchange.

The offsets come from a statistics table with one row per bucket, counted where the rows
lie, before the shuffle. Its size is bounded by the bucket count (not by the data), which
is what makes the broadcast of it safe. No value travels through the driver.

The sample, the statistics and the rows must come from the same input, which may hold
sums whose last digits differ between executions. It is therefore written once with a
reliable ``checkpoint()`` to the shared checkpoint folder. This costs one write of the
rows and runs when the function is called.

Ties: a group of equal values may span several buckets. The rank of a value that is a
border's is one more than the rows before it: those of the buckets before the first one
that it is the border of, and the smaller ones of that bucket, which the statistics count.

:func:`global_row_number` is the variant without ties (exact quantiles): one range shuffle,
the in-partition index from ``monotonically_increasing_id``, the ranged rows pinned.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID = "__rk_pid"
_LRN = "__rk_local_rn"
_LRK = "__rk_local_rank"

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4_096
PER_BUCKET = 32  # sampled rows for each bucket


def _sort_key(value: str, descending: bool, tie_breakers: Sequence[str]) -> list[Column]:
    head = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    return [head] + [F.col(c).asc_nulls_last() for c in tie_breakers]


def buckets_for(rows: int) -> int:
    """Buckets for so many ranked rows."""
    return max(1, min(MAX_BUCKETS, math.ceil(rows / ROWS_PER_BUCKET)))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _before(a: Column, b: Column, descending: bool) -> Column:
    """a comes before b in the order of values, nulls last."""
    first = a > b if descending else a < b
    return a.isNotNull() & (b.isNull() | F.coalesce(first, F.lit(False)))


def _ties(get, n: int) -> Column:
    """Tie-breakers as one comparable value, nulls last."""
    parts = [c for i in range(n) for c in (get(i).isNull(), get(i))]
    return F.struct(*[c.alias(f"t{i}") for i, c in enumerate(parts)])


def _borders(rows: DataFrame, key: Column, order: list[Column], tie_breakers, buckets: int) -> DataFrame:
    """One row, one array: the last keys of all buckets but the last."""
    sample = rows.orderBy(F.xxhash64(*tie_breakers), *order).limit(PER_BUCKET * buckets)
    nth = sample.select(key.alias("key"), F.row_number().over(Window.orderBy(*order)).alias("nth"))
    every = nth.where((F.col("nth") % PER_BUCKET == 0) & (F.col("nth") < PER_BUCKET * buckets))
    found = every.agg(F.sort_array(F.collect_list(F.struct("nth", "key"))).alias("b"))
    return found.select(F.array_distinct(F.transform("b", lambda x: x["key"])).alias("borders")).checkpoint()


def _bucket(borders: Column, passed) -> Column:
    """How many borders the row has passed (``passed(border)``: it comes after), by binary search."""

    def search(b):
        def halve(a, _):
            mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
            right = (a["lo"] < a["hi"]) & passed(F.get(b, mid))
            return F.struct(
                F.when(right, mid + 1).otherwise(a["lo"]).alias("lo"),
                F.when(right | (a["lo"] >= a["hi"]), a["hi"]).otherwise(mid).alias("hi"),
            )

        steps = F.array_repeat(F.lit(0), MAX_BUCKETS.bit_length())
        start = F.struct(F.lit(0).alias("lo"), F.size(b).alias("hi"))
        return F.aggregate(steps, start, halve, lambda a: a["lo"])

    return _let(borders, search)


def _bucket_stats(dealt: DataFrame, value: str, borders: Column, descending: bool) -> DataFrame:
    """One row per non-empty bucket: rows before it, rows of all, the value of the border
    before it and that value's global rank."""
    by_pid = Window.orderBy(_PID)
    border = F.get(borders, F.col(_PID))["v"]
    stats = (
        dealt.groupBy(_PID)
        .agg(
            F.count(F.lit(1)).alias("__cnt"),
            F.count_if(_before(F.col(value), border, descending)).alias("__cnt_before"),
        )
        .withColumn("__border", border)
        .withColumn(
            "__offset",
            F.coalesce(
                F.sum("__cnt").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .withColumn("__total", F.sum("__cnt").over(Window.partitionBy()))
    )
    first_of = Window.partitionBy("__border").orderBy(_PID).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    stats = stats.withColumn(
        "__rank", F.min(F.col("__offset") + F.col("__cnt_before") + 1).over(first_of)
    )
    return stats.select(
        _PID,
        "__offset",
        "__total",
        F.lag("__border").over(by_pid).alias("__border"),
        F.lag("__rank").over(by_pid).alias("__carry"),
    )


def global_rank(
    df: DataFrame,
    value: str,
    tie_breakers: Sequence[str],
    descending: bool = True,
    n_partitions: int | None = None,
    row_number_col: str | None = "row_number",
    rank_col: str | None = "rank",
    percent_rank_col: str | None = "percent_rank",
    count_col: str | None = None,
) -> DataFrame:
    """Add global ``row_number`` / ``rank`` / ``percent_rank`` ordered by ``value``.

    Equivalent to the same functions over ``Window.orderBy(value desc nulls last,
    *tie_breakers)`` (ranks only look at ``value``), without a single-partition step;
    numbers and ranks are longs. ``tie_breakers`` must make the order total (a unique key)
    for a deterministic row number. ``n_partitions``: the number of buckets, by default
    from the number of rows.
    """
    from laminar.session import shared_root

    shared_root(df.sparkSession)
    rows = df.checkpoint(eager=True)
    order = _sort_key(value, descending, tie_breakers)
    ties = _ties(lambda i: F.col(tie_breakers[i]), len(tie_breakers))
    buckets = min(MAX_BUCKETS, n_partitions) if n_partitions else buckets_for(rows.count())
    key = F.struct(F.col(value).alias("v"), ties.alias("t"))
    borders = _borders(rows, key, order, tie_breakers, buckets).scalar()

    def passed(b: Column) -> Column:
        same = F.col(value).eqNullSafe(b["v"]) & (b["t"] < ties)
        return _before(b["v"], F.col(value), descending) | same

    # higher-order functions take a column, not a subquery
    dealt = rows.withColumn("__borders", borders)
    dealt = dealt.withColumn(_PID, _bucket(F.col("__borders"), passed) if buckets > 1 else F.lit(0))
    dealt = dealt.drop("__borders")
    stats = _bucket_stats(dealt, value, borders, descending)
    in_part = Window.partitionBy(_PID).orderBy(*order)
    # rank looks at the value only; its sort is a prefix of the row-number sort
    in_part_value = Window.partitionBy(_PID).orderBy(order[0])
    local = (
        dealt.repartitionById(buckets, F.col(_PID))
        .withColumn(_LRN, F.row_number().over(in_part))
        .withColumn(_LRK, F.rank().over(in_part_value))
    )
    joined = local.join(F.broadcast(stats), _PID, "inner")

    rank = F.when(
        F.col("__carry").isNotNull() & F.col(value).eqNullSafe(F.col("__border")),
        F.col("__carry"),
    ).otherwise(F.col("__offset") + F.col(_LRK))
    out = joined
    if row_number_col:
        out = out.withColumn(row_number_col, F.col("__offset") + F.col(_LRN))
    rank_tmp = rank_col or "__rk_rank"
    out = out.withColumn(rank_tmp, rank)
    if percent_rank_col:
        out = out.withColumn(
            percent_rank_col,
            F.when(
                F.col("__total") > 1,
                (F.col(rank_tmp) - 1).cast("double") / (F.col("__total") - 1).cast("double"),
            ).otherwise(F.lit(0.0)),
        )
    if count_col:
        out = out.withColumn(count_col, F.col("__total"))
    drop = [_PID, _LRN, _LRK, "__offset", "__total", "__border", "__carry"]
    if not rank_col:
        drop.append(rank_tmp)
    return out.drop(*drop)


def global_row_number(
    df: DataFrame,
    order: Sequence[Column],
    n_partitions: int | None = None,
    row_number_col: str = "row_number",
    count_col: str | None = None,
) -> DataFrame:
    """Global 1-based row number in ``order`` (which must be total), one shuffle.

    Cheaper than :func:`global_rank` when ties do not matter: after range
    partitioning and a sort inside each partition, ``monotonically_increasing_id``
    holds the row index within the partition in its low 33 bits, so no second
    exchange or window is needed. Range bounds come from a sample that two executions may
    draw differently, so the partitions are pinned. Without ``n_partitions`` the rows are
    counted first.
    """
    from laminar.session import shared_root

    if n_partitions is None:
        n_partitions = buckets_for(df.count())

    local = (
        df.repartitionByRange(n_partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(
            _LRN,
            F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33) + 1,
        )
    )
    shared_root(df.sparkSession)
    local = local.checkpoint(eager=True)
    by_pid = Window.orderBy(_PID)
    stats = (
        local.groupBy(_PID)
        .agg(F.count(F.lit(1)).alias("__cnt"))
        .withColumn(
            "__offset",
            F.coalesce(
                F.sum("__cnt").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .withColumn("__total", F.sum("__cnt").over(Window.partitionBy()))
        .select(_PID, "__offset", "__total")
    )
    out = local.join(F.broadcast(stats), _PID, "inner").withColumn(
        row_number_col, F.col("__offset") + F.col(_LRN)
    )
    if count_col:
        out = out.withColumn(count_col, F.col("__total"))
    return out.drop(_PID, _LRN, "__offset", "__total")
