"""Joins that split hot keys.

A lookup join (a large table against one row per key) sends all rows of a key to one
task. When one key holds a large share of the rows, that task holds it all. Here a
key is *hot* when its row count exceeds ``total / max_hot_keys`` (and
``min_split_rows``); each hot key is split into ``ceil(count / threshold)`` salts:
the large side spreads the key's rows over the salts by a hash, the small side
repeats the key's row once per salt, and the join runs on (key, salt).

At most ``max_hot_keys`` keys can exceed ``total / max_hot_keys``, so the hot-key
table is bounded by that parameter, not by the data; it is broadcast. The threshold
is a scalar subquery, so the plan stays lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Split keys holding more than 1/100,000 of the rows (so a salt piece
# never exceeds that share; the hot-key table stays under 100,000 rows, about 1-2 MB
# to broadcast), and never keys below 1000 rows.
MAX_HOT_KEYS = 100_000
MIN_SPLIT_ROWS = 1000

_SALTS = "__salts"
_SALT = "__salt"


def hot_keys(
    small: DataFrame,
    key: str,
    count_col: str,
    max_hot_keys: int = MAX_HOT_KEYS,
    min_split_rows: int = MIN_SPLIT_ROWS,
) -> DataFrame:
    """(key, number of salts) for keys whose ``count_col`` exceeds the threshold."""
    total = small.select(F.sum(count_col)).scalar()
    threshold = F.greatest(
        F.lit(min_split_rows).cast("long"), F.ceil(total / F.lit(max_hot_keys)).cast("long")
    )
    return small.where(F.col(count_col) > threshold).select(
        key, F.ceil(F.col(count_col) / threshold).cast("int").alias(_SALTS)
    )


def split_hot_key_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    count_col: str,
    spread_by: Column,
    max_hot_keys: int = MAX_HOT_KEYS,
    min_split_rows: int = MIN_SPLIT_ROWS,
) -> DataFrame:
    """Inner join of ``big`` with ``small`` (one row per ``key``, whose ``count_col``
    counts the rows of ``big`` with that key), splitting hot keys over salts.

    ``spread_by`` is a column of ``big`` that varies within a key (it picks the salt).
    The result has the columns of both sides (``count_col`` included), like
    ``big.join(small, key)``.
    """
    hot = F.broadcast(hot_keys(small, key, count_col, max_hot_keys, min_split_rows))
    big_s = big.join(hot, key, "left").withColumn(
        _SALT,
        F.when(F.col(_SALTS).isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(spread_by), F.col(_SALTS).cast("long")).cast("int")
        ),
    ).drop(_SALTS)
    small_s = small.join(hot, key, "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))
    ).drop(_SALTS)
    return big_s.join(small_s, [key, _SALT], "inner").drop(_SALT)
