"""The next row of a table in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.llm.common import let


def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are <= value, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = len(bounds).bit_length()

    def search(b):
        def halve(a, _):
            mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
            right = (a["lo"] < a["hi"]) & (F.get(b, mid) <= value)
            return F.struct(
                F.when(right, mid + 1).otherwise(a["lo"]).alias("lo"),
                F.when(right | (a["lo"] >= a["hi"]), a["hi"]).otherwise(mid).alias("hi"),
            )

        start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
        return F.aggregate(F.array_repeat(F.lit(0), steps), start, halve, lambda a: a["lo"])

    return let(F.array(*[F.lit(x) for x in bounds]), search)


def with_next(df: DataFrame, order_col: str, payload: list[str], tie: str) -> DataFrame:
    """Each row's columns and, as ``next_<name>``, the ``payload`` of the next row in descending
    ``order_col`` (an integer column; nulls last), ties by ``tie``; the last row is followed
    by the first, a single row by itself.

    Rows are dealt to one bucket of ids per shuffle partition (bounds from a quantile
    sketch; two numbers a partition come to the driver). The first row of each bucket also
    goes, as a guest, to the bucket before it, and the very first row to the last bucket.
    So one shuffle and one sort give every row its neighbour. Null ids get places below all
    others, spread by the tie column.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    low = F.lit(-(2**63)) + F.shiftrightunsigned(F.xxhash64(tie), 2)
    df = df.withColumn("_place", F.coalesce(F.col(order_col).cast("long"), low))
    cuts = F.array(*[F.lit(i / n) for i in range(1, n)])
    bounds = []
    if n > 1:
        found = df.agg(F.percentile_approx("_place", cuts, F.lit(20 * n)).alias("b")).first()["b"]
        bounds = sorted(set(found or []))
    df = df.withColumn("_bucket", _bucket(F.col("_place"), bounds))
    tops = {
        r["_bucket"]: r["top"]
        for r in df.groupBy("_bucket").agg(F.max("_place").alias("top")).collect()
    }
    order = sorted(tops, reverse=True)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    size = len(bounds) + 1
    top_of = F.array(*[F.lit(tops.get(b)).cast("long") for b in range(size)])
    guest_of = F.array(*[F.lit(before.get(b)).cast("int") for b in range(size)])
    home = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(guest_of, F.col("_bucket")).alias("b"), F.lit(True).alias("guest"))
    dealt = df.withColumn(
        "_at",
        F.explode(
            F.when(F.get(top_of, F.col("_bucket")) == F.col("_place"), F.array(home, guest)).otherwise(
                F.array(home)
            )
        ),
    )
    w = Window.partitionBy("_at.b").orderBy(F.col("_at.guest"), F.col("_place").desc(), F.col(tie))
    for c in payload:
        dealt = dealt.withColumn(f"next_{c}", F.lead(c).over(w))
    return dealt.where(~F.col("_at.guest")).drop("_place", "_bucket", "_at")
