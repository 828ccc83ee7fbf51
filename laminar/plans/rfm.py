"""G6 RFM segments: A8 -> A9 -> A10 -> E11 -> E12 -> E13.

The reference date (latest transaction) and the quintile cuts are scalar subqueries
inside the plan: nothing is collected to the driver before scoring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.functions import (
    higher_is_better_score,
    recency_score,
    rfm_code,
    rfm_segment,
)
from laminar.operators.quantiles import (
    DEFAULT_RELATIVE_ERROR,
    QUINTILES,
    cut_columns,
    cut_names,
    exact_cuts_many,
    kll_cuts,
    kll_sketches,
)

RFM_VALUES = ("recency", "frequency", "monetary")


def rfm_base(tx: DataFrame, customers_base: DataFrame | None = None) -> DataFrame:
    """A8 + A9 per customer: days from the latest transaction overall to the customer's
    latest, number of transaction ids, total amount.

    ``customers_base`` (from :func:`laminar.plans.customer.customer_base`) reuses the
    per-customer aggregates; the reference date is then the latest of the customers'
    last dates, which is the latest transaction date.
    """
    if customers_base is not None:
        agg = customers_base.select(
            "customer_id",
            F.col("last_transaction_date").alias("__last"),
            F.col("total_transactions").alias("frequency"),
            "__sum",
        )
        reference_date = customers_base.select(F.max("last_transaction_date")).scalar()
    else:
        agg = tx.groupBy("customer_id").agg(
            F.max("transaction_date").alias("__last"),
            F.count("transaction_id").alias("frequency"),
            F.sum("amount").alias("__sum"),
        )
        reference_date = tx.select(F.max("transaction_date")).scalar()
    return agg.select(
        "customer_id",
        F.datediff(reference_date, F.col("__last")).alias("recency"),
        "frequency",
        F.col("__sum").cast("double").alias("monetary"),
    )


def rfm_cuts(base: DataFrame, relative_error: float = DEFAULT_RELATIVE_ERROR) -> dict[str, DataFrame]:
    """A10 quintile cuts per measure, one single-row DataFrame each (all three come
    from one computation: a stacked ranking when ``relative_error`` is 0, otherwise
    one pass of three sketches)."""
    packed = _cut_row(base, relative_error)
    k = len(QUINTILES)
    return {
        v: packed.select(*packed.columns[i * k:(i + 1) * k]) for i, v in enumerate(RFM_VALUES)
    }


def _cut_row(base: DataFrame, relative_error: float) -> DataFrame:
    """One row of twelve cuts: exact (one stacked ranking) or approximate (sketches)."""
    if relative_error == 0:
        return exact_cuts_many(base, RFM_VALUES, ["customer_id"], QUINTILES)
    return _approx_cut_row(base, relative_error)


def _approx_cut_row(base: DataFrame, relative_error: float) -> DataFrame:
    """One aggregate pass computing the three sketches; one row of twelve cuts."""
    accuracy = max(1, int(round(1.0 / relative_error)))
    arrays = base.agg(
        *[
            F.percentile_approx(
                F.col(v).cast("double"), F.array(*[F.lit(p) for p in QUINTILES]), accuracy
            ).alias(v)
            for v in RFM_VALUES
        ]
    )
    return arrays.select(
        *[
            F.col(v)[i].alias(f"{v}_q{round(p * 100):02d}")
            for v in RFM_VALUES
            for i, p in enumerate(QUINTILES)
        ]
    )


def pin_base(base: DataFrame) -> DataFrame:
    """Exact cuts rank each measure separately: write the per-customer base once
    (reliable checkpoint in the shared folder) instead of recomputing it from the
    transactions for every ranking."""
    from laminar.session import shared_root

    shared_root(base.sparkSession)
    return base.checkpoint(eager=True)


def rfm_cut_table(base: DataFrame, relative_error: float = DEFAULT_RELATIVE_ERROR) -> DataFrame:
    """A10 as data: one row per (measure, probability, cut)."""
    if relative_error == 0:
        base = pin_base(base)
    cuts = rfm_cuts(base, relative_error)
    frames = []
    for v, df in cuts.items():
        frames.append(
            df.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(v).alias("measure"),
                                F.lit(float(p)).alias("probability"),
                                F.col(c).cast("double").alias("cut"),
                            )
                            for p, c in zip(QUINTILES, df.columns)
                        ]
                    )
                )
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# Fixed value: customers are sketched in so many groups by a hash of their id.
SKETCH_GROUPS = 64


def write_sketches(
    customers_base: DataFrame, path: str, groups: list[int] | None = None, n_groups: int = SKETCH_GROUPS
) -> None:
    """Store KLL sketches of the customers' last day, frequency and monetary value, one row
    per group of customers (``group=<n>`` folders; those of ``groups`` are replaced, default
    all). Last days, not recencies, are sketched: they do not move when the reference date
    does, so a load needs to sketch only the groups that its customers are in."""
    group = F.pmod(F.xxhash64("customer_id"), F.lit(n_groups)).cast("int")
    rows = customers_base.select(
        group.alias("group"),
        F.unix_date(F.col("last_transaction_date").cast("date")).alias("last_day"),
        F.col("total_transactions").alias("frequency"),
        F.col("__sum").alias("monetary"),
    )
    if groups is not None:
        rows = rows.where(F.col("group").isin(groups))
    made = kll_sketches(rows, ["last_day", "frequency", "monetary"], ["group"])
    made = made.withColumn("latest", _latest_day(customers_base))
    writer = made.coalesce(1).write.partitionBy("group").option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(path)


def _latest_day(customers_base: DataFrame):
    return customers_base.select(F.unix_date(F.max("last_transaction_date").cast("date"))).scalar()


def sketched_cuts(sketches: DataFrame) -> DataFrame:
    """The row of twelve cuts from stored sketches, merged. Recency cut p is the reference
    day less the last day's cut 1 - p."""
    mirrored = [round(1 - p, 10) for p in QUINTILES]
    days = kll_cuts(sketches, ["last_day"], mirrored)
    others = kll_cuts(sketches, ["frequency", "monetary"])
    latest = sketches.select(F.max("latest")).scalar()
    recency = [
        (latest - F.col(c)).alias(n) for c, n in zip(days.columns, cut_names("recency", QUINTILES))
    ]
    # both sides are one row of aggregates
    return days.select(*recency).join(others, how="cross")


def cut_ranks(base: DataFrame, cuts: DataFrame) -> DataFrame:
    """(measure, probability, customers, below, up_to): how many customers have a value below
    each cut and up to it: its true rank, in one pass over ``base``."""
    cols = cut_columns(cuts)
    told = [(v, p, cols[i * len(QUINTILES) + j]) for i, v in enumerate(RFM_VALUES) for j, p in enumerate(QUINTILES)]
    counts = base.agg(
        *[F.count_if(F.col(v) < c).alias(f"below_{i}") for i, (v, _, c) in enumerate(told)],
        *[F.count_if(F.col(v) <= c).alias(f"up_to_{i}") for i, (v, _, c) in enumerate(told)],
        *[F.count(v).alias(f"n_{v}") for v in RFM_VALUES],
    )
    rows = [
        F.struct(
            F.lit(v).alias("measure"), F.lit(float(p)).alias("probability"), F.col(f"n_{v}").alias("customers"),
            F.col(f"below_{i}").alias("below"), F.col(f"up_to_{i}").alias("up_to"),
        )
        for i, (v, p, _) in enumerate(told)
    ]
    return counts.select(F.inline(F.array(*rows)))


def rfm_segments(
    tx: DataFrame,
    relative_error: float = DEFAULT_RELATIVE_ERROR,
    recency_mode: str = "standard",
    customers_base: DataFrame | None = None,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Scores 1..5 from quintile cuts, the three-digit code and the segment.

    ``recency_mode="as_written"`` reproduces the published recency chain (see
    :func:`laminar.functions.scoring.recency_score`). ``customers_base`` reuses
    precomputed per-customer aggregates (see :func:`rfm_base`), ``cuts`` a row of cuts from
    stored sketches (see :func:`sketched_cuts`).
    """
    base = rfm_base(tx, customers_base)
    if cuts is None:
        if relative_error == 0:
            base = pin_base(base)
        cuts = _cut_row(base, relative_error)
    # one scalar subquery carrying all twelve cuts
    cols = cut_columns(cuts)
    k = len(QUINTILES)
    by_value = {v: cols[i * k:(i + 1) * k] for i, v in enumerate(RFM_VALUES)}
    r = recency_score(F.col("recency"), by_value["recency"], recency_mode)
    f = higher_is_better_score(F.col("frequency"), by_value["frequency"])
    m = higher_is_better_score(F.col("monetary"), by_value["monetary"])
    scored = base.withColumns({"r_score": r, "f_score": f, "m_score": m})
    return scored.withColumn(
        "rfm_score", rfm_code(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    ).withColumn(
        "customer_segment", rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    )
