"""End-to-end layer runs: bronze -> silver (cleaning, lineage) and silver -> gold.

``run_layers`` is the plain-function form of the scheduled flow: clean every bronze
table, gate on data quality, build the six gold datasets from the silver
transactions, write the job summary, and gate the gold keys. Each dataset is one
Spark job writing straight to its folder (independent ones run concurrently); the
only values on the driver are row counts and rule verdicts.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from laminar.operators import quality
from laminar.operators.cleaning import KEY_COLUMN, ObservedCleaning
from laminar.operators.quantiles import DEFAULT_RELATIVE_ERROR
from laminar.plans import cohort, customer, product, rfm, timeseries
from laminar.sources import layers, snapshots

# Gold dataset names, in build order.
GOLD_DATASETS = (
    "customer_analytics",
    "product_analytics",
    "daily_metrics",
    "monthly_metrics",
    "cohort_analysis",
    "rfm_customer_segments",
)
JOB_SUMMARY = "job_summary"

# The key each gold dataset must have complete and unique.
GOLD_KEYS = {
    "customer_analytics": "customer_id",
    "product_analytics": "product_id",
    "daily_metrics": "transaction_date",
    "monthly_metrics": "year_month",
    "cohort_analysis": ("cohort_month", "months_since_first_purchase"),
    "rfm_customer_segments": "customer_id",
}

log = logging.getLogger("laminar")


@contextmanager
def scheduler_pool(spark: SparkSession, pool: str):
    """Run this thread's jobs in their own FAIR scheduler pool, then restore."""
    sc = spark.sparkContext
    previous = sc.getLocalProperty("spark.scheduler.pool")
    sc.setLocalProperty("spark.scheduler.pool", pool)
    try:
        yield
    finally:
        sc.setLocalProperty("spark.scheduler.pool", previous)


def run_partition(df: DataFrame, run_date: _dt.date | None = None):
    """Predicate selecting the partition a run wrote (``load_*`` columns when the
    dataset keeps its own year/month); pruned at the scan."""
    day = F.lit(run_date) if run_date is not None else F.current_date()
    names = layers.gold_partition_columns(df)
    return (
        (F.col(names[0]) == F.year(day))
        & (F.col(names[1]) == F.month(day))
        & (F.col(names[2]) == F.dayofmonth(day))
    )


def silver_name(bronze_table: str) -> str:
    """``silver_`` + the name with every ``bronze_`` removed (the published rule)."""
    return f"silver_{bronze_table.replace('bronze_', '')}"


# Role binding by name substring, checked in this order per table.
ROLE_SUBSTRINGS = (("customers", "customer"), ("transactions", "transaction"), ("products", "product"))


def bind_roles(table_names) -> dict[str, str]:
    """The published binding of silver tables to roles: for each table in order, the
    first role whose word occurs in the lower-cased name; a later table of the same
    role replaces an earlier one. (A name like ``customer_transactions`` binds as
    customers; explicit names avoid that.)"""
    roles: dict[str, str] = {}
    for name in table_names:
        low = name.lower()
        for role, word in ROLE_SUBSTRINGS:
            if word in low:
                roles[role] = name
                break
    return roles


def clean_to_silver(
    bronze: DataFrame,
    silver_root: str,
    table_name: str,
    job_name: str,
    lineage_path: str | None = None,
    run_ts: _dt.datetime | None = None,
    run_date: _dt.date | None = None,
    key: str = KEY_COLUMN,
    mode: str = "overwrite",
    check: Callable[[DataFrame], None] | None = None,
    versioned: bool = False,
) -> dict:
    """Clean one bronze table into silver; counts are observed during the single
    write, then one lineage row is appended.

    The batch job reads the whole bronze table, so it replaces the whole silver table
    (``mode="overwrite"``), on the same or any later date: a re-run or a retried job
    gives the same silver table instead of a second copy. The new table is written
    beside the old one and takes its place when it is complete and ``check`` (called
    with the new rows) has not raised; until then the old one stays. ``versioned`` publishes
    it as the next version of a versioned table (:mod:`laminar.sources.snapshots`), which
    moves no data and survives a stop at any point; its row count is that of the files. New
    files only, appended run after run, is the streaming loader's job
    (:mod:`laminar.streaming.incremental`).
    """
    timer = layers.Timer()
    target = silver_name(table_name)
    observed = ObservedCleaning(bronze, run_ts, run_date, key)
    spark, path = bronze.sparkSession, f"{silver_root.rstrip('/')}/{target}"
    rows = None
    if versioned:
        entry = snapshots.stage(observed.frame, path, layers.PARTITION_COLUMNS)
        rows = entry["rows"]
        try:
            if check is not None:
                check(snapshots.staged_rows(spark, path, entry))
        except Exception:
            snapshots.discard(spark, path, entry)
            raise
        replace = "all" if mode == "overwrite" else "none"
        snapshots.commit(spark, path, entry, replace, info={"job": job_name})
        snapshots.vacuum(spark, path)
    elif mode == "overwrite":
        layers.recover(spark, path)
        staging = layers.staging_path(path)
        try:
            layers.write_layer(observed.frame, staging, mode="errorifexists")
            if check is not None:
                schema = spark.createDataFrame([], observed.frame.schema).schema
                check(spark.read.schema(schema).parquet(staging))
            layers.publish(spark, staging, path)
        finally:
            layers.remove_folder(spark, staging)
    else:
        layers.write_layer(observed.frame, path, mode=mode)
    report = observed.report()
    if rows is not None:
        report["output_rows"] = rows
    report.update({"source_table": table_name, "target_table": target})
    log.info("cleaned %s -> %s: %s", table_name, target, report)
    if lineage_path:
        layers.append_lineage(
            layers.lineage_record(
                spark, job_name, table_name, target, report["output_rows"], timer.seconds()
            ),
            lineage_path,
        )
    return report


def clean_and_gate(
    bronze: DataFrame,
    silver_root: str,
    table_name: str,
    job_name: str,
    lineage_path: str | None = None,
    run_date: _dt.date | None = None,
    key: str = KEY_COLUMN,
    rules: tuple | None = None,
    gate: bool = True,
    versioned: bool = False,
) -> dict:
    """Clean one bronze table into silver (its own FAIR pool); the ruleset is evaluated
    on the new rows before they replace the table. A failed rule raises when ``gate``, and
    the table stays as it was."""
    verdicts: list = []

    def check(silver: DataFrame) -> None:
        results = quality.evaluate_ruleset(
            silver, rules if rules is not None else default_rules(silver, key)
        )
        verdicts.extend(
            quality.quality_gate(results) if gate else [r.asDict() for r in results.collect()]
        )

    with scheduler_pool(bronze.sparkSession, f"clean_{table_name}"):
        report = clean_to_silver(
            bronze, silver_root, table_name, job_name, lineage_path, run_date=run_date, key=key,
            check=check, versioned=versioned,
        )
    log.info("quality %s: %s", report["target_table"], verdicts)
    report["quality"] = verdicts
    return report


def gold_builders(
    tx: DataFrame,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    as_of=None,
    relative_error: float = DEFAULT_RELATIVE_ERROR,
    customers_base: DataFrame | None = None,
    pairs: DataFrame | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """The six gold datasets (G1-G6), each as a function building its DataFrame (some
    run a pinning job while they are built, see :mod:`laminar.operators.ranking`).

    ``customers_base`` (per-customer aggregates, see
    :func:`laminar.plans.customer.customer_base`) is shared by G1, G5 and G6, ``pairs``
    (see :func:`laminar.plans.timeseries.daily_pairs`) by G3 and G4.
    """
    return {
        "customer_analytics": lambda: customer.customer_analytics(
            customers, tx, as_of=as_of, base=customers_base
        ),
        "product_analytics": lambda: product.product_analytics(products, tx),
        "daily_metrics": lambda: timeseries.daily_metrics(tx, pairs=pairs),
        "monthly_metrics": lambda: timeseries.monthly_metrics(tx, pairs=pairs),
        "cohort_analysis": lambda: cohort.cohort_analysis(tx, customers_base=customers_base),
        "rfm_customer_segments": lambda: rfm.rfm_segments(
            tx, relative_error=relative_error, customers_base=customers_base
        ),
    }


def gold_frames(
    tx: DataFrame,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    as_of=None,
    relative_error: float = DEFAULT_RELATIVE_ERROR,
) -> dict[str, DataFrame]:
    """The six gold datasets as DataFrames."""
    return {
        name: build()
        for name, build in gold_builders(tx, customers, products, as_of, relative_error).items()
    }


def job_summary(
    spark: SparkSession,
    counts: dict[str, int],
    job_name: str = "silver_to_gold",
    processing_time: float | None = None,
    run_ts: _dt.datetime | None = None,
) -> DataFrame:
    """A row per dataset with the row count observed while it was written, zero for
    an empty one."""
    rows = spark.createDataFrame(list(counts.items()), "dataset_name string, record_count long")
    return rows.withColumns(
        {
            "job_name": F.lit(job_name),
            "processing_time_seconds": F.lit(processing_time).cast("double"),
            "created_timestamp": F.lit(run_ts) if run_ts is not None else F.current_timestamp(),
        }
    )


def build_gold(
    tx: DataFrame,
    gold_root: str,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    job_name: str = "silver_to_gold",
    as_of=None,
    run_ts: _dt.datetime | None = None,
    run_date: _dt.date | None = None,
    relative_error: float = DEFAULT_RELATIVE_ERROR,
    parallel: int = 3,
    gate: bool = False,
) -> dict[str, int]:
    """Write G1-G6 and the G7 summary; returns the observed row count per dataset.

    The six datasets are independent Spark jobs; up to ``parallel`` of them are
    submitted at once from driver threads, so the small serial stages of one job
    overlap with the wide stages of another (use the FAIR scheduler, as
    :func:`laminar.session.build_session` does).
    """
    timer = layers.Timer()
    # What several datasets need of the transactions is aggregated once and pinned in the
    # shared folder: a row per customer (G1, G5, G6), and the (month, customer) and (month,
    # product) pairs (G3, G4). The pairs can be as many as the transactions: they are Parquet,
    # a fraction of a checkpoint's bytes, and go at the end. With G2 and the join of G5 the
    # transactions are read four times in all.
    from laminar.session import fresh_dir

    pinned = fresh_dir(tx.sparkSession, "gold-pairs")
    base = customer.customer_base(tx).checkpoint(eager=True)
    try:
        timeseries.daily_pairs(tx).write.parquet(pinned)
        pairs = tx.sparkSession.read.parquet(pinned)
        builders = gold_builders(tx, customers, products, as_of, relative_error, base, pairs)
        counts = _write_datasets(tx.sparkSession, builders, gold_root, run_ts, run_date, parallel)
    finally:
        layers.remove_folder(tx.sparkSession, pinned)
    summary = job_summary(tx.sparkSession, counts, job_name, timer.seconds(), run_ts)
    layers.write_gold(summary, gold_root, JOB_SUMMARY, run_ts, run_date)
    if gate:
        for name in (n for n in counts if counts[n]):  # an empty one has no key to check
            df = tx.sparkSession.read.parquet(f"{gold_root.rstrip('/')}/{name}")
            df = df.where(run_partition(df, run_date))  # this run's rows
            verdicts = quality.quality_gate(
                quality.evaluate_ruleset(df, default_rules(df, GOLD_KEYS.get(name, KEY_COLUMN)))
            )
            log.info("quality gold %s: %s", name, verdicts)
    return counts


def _write_datasets(
    spark: SparkSession, builders: dict, gold_root: str, run_ts, run_date, parallel: int
) -> dict[str, int]:
    """Write each dataset, up to ``parallel`` at once; the row count of each."""

    def write(name: str) -> int:
        # own scheduler pool per dataset: FAIR shares executors between pools, while
        # jobs inside one pool (the default) still run first-in first-out
        with scheduler_pool(spark, f"gold_{name}"):
            n = layers.write_gold(builders[name](), gold_root, name, run_ts, run_date)
        log.info("gold %s: %d rows", name, n["record_count"])
        return n["record_count"]

    if parallel > 1:
        with ThreadPoolExecutor(max_workers=parallel, thread_name_prefix="gold") as pool:
            # inheritable: the caller's job group and other local properties follow
            inherit = inheritable_thread_target(spark)
            futures = {name: pool.submit(inherit(write), name) for name in builders}
            counts = {name: f.result() for name, f in futures.items()}
    else:
        counts = {name: write(name) for name in builders}
    return counts


def key_rules(key: str | tuple[str, ...]) -> tuple:
    """The published ruleset on a key the table must have: a missing column fails."""
    return (
        quality.Rule("ColumnCount", None, 0.0),
        quality.Rule("Completeness", key, 0.95),
        quality.Rule("Uniqueness", key, 0.99),
    )


def default_rules(df: DataFrame, key: str | tuple[str, ...] = KEY_COLUMN) -> tuple:
    """The published ruleset on ``key`` (a column or a tuple of columns) when the table
    has it; otherwise only the column count (the published rules name an ``id`` most
    tables lack)."""
    cols = (key,) if isinstance(key, str) else tuple(key)
    if all(c in df.columns for c in cols):
        return key_rules(key)
    return (quality.Rule("ColumnCount", None, 0.0),)


@dataclass
class LayerConfig:
    """What the scheduled flow needs, named explicitly (no discovery by name)."""

    bronze_tables: dict[str, str]  # table name -> catalog name or path
    silver_root: str
    gold_root: str
    transactions_table: str  # silver table holding the transactions
    customers_table: str | None = None
    products_table: str | None = None
    lineage_path: str | None = None
    cleaning_job: str = "bronze_to_silver"
    gold_job: str = "silver_to_gold"
    key_column: str = KEY_COLUMN
    # the key each silver table must have complete and unique, by silver table name
    gate_keys: dict = field(default_factory=dict)
    # rules per silver table name; tables in neither get ``default_rules(key_column)``
    rules: dict = field(default_factory=dict)
    relative_error: float = DEFAULT_RELATIVE_ERROR
    as_of: object = None
    run_date: _dt.date | None = None
    parallel: int = 3  # concurrent Spark jobs (bronze tables, gold datasets)
    size_partitions: bool = True  # raise shuffle partitions to ~1 per 256 MB of input
    gate_gold: bool = True  # each gold dataset's key complete and unique
    versioned: bool = True  # silver tables as versions that a manifest names


def run_layers(spark: SparkSession, cfg: LayerConfig) -> dict:
    """Clean -> silver quality gate -> gold -> summary -> gold quality gate.

    Bronze tables are cleaned (and gated) as concurrent jobs, up to ``cfg.parallel`` at
    once, and so are the gold datasets. Shuffle partitions are raised to suit the
    largest bronze input (``cfg.size_partitions``) and set back at the end; the shuffle files
    of each job go when it ends. Any failed gate raises.
    """
    from laminar.session import input_bytes, shuffles_removed, sized_shuffles

    paths = [src for src in cfg.bronze_tables.values() if "/" in src or ":" in src]
    with shuffles_removed(spark):
        if cfg.size_partitions and paths:
            with sized_shuffles(spark, max(input_bytes(spark, [p]) for p in paths)):
                return _run_layers(spark, cfg)
        return _run_layers(spark, cfg)


def _run_layers(spark: SparkSession, cfg: LayerConfig) -> dict:
    def rules(target: str):
        if target in cfg.rules or target not in cfg.gate_keys:
            return cfg.rules.get(target)
        return key_rules(cfg.gate_keys[target])

    def one(name: str, source: str) -> dict:
        return clean_and_gate(
            layers.read_table(spark, source), cfg.silver_root, name, cfg.cleaning_job,
            cfg.lineage_path, cfg.run_date, cfg.key_column, rules(silver_name(name)),
            versioned=cfg.versioned,
        )

    with ThreadPoolExecutor(max_workers=max(1, cfg.parallel), thread_name_prefix="clean") as pool:
        futures = [
            pool.submit(inheritable_thread_target(spark)(one), n, src)
            for n, src in cfg.bronze_tables.items()
        ]
        reports = [f.result() for f in futures]  # raises the first failure (gate included)

    def silver(table):
        return None if table is None else layers.read_table(
            spark, f"{cfg.silver_root.rstrip('/')}/{table}"
        )

    tx = silver(cfg.transactions_table)
    if tx is None:
        raise ValueError("no transaction data in the silver layer")
    counts = build_gold(
        tx,
        cfg.gold_root,
        silver(cfg.customers_table),
        silver(cfg.products_table),
        cfg.gold_job,
        cfg.as_of,
        run_date=cfg.run_date,
        relative_error=cfg.relative_error,
        parallel=cfg.parallel,
        gate=cfg.gate_gold,
    )
    return {"cleaning": reports, "gold": counts}


@dataclass
class IncrementalConfig:
    """An incremental load of silver tables and the gold datasets built from it."""

    sources: dict  # silver table name -> laminar.streaming.incremental.Source
    silver_root: str
    gold_root: str
    checkpoint_root: str
    transactions_table: str
    customers_table: str | None = None
    products_table: str | None = None
    gold_job: str = "silver_to_gold"
    relative_error: float = DEFAULT_RELATIVE_ERROR
    as_of: object = None
    run_date: _dt.date | None = None
    parallel: int = 3
    gate_gold: bool = True


def run_incremental(spark: SparkSession, cfg: IncrementalConfig) -> dict:
    """Load new files of every table (S5), publish them as one load, and recompute gold from
    that load: a run that stops in between leaves the gold of the load before, and the next
    run loads nothing twice."""
    from laminar.session import sized_shuffles
    from laminar.streaming.incremental import load_tables

    loaded = load_tables(
        spark, cfg.sources, cfg.silver_root, cfg.checkpoint_root, cfg.run_date, cfg.parallel
    )
    versions = loaded["versions"]
    if cfg.transactions_table not in snapshots.current_load(spark, cfg.silver_root)["versions"]:
        raise ValueError("no transaction data in the silver layer")

    def silver(table):
        if table is None or table not in snapshots.current_load(spark, cfg.silver_root)["versions"]:
            return None
        return snapshots.read_load(spark, cfg.silver_root, table)

    root = cfg.silver_root.rstrip("/")
    size = snapshots.size_bytes(
        spark, f"{root}/{cfg.transactions_table}", versions.get(cfg.transactions_table)
    )
    with sized_shuffles(spark, size):
        counts = build_gold(
            silver(cfg.transactions_table), cfg.gold_root, silver(cfg.customers_table),
            silver(cfg.products_table), cfg.gold_job, cfg.as_of, run_date=cfg.run_date,
            relative_error=cfg.relative_error, parallel=cfg.parallel, gate=cfg.gate_gold,
        )
    return {"load": loaded["load"], "batches": loaded["batches"], "gold": counts}
