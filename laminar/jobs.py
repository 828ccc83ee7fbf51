"""Command-line jobs, one per layer step.

    spark-submit --py-files laminar.zip laminar/jobs.py bronze-to-silver \
        --bronze-root R --silver-root S [--table T ...] [--gate]
    spark-submit --py-files laminar.zip laminar/jobs.py silver-to-gold \
        --silver-root S --gold-root G --transactions silver_transactions \
        [--customers ...] [--products ...] [--auto-bind]
    spark-submit --py-files laminar.zip laminar/jobs.py incremental \
        --source LANDING --silver-dir S --checkpoint C [--archive-dir A]

(``python -m laminar.jobs ...`` locally.) Tables are named explicitly, or every
sub-folder of the bronze root is one table (a listing of folder names on the
driver, no data).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys
from concurrent.futures import ThreadPoolExecutor

from pyspark.util import inheritable_thread_target

from laminar.plans.layers import bind_roles, build_gold, clean_and_gate, key_rules
from laminar.session import build_session, input_bytes, size_shuffle_partitions
from laminar.sources import layers


def list_tables(spark, root: str) -> list[str]:
    """Sub-folder names of ``root`` (Hadoop file system, so any store Spark can read)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(
        st.getPath().getName()
        for st in fs.listStatus(path)
        if st.isDirectory() and not st.getPath().getName().startswith(("_", "."))
    )


def table_keys(told: list[str]) -> dict[str, str | tuple[str, ...]]:
    """``table=column[,column...]`` options as the key of each table."""
    keys: dict[str, str | tuple[str, ...]] = {}
    for option in told:
        table, sep, columns = option.partition("=")
        names = tuple(c.strip() for c in columns.split(",") if c.strip())
        if not sep or not table or not names:
            raise ValueError(f"--key wants table=column, got {option!r}")
        keys[table] = names[0] if len(names) == 1 else names
    return keys


def bronze_to_silver(args) -> dict:
    spark = build_session(app_name=args.job_name)
    tables = args.table or list_tables(spark, args.bronze_root)
    # tables run concurrently, so size shuffles for the largest one
    sizes = [input_bytes(spark, [f"{args.bronze_root.rstrip('/')}/{t}"]) for t in tables]
    size_shuffle_partitions(spark, max(sizes, default=0))
    run_date = _dt.date.fromisoformat(args.run_date) if args.run_date else None
    keys = table_keys(args.key or [])
    if set(keys) - set(tables):
        raise ValueError(f"--key names tables that are not loaded: {sorted(set(keys) - set(tables))}")

    def one(t: str) -> dict:
        bronze = layers.read_table(spark, f"{args.bronze_root.rstrip('/')}/{t}")
        key = keys.get(t)
        return clean_and_gate(
            bronze, args.silver_root, t, args.job_name, args.lineage_path, run_date,
            rules=key_rules(key) if key else None, gate=args.gate, versioned=not args.plain,
        )

    # tables are independent jobs: run up to --parallel of them at once
    with ThreadPoolExecutor(max_workers=max(1, args.parallel)) as pool:
        reports = list(pool.map(inheritable_thread_target(spark)(one), tables))
    return {"tables": reports}


def silver_to_gold(args) -> dict:
    spark = build_session(app_name=args.job_name)
    root = args.silver_root.rstrip("/")

    def read(name):
        return layers.read_table(spark, f"{root}/{name}") if name else None

    names = {"transactions": args.transactions, "customers": args.customers,
             "products": args.products}
    if args.auto_bind:
        names.update(bind_roles(list_tables(spark, root)))
    tx = read(names["transactions"])
    if tx is None:
        raise ValueError("no transaction data in the silver layer")
    size_shuffle_partitions(spark, layers.table_bytes(spark, f"{root}/{names['transactions']}"))
    run_date = _dt.date.fromisoformat(args.run_date) if args.run_date else None
    counts = build_gold(
        tx, args.gold_root, read(names["customers"]), read(names["products"]), args.job_name,
        as_of=args.as_of, run_date=run_date, relative_error=args.relative_error,
        parallel=args.parallel, gate=args.gate,
    )
    return {"gold": counts}


def incremental(args) -> dict:
    from laminar.streaming.incremental import load_increment

    spark = build_session(app_name=args.job_name)
    checkpoint = args.checkpoint
    run_date = _dt.date.fromisoformat(args.run_date) if args.run_date else None
    reports = load_increment(
        spark, args.source, None, args.silver_dir, checkpoint, run_date=run_date,
        max_files_per_trigger=args.max_files_per_trigger, archive_dir=args.archive_dir,
    )
    return {"batches": reports, "checkpoint": checkpoint}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="laminar.jobs")
    sub = p.add_subparsers(dest="step", required=True)
    b = sub.add_parser("bronze-to-silver")
    b.add_argument("--bronze-root", required=True)
    b.add_argument("--silver-root", required=True)
    b.add_argument("--table", action="append")
    b.add_argument("--lineage-path")
    b.add_argument("--job-name", default="bronze_to_silver")
    b.add_argument("--run-date")
    b.add_argument("--gate", action="store_true", help="stop on a failed quality rule")
    b.add_argument("--key", action="append", metavar="TABLE=COLUMN[,COLUMN]",
                   help="the key that the quality rules of a table check (after cleaning: "
                        "lower-case names); without one: id where there is one")
    b.add_argument("--plain", action="store_true",
                   help="replace the folder of a silver table instead of adding a version")
    b.add_argument("--parallel", type=int, default=3, help="tables cleaned at once")
    g = sub.add_parser("silver-to-gold")
    g.add_argument("--silver-root", required=True)
    g.add_argument("--gold-root", required=True)
    g.add_argument("--transactions")
    g.add_argument("--auto-bind", action="store_true",
                   help="bind silver tables to roles by name, as the published job does")
    g.add_argument("--customers")
    g.add_argument("--products")
    g.add_argument("--job-name", default="silver_to_gold")
    g.add_argument("--as-of")
    g.add_argument("--run-date")
    g.add_argument("--relative-error", type=float, default=0.05)
    g.add_argument("--parallel", type=int, default=3, help="gold datasets written at once")
    g.add_argument("--gate", action="store_true", help="fail if a gold key is incomplete or repeated")
    i = sub.add_parser("incremental")
    i.add_argument("--source", required=True)
    i.add_argument("--silver-dir", required=True)
    i.add_argument("--checkpoint", required=True, help="keep the same folder from run to run")
    i.add_argument("--max-files-per-trigger", type=int)
    i.add_argument("--archive-dir")
    i.add_argument("--job-name", default="bronze_to_silver_incremental")
    i.add_argument("--run-date")
    args = p.parse_args(argv)
    steps = {
        "bronze-to-silver": bronze_to_silver,
        "silver-to-gold": silver_to_gold,
        "incremental": incremental,
    }
    out = steps[args.step](args)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main(sys.argv[1:])
