"""Catalog-bound layers (S1, S2, S12, S13): tables found, read and registered by name.

Plain tables (bronze, gold) are external Parquet tables; a run adds the partitions that it
wrote, so that registration costs the same on the first day and after years. A versioned
table becomes two things: ``<name>_versions``, an external table with ``snapshot`` as its
first partition column that holds the snapshots of the current version, and the view
``<name>`` that selects those of them which count. Replacing the view is one step, so
that readers by name see the old version or the new one; snapshots are registered before it
and dropped after it. Filters on the table's own partition columns prune as before.
"""

from __future__ import annotations

import datetime as _dt
import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminar.sources import layers, snapshots

VERSIONS = "_versions"
log = logging.getLogger("laminar")


def quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def literal(value) -> str:
    """A string or whole number as SQL."""
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _place(path: str) -> str:
    """A location without scheme and doubled or trailing slashes, for comparison."""
    rest = path.split(":", 1)[-1]
    while "//" in rest:
        rest = rest.replace("//", "/")
    return rest.rstrip("/")


def location(spark: SparkSession, name: str) -> str | None:
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'Location'").first()
    return told and told["data_type"]


def tables_under(spark: SparkSession, database: str, root: str) -> list[str]:
    """Tables of a database whose files lie under ``root`` (catalog metadata only), versioned
    ones by the name of their view."""
    found = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary or t.tableType == "VIEW":
            continue
        place = location(spark, f"{database}.{t.name}")
        if place is not None and _place(place).startswith(_place(root) + "/"):
            found.append(t.name[: -len(VERSIONS)] if t.name.endswith(VERSIONS) else t.name)
    return sorted(found)


def _columns(schema: T.StructType, last: Sequence[str]) -> str:
    fields = [f for f in schema if f.name not in last] + [schema[c] for c in last]
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)


def _create(spark: SparkSession, name: str, schema: T.StructType, partition_cols: Sequence[str], path: str) -> bool:
    """Create an external table unless it is there; whether it is new."""
    if spark.catalog.tableExists(name):
        told = location(spark, name)
        if told is None or _place(told) != _place(path):
            raise ValueError(f"{name} exists at {told}, not at {path}")
        return False
    parts = f"PARTITIONED BY ({', '.join(quoted(c) for c in partition_cols)})" if partition_cols else ""
    spark.sql(
        f"CREATE TABLE {quoted(name)} ({_columns(schema, partition_cols)}) USING parquet {parts} "
        f"LOCATION {literal(path)}"
    )
    return True


def _spec(values: dict) -> str:
    return "PARTITION (" + ", ".join(f"{quoted(k)} = {literal(v)}" for k, v in values.items()) + ")"


def _value(text: str):
    """A folder's partition value: a whole number, or text as Spark wrote it."""
    return int(text) if re.fullmatch("-?(0|[1-9][0-9]{0,17})", text) else unquote(text)


def partition_folders(spark: SparkSession, root: str, columns: Sequence[str]) -> list[dict]:
    """Values of the partition folders ``c1=v1/c2=v2/...`` below ``root`` (names only)."""
    found = [({}, root.rstrip("/"))]
    for column in columns:
        deeper = []
        for values, folder in found:
            p, fs = layers._file_system(spark, folder)
            for st in fs.listStatus(p) if fs.exists(p) else ():
                key, sep, value = st.getPath().getName().partition("=")
                if sep and key == column:
                    deeper.append(({**values, column: _value(value)}, f"{folder}/{key}={value}"))
        found = deeper
    return [values for values, _ in found]


# --------------------------------------------------------------------------- plain tables

def register_run(
    spark: SparkSession, name: str, path: str, partition: dict, schema: T.StructType | None = None
) -> DataFrame:
    """Register a partitioned Parquet folder and the one partition that a run wrote (or
    emptied). A new registration of a folder with older partitions finds them all, once."""
    if schema is None:
        schema = spark.read.parquet(path).schema
    new = _create(spark, name, schema, list(partition), path)
    if new:
        spark.catalog.recoverPartitions(name)
    folder = "/".join([path.rstrip("/"), *[f"{k}={v}" for k, v in partition.items()]])
    p, fs = layers._file_system(spark, folder)
    if fs.exists(p):
        spark.sql(f"ALTER TABLE {quoted(name)} ADD IF NOT EXISTS {_spec(partition)}")
    else:
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS {_spec(partition)}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


# --------------------------------------------------------------------------- versioned tables

def register_version(
    spark: SparkSession, name: str, path: str, partition_cols: Sequence[str] = layers.PARTITION_COLUMNS,
    version: int | None = None,
) -> DataFrame:
    """Bring ``name`` to a version of the table at ``path`` (default: the latest): snapshots
    that are new to the catalog are added, the view is replaced, snapshots that no longer
    count are dropped. A stop in between leaves the old version or the new one; running it
    again completes it. Columns that a later version added are added to the catalog table."""
    told = snapshots.manifest(spark, path, version)
    if told["schema"] is None:
        raise ValueError(f"no version of a table at {path}")
    schema = T.StructType.fromJson(told["schema"])
    parts = [snapshots.SNAPSHOT_COLUMN, *partition_cols]
    with_snapshot = T.StructType([*schema.fields, T.StructField(snapshots.SNAPSHOT_COLUMN, T.StringType())])
    base = f"{name}{VERSIONS}"
    root = f"{path.rstrip('/')}/{snapshots.SNAPSHOTS}"
    if spark.catalog.tableExists(base):
        have = {f.name: f.dataType for f in spark.table(base).schema}
        if any(have.get(f.name, f.dataType) != f.dataType for f in schema):  # a widened column
            spark.sql(f"DROP TABLE {quoted(base)}")  # external: the files stay
        else:
            added = [f for f in schema if f.name not in have]
            if added:
                spark.sql(f"ALTER TABLE {quoted(base)} ADD COLUMNS ({_columns(T.StructType(added), ())})")
    _create(spark, base, with_snapshot, parts, root)
    counted = [e["snapshot"] for e in told["entries"]]
    known: dict[str, list[dict]] = {}  # snapshot -> its partitions, in full
    for row in spark.sql(f"SHOW PARTITIONS {quoted(base)}").collect():
        values = {k: _value(v) for k, v in (part.split("=", 1) for part in row[0].split("/"))}
        known.setdefault(str(values[snapshots.SNAPSHOT_COLUMN]), []).append(values)
    for snapshot in counted:
        if snapshot not in known:
            folder = snapshots.snapshot_path(path, snapshot)
            specs = [
                _spec({snapshots.SNAPSHOT_COLUMN: snapshot, **values})
                for values in partition_folders(spark, folder, partition_cols)
            ]
            for k in range(0, len(specs), 100):
                spark.sql(f"ALTER TABLE {quoted(base)} ADD IF NOT EXISTS {' '.join(specs[k : k + 100])}")
    spark.catalog.refreshTable(base)
    which = ", ".join(literal(s) for s in counted) or "''"
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(name)} AS SELECT {', '.join(quoted(f.name) for f in schema)} "
        f"FROM {quoted(base)} WHERE {quoted(snapshots.SNAPSHOT_COLUMN)} IN ({which})"
    )
    gone = [
        _spec({**values, snapshots.SNAPSHOT_COLUMN: snapshot})
        for snapshot in set(known) - set(counted)
        for values in known[snapshot]
    ]
    for k in range(0, len(gone), 100):
        spark.sql(f"ALTER TABLE {quoted(base)} DROP IF EXISTS {', '.join(gone[k : k + 100])}")
    return spark.table(name)


# --------------------------------------------------------------------------- the flow

@dataclass
class CatalogConfig:
    """The scheduled flow on a catalog database: what lies under a layer's root is its
    tables, as registered."""

    database: str
    bronze_root: str
    silver_root: str
    gold_root: str
    # silver table names; without them tables are bound by name (plans.layers.bind_roles)
    transactions_table: str | None = None
    customers_table: str | None = None
    products_table: str | None = None
    keys: dict = field(default_factory=dict)  # silver table name -> key that the gate checks
    lineage_path: str | None = None
    as_of: object = None
    run_date: _dt.date | None = None
    relative_error: float = 0.05
    parallel: int = 3
    gate_gold: bool = True


def run_catalog_layers(spark: SparkSession, cfg: CatalogConfig) -> dict:
    """Clean every bronze table that the database has under the bronze root, register the
    silver tables, build gold from them by name, register the run's gold partitions."""
    from laminar.plans import layers as plan

    db, silver_root = cfg.database, cfg.silver_root.rstrip("/")
    run_date = cfg.run_date or spark.range(1).select(F.current_date()).first()[0]
    reports = []
    for name in tables_under(spark, db, cfg.bronze_root):
        target = plan.silver_name(name)
        key = cfg.keys.get(target)
        reports.append(
            plan.clean_and_gate(
                spark.table(f"{db}.{name}"), silver_root, name, "bronze_to_silver", cfg.lineage_path,
                run_date, rules=plan.key_rules(key) if key else None, versioned=True,
            )
        )
        register_version(spark, f"{db}.{target}", f"{silver_root}/{target}")
    silver = tables_under(spark, db, silver_root)
    bound = plan.bind_roles(silver)
    named = {
        "transactions": cfg.transactions_table, "customers": cfg.customers_table,
        "products": cfg.products_table,
    }
    roles = {r: t or bound.get(r) for r, t in named.items()} if not any(named.values()) else named
    if not roles["transactions"]:
        raise ValueError("no transaction data in the silver layer")
    table = lambda t: spark.table(f"{db}.{t}") if t else None
    counts = plan.build_gold(
        table(roles["transactions"]), cfg.gold_root, table(roles["customers"]), table(roles["products"]),
        as_of=cfg.as_of, run_date=run_date, relative_error=cfg.relative_error, parallel=cfg.parallel,
        gate=cfg.gate_gold,
    )
    for dataset in [*counts, plan.JOB_SUMMARY]:
        path = f"{cfg.gold_root.rstrip('/')}/{dataset}"
        p, fs = layers._file_system(spark, path)
        if not fs.exists(p) or (dataset in counts and not counts[dataset] and not spark.catalog.tableExists(f"{db}.{dataset}")):
            continue  # nothing was ever written there
        # a dataset with a year of its own keeps the load date elsewhere, as write_gold does
        schema = spark.table(f"{db}.{dataset}").schema if spark.catalog.tableExists(f"{db}.{dataset}") else spark.read.parquet(path).schema
        columns = layers.LOAD_PARTITION_COLUMNS if "load_year" in schema.names else layers.PARTITION_COLUMNS
        values = dict(zip(columns, (run_date.year, run_date.month, run_date.day)))
        register_run(spark, f"{db}.{dataset}", path, values, schema)
    log.info("catalog %s: silver %s, gold %s", db, silver, counts)
    return {"cleaning": reports, "gold": counts, "silver": silver}
