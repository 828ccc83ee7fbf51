"""Mergeable ruleset state (Q1-Q4): a gate on a growing table that reads only new rows.

Completeness and uniqueness of a key follow from three counts: rows, rows with a key, keys
that occur once. The state of a table's key is a versioned table of key frequencies, a
snapshot per load (one row per key of the load), and the three counts after each load, kept
with the load's entry in the manifest. A load is counted once, by its own grouping; a key
that was there before is found by joining the load's keys with the state:

    singles += keys new to the table that the load holds once
             - keys the table held once that the load holds again

Scale: the table itself is never read again. The state is joined on the key, after a
semi-join with the load's keys, so that only frequencies of those keys go on; frequencies are
sorted by key in range partitions, so that loads whose keys grow (ids, dates) skip the files
of earlier ones by their statistics. Frequencies are one row per key: a hot key is one row.
After ``MAX_LOADS`` loads the older ones are merged into one. Only the three counts and
the manifest pass the driver.

A load that is added again under its label takes its own place (a replayed batch). Nulls:
rows without a complete key count as rows only. An empty load leaves the counts as they are;
an empty state has no completeness or uniqueness, so those rules fail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.operators import quality
from laminar.sources import snapshots

MAX_LOADS = 16
_N = "__n"
_EMPTY = {"total": 0, "non_null": 0, "singles": 0}


class Overtaken(RuntimeError):
    """Another load was added to the state in between."""


def _key(keys: str | Sequence[str]) -> tuple[str, ...]:
    return (keys,) if isinstance(keys, str) else tuple(keys)


def _named(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def _frequencies(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(k0, k1, ..., __n): a row per complete key, one row of nulls for all other rows."""
    complete = F.lit(True)
    for name in keys:
        complete = complete & _named(name).isNotNull()
    each = [F.when(complete, _named(name)).alias(f"k{i}") for i, name in enumerate(keys)]
    counted = df.select(*each).groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias(_N))
    return counted.repartitionByRange("k0").sortWithinPartitions("k0")


def _entry_rows(spark: SparkSession, path: str, entries: list[dict], schema) -> DataFrame | None:
    if not entries:
        return None
    folders = [snapshots.snapshot_path(path, e["snapshot"]) for e in entries]
    return spark.read.schema(schema).parquet(*folders)


def _counts_of(frequencies: DataFrame) -> dict:
    """The three counts of frequencies that may name a key several times."""
    keys = [c for c in frequencies.columns if c != _N]
    per_key = frequencies.groupBy(*keys).agg(F.sum(_N).alias(_N))
    present = F.col("k0").isNotNull()
    row = per_key.agg(
        F.coalesce(F.sum(_N), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(present, F.col(_N))), F.lit(0)).alias("non_null"),
        F.coalesce(F.sum(F.when(present & (F.col(_N) == 1), 1)), F.lit(0)).alias("singles"),
    ).first()
    return {k: int(row[k]) for k in ("total", "non_null", "singles")}


def _added(load: DataFrame, before: DataFrame | None) -> dict:
    """What a load's frequencies add to the three counts, given those of earlier loads."""
    if before is None:
        return _counts_of(load)
    keys = [c for c in load.columns if c != _N]
    own = load.agg(
        F.coalesce(F.sum(_N), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("k0").isNotNull(), F.col(_N))), F.lit(0)).alias("non_null"),
    ).first()
    counts = {"total": int(own["total"]), "non_null": int(own["non_null"])}
    low, high = load.select(F.min("k0")).scalar(), load.select(F.max("k0")).scalar()
    load = load.where(F.col("k0").isNotNull())
    known = (
        before.where(F.col("k0").between(low, high))
        .join(load.select(*keys), keys, "left_semi")
        .groupBy(*keys)
        .agg(F.sum(_N).alias("__before"))
    )
    met = load.join(known, keys, "left")
    change = F.when(F.col("__before").isNull() & (F.col(_N) == 1), 1).when(F.col("__before") == 1, -1)
    counts["singles"] = int(met.agg(F.coalesce(F.sum(change), F.lit(0))).first()[0])
    return counts


def _results(spark: SparkSession, counts: dict, columns: set[str], keys: tuple[str, ...], rules) -> DataFrame:
    one = spark.range(1).select(*[F.lit(counts[k]).cast("long").alias(k) for k in ("total", "non_null", "singles")])
    rows = []
    for rule in rules:
        if rule.kind != "ColumnCount" and rule.columns != keys:
            raise ValueError(f"the state of {keys} has no counts for {rule}")
        rows.append(quality._rule_row(rule, len(columns), columns >= set(keys)))
    return one.select(F.inline(F.array(*rows)))


def _label(entry: dict) -> list[str]:
    return entry["info"]["labels"]


def _columns(entries: list[dict]) -> set[str]:
    return {c for e in entries for c in e["info"]["columns"]}


def add_load(
    df: DataFrame,
    path: str,
    keys: str | Sequence[str],
    label: str,
    rules: Sequence[quality.Rule] | None = None,
) -> DataFrame:
    """Count a load's rows into the state at ``path`` and evaluate the rules on the table as
    it is with them. With ``rules`` the load is gated: it enters the state only if all pass
    (``quality.quality_gate`` raises otherwise, and the state stays as it was). Returns the
    rule rows (without ``rules``: of ``plans.layers.key_rules``)."""
    from laminar.plans.layers import key_rules

    spark, keys = df.sparkSession, _key(keys)
    staged = snapshots.stage(_frequencies(df, keys), path)
    try:
        load = snapshots.staged_rows(spark, path, staged)
        entries = snapshots.manifest(spark, path)["entries"]
        at = next((i for i, e in enumerate(entries) if label in _label(e)), len(entries))
        if at < len(entries) and _label(entries[at]) != [label]:
            raise ValueError(f"load {label} has been merged with others; it can't be replaced")
        others = [e for e in entries if _label(e) != [label]]
        schema = load.schema
        before = _entry_rows(spark, path, others, schema)
        if at < len(entries) - 1:  # an earlier load again: the counts of all frequencies
            base = _counts_of(before)
            counts = _counts_of(before.unionByName(load))
        else:
            last = entries[-1]["info"] if entries else {"before": _EMPTY, "counts": _EMPTY}
            base = last["before"] if at < len(entries) else last["counts"]
            counts = {k: base[k] + n for k, n in _added(load, before).items()}
        columns = _columns(others) | set(df.columns)
        results = _results(spark, counts, columns, keys, key_rules(keys) if rules is None else rules)
        if rules is not None:
            quality.quality_gate(results)
    except Exception:
        snapshots.discard(spark, path, staged)
        raise
    seen = {e["snapshot"] for e in entries}

    def goes(entry: dict) -> bool:
        if entry["snapshot"] not in seen:
            raise Overtaken(f"{path} got another load while {label} was counted; add it again")
        return _label(entry) == [label]

    # a stop from here on leaves files that vacuum removes, or a published load
    info = {"labels": [label], "columns": df.columns, "before": base, "counts": counts}
    snapshots.commit(spark, path, staged, goes, label, info)
    if len(others) + 1 > MAX_LOADS:
        merge_loads(spark, path)
    return results


def merge_loads(spark: SparkSession, path: str) -> None:
    """All loads but the last become one entry with a row per key; the counts stay."""
    entries = snapshots.manifest(spark, path)["entries"]
    older, last = entries[:-1], entries[-1:]
    if len(older) < 2:
        return
    schema = snapshots.read(spark, path).schema
    rows = _entry_rows(spark, path, older, schema)
    keys = [c for c in rows.columns if c != _N]
    merged = rows.groupBy(*keys).agg(F.sum(_N).alias(_N)).repartitionByRange("k0").sortWithinPartitions("k0")
    staged = snapshots.stage(merged, path)
    info = {
        "labels": [x for e in older for x in _label(e)],
        "columns": sorted(_columns(older)),
        "before": _EMPTY,
        "counts": last[0]["info"]["before"],
    }
    gone = {e["snapshot"] for e in older}
    known = gone | {e["snapshot"] for e in last}

    def goes(entry: dict) -> bool:
        if entry["snapshot"] not in known:
            raise Overtaken(f"{path} got another load while its loads were merged")
        return entry["snapshot"] in gone

    snapshots.commit(spark, path, staged, goes, "merged", info, first=True)
    snapshots.vacuum(spark, path)


def evaluate(
    spark: SparkSession,
    path: str,
    keys: str | Sequence[str],
    rules: Sequence[quality.Rule] | None = None,
) -> DataFrame:
    """The rules on the table as its loads left it, from the counts alone."""
    from laminar.plans.layers import key_rules

    keys = _key(keys)
    entries = snapshots.manifest(spark, path)["entries"]
    counts = entries[-1]["info"]["counts"] if entries else _EMPTY
    return _results(spark, counts, _columns(entries), keys, key_rules(keys) if rules is None else rules)
