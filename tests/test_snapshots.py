"""Versioned tables: commits, stops between the steps, replay, loads of several tables."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from laminar.plans.layers import clean_and_gate, key_rules
from laminar.sources import layers, snapshots
from laminar.streaming.incremental import Source, load_increment, load_tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, *values, name="v"):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{name} string, day int")


def test_versions_and_labels(spark, tmp_path):
    t = str(tmp_path / "t")
    assert snapshots.current_version(spark, t) == 0 and not snapshots.is_versioned(spark, t)
    with pytest.raises(ValueError):
        snapshots.read(spark, t)
    first = snapshots.write(frame(spark, "a", "b"), t, ["day"])
    assert first == {"version": 1, "record_count": 2}
    snapshots.write(frame(spark, "c"), t, ["day"], replace="none", label="x", keep=9)
    snapshots.write(frame(spark, "d", "e"), t, ["day"], replace="label", label="x", keep=9)
    assert rows(layers.read_table(spark, t)) == [("a", 0), ("b", 1), ("d", 0), ("e", 1)]
    assert rows(snapshots.read(spark, t, 2)) == [("a", 0), ("b", 1), ("c", 0)]
    snapshots.commit(spark, t, None, "label", "x")
    assert rows(snapshots.read(spark, t)) == [("a", 0), ("b", 1)]
    assert [(r.version, r.rows) for r in snapshots.history(spark, t).orderBy("version", "rows").collect()] == [
        (1, 2), (2, 1), (2, 2), (3, 2), (3, 2), (4, 2)]
    snapshots.write(frame(spark).where("false"), t, ["day"], keep=9)
    assert rows(snapshots.read(spark, t)) == [] and snapshots.read(spark, t).columns == ["v", "day"]
    assert layers.table_bytes(spark, t) >= 0


def test_filters_reach_the_files_and_partitions_are_pruned(spark, tmp_path):
    t = str(tmp_path / "t")
    snapshots.write(frame(spark, "a", "b", "c"), t, ["day"])
    plan = snapshots.read(spark, t).where("day = 1 and v = 'b'").select("v")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(v), EqualTo(v,b)]" in plan


def test_a_stop_between_any_two_steps_leaves_the_table(spark, tmp_path, monkeypatch):
    t = str(tmp_path / "t")
    snapshots.write(frame(spark, "old"), t, ["day"])

    class Stop(Exception):
        pass

    def stop(*a, **k):
        raise Stop

    for step in ("write_layer", "_publish_json", "vacuum"):
        with monkeypatch.context() as m:
            owner = layers if step == "write_layer" else snapshots
            m.setattr(owner, step, stop)
            with pytest.raises(Stop):
                snapshots.write(frame(spark, "new"), t, ["day"])
        assert rows(layers.read_table(spark, t)) == [("new" if step == "vacuum" else "old", 0)]
    # a manifest that a stopped commit left hidden, a snapshot half written
    (tmp_path / "t" / "_manifests" / ".0123").write_text("{")
    (tmp_path / "t" / "_snapshots" / "snapshot=half" / "day=0").mkdir(parents=True)
    (tmp_path / "t" / "_snapshots" / "snapshot=half" / "day=0" / "part-0.parquet").write_text("no parquet")
    assert rows(layers.read_table(spark, t)) == [("new", 0)]
    assert snapshots.vacuum(spark, t) == []  # young: a writer may be at it
    assert "half" in snapshots.vacuum(spark, t, keep=1, grace_seconds=0)
    assert rows(layers.read_table(spark, t)) == [("new", 0)]
    assert len(os.listdir(tmp_path / "t" / "_snapshots")) == 1


def test_concurrent_commits_lose_nothing(spark, tmp_path):
    t = str(tmp_path / "t")
    entries = [snapshots.stage(frame(spark, f"w{i}"), t, ["day"]) for i in range(8)]
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda e: snapshots.commit(spark, t, e, "none"), entries))
    assert sorted(versions) == list(range(1, 9))
    assert [r[0] for r in rows(snapshots.read(spark, t))] == [f"w{i}" for i in range(8)]


def test_publishing_by_rename(spark, tmp_path):
    """The road of stores other than a local disk."""
    folder = str(tmp_path / "m")
    assert snapshots._rename_json(spark, folder, 1, {"a": 1}) is True
    assert snapshots._rename_json(spark, folder, 1, {"a": 2}) is False
    assert snapshots._load_json(spark, snapshots._file(folder, 1)) == {"a": 1}
    assert snapshots._numbers(spark, folder) == [1]


def test_schema_of_a_version_widens(spark, tmp_path):
    t = str(tmp_path / "t")
    snapshots.write(spark.createDataFrame([(1, "a")], "k int, v string"), t)
    snapshots.write(spark.createDataFrame([(2**40, 1.5)], "k long, extra double"), t, replace="none")
    assert rows(snapshots.read(spark, t).fillna("", ["v"]).fillna(0.0, ["extra"])) == [(1, "a", 0.0), (2**40, "", 1.5)]
    with pytest.raises(ValueError, match="no common type"):
        snapshots.write(spark.createDataFrame([("x",)], "k string"), t, replace="none")
    assert snapshots.read(spark, t).count() == 2


def test_failed_gate_leaves_no_snapshot(spark, tmp_path):
    good = spark.createDataFrame([(1, "a"), (2, "b")], "transaction_id long, v string")
    rules = key_rules("transaction_id")
    clean = lambda df, day: clean_and_gate(
        df, str(tmp_path), "bronze_tx", "job", run_date=dt.date(2024, 1, day), rules=rules, versioned=True
    )
    assert clean(good, 1)["output_rows"] == 2
    with pytest.raises(ValueError):
        clean(good.withColumn("transaction_id", F.lit(None).cast("long")), 2)
    assert rows(layers.read_table(spark, f"{tmp_path}/silver_tx").select("transaction_id", "day")) == [(1, 1), (2, 1)]
    assert len(os.listdir(tmp_path / "silver_tx" / "_snapshots")) == 1


def test_plain_publish_is_recovered(spark, tmp_path):
    t = str(tmp_path / "t")
    layers.write_layer(frame(spark, "old"), t, ["day"])
    os.rename(t, tmp_path / "_old-t-0123456789ab")  # as a job leaves it between the renames
    (tmp_path / "_old-t-longer-0123456789ab").mkdir()
    assert rows(layers.read_table(spark, t)) == [("old", 0)]
    os.rename(t, tmp_path / "_old-t-0123456789ab")
    layers.write_layer(frame(spark, "new"), t, ["day"], mode="overwrite")
    assert rows(layers.read_table(spark, t)) == [("new", 0)]
    assert not layers.recover(spark, str(tmp_path / "never"))


def test_gold_counts_come_from_files(spark, tmp_path, monkeypatch):
    """Whatever metrics say, a partition that was just written stays."""
    df = spark.createDataFrame([(1, "x")], "k long, v string")
    root = str(tmp_path / "gold")
    monkeypatch.setattr(layers, "observed_count", lambda *a: 0)
    for n in (1, 2):
        out = df if n == 1 else df.union(df)
        assert layers.write_gold(out, root, "ds", run_date=dt.date(2024, 1, 1))["record_count"] == n
        assert spark.read.parquet(f"{root}/ds").count() == n
    layers.write_gold(df, root, "ds", run_date=dt.date(2024, 1, 2))
    assert layers.write_gold(df.where("false"), root, "ds", run_date=dt.date(2024, 1, 1))["record_count"] == 0
    assert [r.day for r in spark.read.parquet(f"{root}/ds").collect()] == [2]


def drop(spark, path, *ids):
    spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string").coalesce(1).write.mode("append").parquet(path)


def loaded(df):
    return sorted(r.id for r in df.select("id").collect())


def test_replayed_batches_replace_themselves(spark, tmp_path):
    landing, t, ck = (str(tmp_path / n) for n in ("landing", "t", "ck"))
    drop(spark, landing, 1, 2)
    load = lambda **k: load_increment(spark, landing, None, t, k.pop("ck", ck), versioned=True, **k)
    assert [r["output_rows"] for r in load()] == [2]
    drop(spark, landing, 3)

    def stop(report):
        raise RuntimeError(f"stopped after version {report['version']}")

    with pytest.raises(Exception, match="stopped after version 2"):
        load(after_batch=stop)
    assert loaded(snapshots.read(spark, t)) == [1, 2, 3]
    load()  # the same batch again
    assert loaded(snapshots.read(spark, t)) == [1, 2, 3]
    assert load() == []
    load(ck=str(tmp_path / "new_ck"))  # the checkpoint is lost: all files are read again
    assert loaded(snapshots.read(spark, t)) == [1, 2, 3]


def test_a_load_is_all_tables_or_none(spark, tmp_path):
    root = str(tmp_path)
    schema = "id long, v string"
    schema = spark.createDataFrame([], schema).schema
    for name in ("a", "b"):
        drop(spark, f"{root}/landing/{name}", 1)
    (tmp_path / "landing" / "c").mkdir()
    sources = {n: Source(f"{root}/landing/{n}", schema) for n in ("a", "b", "c")}
    assert load_tables(spark, sources, f"{root}/silver", f"{root}/ck")["load"] == 1
    for name in ("a", "b"):
        drop(spark, f"{root}/landing/{name}", 2)

    def broken(df):
        raise RuntimeError("b fails")

    failing = {**sources, "b": Source(f"{root}/landing/b", schema, transform=broken)}
    with pytest.raises(Exception):
        load_tables(spark, failing, f"{root}/silver", f"{root}/ck")
    read = lambda n: loaded(snapshots.read_load(spark, f"{root}/silver", n))
    assert read("a") == [1] and read("b") == [1]  # a has version 2, no load names it
    assert loaded(snapshots.read(spark, f"{root}/silver/a")) == [1, 2]
    snapshots.vacuum(spark, f"{root}/silver/a", keep=1, grace_seconds=0)
    assert read("a") == [1]  # what a load names is kept
    assert load_tables(spark, sources, f"{root}/silver", f"{root}/ck")["load"] == 2
    assert read("a") == [1, 2] and read("b") == [1, 2]
    with pytest.raises(ValueError):
        read("c")
