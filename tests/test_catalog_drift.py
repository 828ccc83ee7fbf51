"""Catalog registration by run, schema discovery, stored sketches, table keys of the jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from laminar import jobs
from laminar.operators import quantiles
from laminar.plans import customer, rfm
from laminar.sources import catalog, layers, snapshots, testdata
from laminar.sources import schema_drift as drift

SF = "/root/testdata/sf0.001"


@pytest.fixture
def db(spark, tmp_path):
    name = f"db_{abs(hash(str(tmp_path))) % 10**9}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/database'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def partitions(spark, name):
    return sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())


def test_run_adds_only_its_partition(spark, tmp_path, db):
    df = spark.createDataFrame([(1, "x")], "k long, v string")
    for day in (1, 2, 3):
        layers.write_gold(df, str(tmp_path), "ds", run_date=dt.date(2024, 1, day))
    part = {"year": 2024, "month": 1, "day": 3}
    assert catalog.register_run(spark, f"{db}.ds", f"{tmp_path}/ds", part).count() == 3  # the first finds all
    layers.write_gold(df, str(tmp_path), "ds", run_date=dt.date(2024, 1, 4))
    layers.write_gold(df, str(tmp_path), "ds", run_date=dt.date(2024, 1, 5))
    assert catalog.register_run(spark, f"{db}.ds", f"{tmp_path}/ds", {**part, "day": 5}).count() == 4
    assert partitions(spark, f"{db}.ds")[-1] == "year=2024/month=1/day=5"
    layers.write_gold(df.where("false"), str(tmp_path), "ds", run_date=dt.date(2024, 1, 5))
    assert catalog.register_run(spark, f"{db}.ds", f"{tmp_path}/ds", {**part, "day": 5}).count() == 3
    with pytest.raises(ValueError):
        catalog.register_run(spark, f"{db}.ds", f"{tmp_path}/other", part, df.schema)


def test_registered_versions(spark, tmp_path, db):
    t = str(tmp_path / "layer" / "t")
    df = spark.createDataFrame([(1, "a", 1), (2, "it's", 2)], "k int, `a b` string, day int")
    snapshots.write(df, t, ["day"])
    view = f"{db}.t"
    assert catalog.register_version(spark, view, t, ["day"]).count() == 2
    snapshots.write(df.withColumn("k", F.col("k") + 10), t, ["day"], replace="none", label="more")
    assert spark.table(view).count() == 2  # not registered yet
    assert catalog.register_version(spark, view, t, ["day"]).count() == 4
    assert len(partitions(spark, f"{view}_versions")) == 4
    snapshots.write(df.withColumn("extra", F.lit(1.5)), t, ["day"])
    got = catalog.register_version(spark, view, t, ["day"])
    assert got.columns == ["k", "a b", "day", "extra"] and got.where("extra = 1.5").count() == 2
    assert len(partitions(spark, f"{view}_versions")) == 2  # what no longer counts is dropped
    wide = spark.createDataFrame([(2**40, "z", 1)], "k long, `a b` string, day int")
    snapshots.write(wide, t, ["day"], replace="none")
    assert sorted(r.k for r in catalog.register_version(spark, view, t, ["day"]).collect()) == [1, 2, 2**40]
    plan = spark.sql(f"SELECT `a b` FROM {view} WHERE day = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1][:200]
    assert catalog.tables_under(spark, db, str(tmp_path / "layer")) == ["t"]
    assert catalog.tables_under(spark, db, str(tmp_path / "lay")) == []


def test_widened_types():
    want = {
        ("int", "bigint"): "bigint", ("bigint", "int"): "bigint", ("tinyint", "smallint"): "smallint",
        ("float", "double"): "double", ("int", "double"): "double", ("bigint", "double"): None,
        ("date", "timestamp_ntz"): "timestamp_ntz", ("string", "int"): None, ("boolean", "int"): None,
        ("decimal(10,2)", "decimal(12,4)"): "decimal(12,4)", ("decimal(12,2)", "decimal(10,4)"): "decimal(14,4)",
        ("int", "decimal(5,2)"): "decimal(12,2)", ("decimal(38,2)", "decimal(38,20)"): None, ("string", "string"): "string",
    }
    assert {k: drift.widened_type(*k) for k in want} == want


def test_widened_columns_agree_with_the_rule(spark):
    names = ["tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp_ntz", "string",
             "decimal(10,2)", "decimal(12,4)", "decimal(38,20)", "decimal(38,2)", "boolean"]
    pairs = [(a, b) for a in names for b in names if a != b]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", drift._widened(F.col("a"), F.col("b")).alias("w")).collect():
        assert r.w == drift.widened_type(r.a, r.b), r


def test_history_of_a_repeated_run(spark, tmp_path):
    h = f"{tmp_path}/history"
    spark.range(2).write.parquet(f"{tmp_path}/l1")
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/l2")
    for load, path in ((1, "l1"), (2, "l2"), (2, "l2")):
        drift.record_schema(spark, h, "t", load, f"{tmp_path}/{path}")
    drift.record_schema(spark, h, "other", 2, f"{tmp_path}/l1")
    got = drift.schema_changes(drift.read_history(spark, h)).collect()
    assert [(r.table_name, r.load, r.column, r.change, r.new_type) for r in got] == [("t", 2, "x", "added", "int")]


def test_sketches_of_groups_merge(spark):
    df = spark.range(10_000).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("none"))
    stored = quantiles.kll_sketches(df, ["x", "none"], ["g"])
    cuts = quantiles.kll_cuts(stored, ["x", "none"]).collect()[0]
    for p in quantiles.QUINTILES:
        assert abs(cuts[f"x_q{round(p * 100):02d}"] / 10_000 - p) < 0.05
        assert cuts[f"none_q{round(p * 100):02d}"] is None


def test_segments_from_stored_sketches(spark, tmp_path):
    base = customer.customer_base(testdata.transactions(spark, SF))
    rfm.write_sketches(base, f"{tmp_path}/s")
    rfm.write_sketches(base, f"{tmp_path}/s", groups=[0, 5])  # again: nothing is counted twice
    cuts = rfm.sketched_cuts(spark.read.parquet(f"{tmp_path}/s"))
    ranks = rfm.cut_ranks(rfm.rfm_base(None, base), cuts).collect()
    n = base.count()
    assert len(ranks) == 12 and all(r.customers == n for r in ranks)
    assert all(r.below <= (r.probability + 0.05) * n and r.up_to >= (r.probability - 0.05) * n for r in ranks)
    got = rfm.rfm_segments(None, customers_base=base, cuts=cuts)
    assert got.count() == n and {r.r_score for r in got.collect()} == {1, 2, 3, 4, 5}


def test_keys_on_the_command_line(spark, tmp_path):
    assert jobs.table_keys(["a=id", "b=x, y"]) == {"a": "id", "b": ("x", "y")}
    for bad in ("a", "=x", "a="):
        with pytest.raises(ValueError):
            jobs.table_keys([bad])
    spark.createDataFrame([(1, "a"), (1, "b")], "order_id long, v string").write.parquet(f"{tmp_path}/bronze/bronze_t")
    run = ["bronze-to-silver", "--bronze-root", f"{tmp_path}/bronze", "--silver-root", f"{tmp_path}/silver", "--gate"]
    with pytest.raises(ValueError, match="data-quality"):
        jobs.main([*run, "--key", "bronze_t=order_id"])
    with pytest.raises(ValueError, match="not loaded"):
        jobs.main([*run, "--key", "bronze_x=order_id"])
    jobs.main([*run, "--key", "bronze_t=order_id,v"])
    assert layers.read_table(spark, f"{tmp_path}/silver/silver_t").count() == 2
