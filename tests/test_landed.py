"""Queries that read the transactions several times make their join once."""

import datetime as dt

import pytest

from laminar import registry, registry_flows  # noqa: F401
from laminar.plans import layers


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    items = [(o, o % 3, 1, n, 2.0, 100.0 * o, 0.05) for o in range(1, 41) for n in (1, 2)]
    orders = [(o, o % 7, dt.datetime(2001, 1, 1) + dt.timedelta(days=o), "O") for o in range(1, 41)]
    for name, rows, schema in (
        ("lineitem", items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
         "l_quantity double, l_extendedprice double, l_discount double"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string"),
        ("customer", [(c, "n", "s", 1, 1.0) for c in range(7)],
         "c_custkey long, c_name string, c_mktsegment string, c_nationkey int, c_acctbal double"),
        ("part", [(p, "n", "b", "t", 1, 1.0) for p in range(3)],
         "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_sketched_cuts_read_the_landed_transactions(spark, tables):
    out = registry.QUERIES["rfm_cuts_kll"](spark, tables)
    assert not any("lineitem" in f or "orders" in f for f in out.inputFiles())
    assert [(r.customers, r.within_error) for r in out.collect()] == [(7, True)] * 12


def test_gold_is_built_from_the_landed_transactions(spark, tables, monkeypatch):
    seen, build = [], layers.build_gold

    def watched(tx, *args, **kwargs):
        seen.extend(tx.inputFiles())
        return build(tx, *args, **kwargs)

    monkeypatch.setattr(layers, "build_gold", watched)
    for name in ("job_summary", "job_summary_empty"):
        registry.QUERIES[name](spark, tables).collect()
    assert seen and not any("lineitem" in f or "orders" in f for f in seen)


def test_loads_land_from_one_join(spark, tables, monkeypatch):
    from laminar.sources import testdata

    made, landed = [], registry._landed
    monkeypatch.setattr(registry, "_landed", lambda s, df, path: made.append(path) or landed(s, df, path))
    out = registry.QUERIES["incremental_gold"](spark, tables)
    assert len(made) == 1
    told = out.where("dataset = 'daily_metrics' and measure = 'daily_transaction_count'")
    assert told.selectExpr("sum(number)").first()[0] == testdata.transactions(spark, tables).count() == 80
