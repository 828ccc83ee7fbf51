"""Every registered query against its DuckDB oracle at sf0.01 (the correctness gate)."""

import pytest

from laminar import checks, registry

NAMES = sorted(registry.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck01, name):
    df = registry.QUERIES[name](spark, "/root/testdata/sf0.01")
    sql = registry.ORACLE.get(name)
    if sql is None:
        assert df.count() >= 0
        return
    res = checks.compare(df, duck01, sql)
    assert res["values_match"], res
    assert res["types_match"], res


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
