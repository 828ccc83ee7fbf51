"""Property tests: the distributed operators equal brute force on arbitrary inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brute import window_rank
from laminar.operators.ranking import global_rank
from laminar.operators.skew import split_hot_key_join

SETTINGS = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

values = st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=120)


@SETTINGS
@given(vals=values, n_parts=st.integers(1, 9), desc=st.booleans())
def test_global_rank_equals_window(spark, vals, n_parts, desc):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k long, v double")
    cols = ["k", "row_number", "rank", "percent_rank"]
    got = sorted(tuple(r) for r in global_rank(df, "v", ["k"], desc, n_parts).select(*cols).collect())
    want = sorted(tuple(r) for r in window_rank(df, "v", ["k"], desc).select(*cols).collect())
    assert got == want


@SETTINGS
@given(keys=st.lists(st.integers(0, 4), min_size=1, max_size=200), max_hot=st.integers(1, 10))
def test_split_join_equals_join(spark, keys, max_hot):
    big = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, t long")
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"))
    got = split_hot_key_join(big, small, "k", "n", F.col("t"), max_hot_keys=max_hot, min_split_rows=1)
    want = big.join(small, "k")
    cols = ["k", "t", "n", "first_t"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(
        tuple(r) for r in want.select(*cols).collect()
    )


rows_st = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["a", "b", None])),
    min_size=0, max_size=60,
)


@SETTINGS
@given(rows=rows_st)
def test_cleaning_counts_equal_brute_force(spark, tmp_path_factory, rows):
    import datetime as dt

    from laminar.operators import cleaning

    df = spark.createDataFrame(rows, "id long, v string")
    distinct = set(rows)
    want = {
        "input_rows": len(rows),
        "duplicates_removed": len(rows) - len(distinct),
        "null_keys_removed": sum(1 for r in distinct if r[0] is None),
        "output_rows": sum(1 for r in distinct if r[0] is not None),
    }
    assert cleaning.cleaning_report(df).collect()[0].asDict() == want
    observed = cleaning.ObservedCleaning(df, run_date=dt.date(2024, 1, 1))
    observed.frame.write.mode("overwrite").parquet(str(tmp_path_factory.mktemp("clean")))
    assert observed.report() == want


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.integers(0, 8)), min_size=0, max_size=80))
def test_quality_values_equal_brute_force(spark, keys):
    from laminar.operators import quality

    df = spark.createDataFrame([(k,) for k in keys], "id long")
    got = {r.rule: r.value for r in quality.evaluate_ruleset(df).collect()}
    non_null = [k for k in keys if k is not None]
    singles = sum(1 for k in set(non_null) if non_null.count(k) == 1)
    assert got["ColumnCount"] == 1.0
    assert got["Completeness"] == (len(non_null) / len(keys) if keys else None)
    assert got["Uniqueness"] == (singles / len(non_null) if non_null else None)


@SETTINGS
@given(
    a=st.lists(st.one_of(st.none(), st.integers(0, 20)), min_size=1, max_size=70),
    n_parts=st.integers(1, 7),
)
def test_exact_cuts_many_equal_brute_force(spark, a, n_parts):
    import math

    from laminar.operators.quantiles import exact_cuts_many

    rows = [(i, None if v is None else float(v), None if v is None else float(-v)) for i, v in enumerate(a)]
    df = spark.createDataFrame(rows, "k long, x double, y double")
    got = exact_cuts_many(df, ["x", "y"], ["k"], n_partitions=n_parts).collect()[0].asDict()
    for col, idx in (("x", 1), ("y", 2)):
        vals = sorted(r[idx] for r in rows if r[idx] is not None)
        for p in (0.2, 0.4, 0.6, 0.8):
            want = vals[max(1, math.ceil(p * len(vals))) - 1] if vals else None
            assert got[f"{col}_q{round(p * 100):02d}"] == want
