"""C1-C9 on small literal frames with the edge cases of each rule."""

import datetime as dt

import pytest
from pyspark.sql import Observation

from laminar.operators import cleaning


def test_dedup_and_null_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "c")], "id long, v string")
    out = cleaning.drop_null_keys(cleaning.drop_exact_duplicates(df))
    assert sorted(r.id for r in out.collect()) == [1, 2]


def test_null_key_rule_is_case_sensitive(spark):
    df = spark.createDataFrame([(None, "b"), (2, "c")], "ID long, v string")
    assert cleaning.drop_null_keys(df).count() == 2  # only a column named exactly "id"


def test_normalize_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Order-Status` int, `Order Priority` int, `ID` int")
    assert cleaning.normalize_column_names(df).columns == ["order_status", "order_priority", "id"]
    clash = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        cleaning.normalize_column_names(clash)


def test_dates_numbers_email(spark):
    df = spark.createDataFrame(
        [
            ("2001-02-03 04:05:06", "12.50", "a.b@example.com"),
            ("2001-02-03", "n/a", "not-an-email"),
            ("bad", None, None),
        ],
        "transaction_date string, amount string, email string",
    )
    out = cleaning.correct_schema(df).collect()
    assert out[0].transaction_date == dt.datetime(2001, 2, 3, 4, 5, 6)
    assert out[1].transaction_date is None  # a date without time is not the format
    assert out[2].transaction_date is None
    assert [r.amount for r in out] == [12.5, 0.0, 0.0]
    assert [r.email_valid for r in out] == [True, False, False]
    assert dict(cleaning.correct_schema(df).dtypes)["transaction_date"] == "timestamp_ntz"


def test_rules_skip_missing_columns(spark):
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    assert cleaning.correct_schema(df).columns == ["k", "v"]


def test_audit_and_partition_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    out = cleaning.clean_for_silver(df, run_date=dt.date(2024, 2, 29)).collect()[0]
    assert (out.data_source, out.year, out.month, out.day) == ("bronze_layer", 2024, 2, 29)
    assert out.processing_date == dt.date(2024, 2, 29)


def test_report_matches_observed_counts(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c")], "id long, v string"
    )
    rep = cleaning.cleaning_report(df).collect()[0].asDict()
    assert rep == {"input_rows": 5, "duplicates_removed": 2, "null_keys_removed": 1,
                   "output_rows": 2}
    observed = cleaning.ObservedCleaning(df, run_date=dt.date(2024, 1, 1))
    observed.frame.write.mode("overwrite").parquet(str(tmp_path / "s"))
    assert observed.report() == rep


def test_cleaning_twice_equals_once(spark):
    from laminar.sources import testdata

    bronze = testdata.dirty_bronze_orders(spark, "/root/testdata/sf0.001")
    once = cleaning.apply_quality_rules(bronze).drop("processed_timestamp", "processing_date")
    twice = cleaning.apply_quality_rules(once).drop("processed_timestamp", "processing_date")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_odd_raw_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 3)], "`a.b` int, `c``d` int, `Id` int")
    out = cleaning.apply_quality_rules(df)
    assert out.count() == 1
    assert out.columns[:3] == ["a.b", "c`d", "id"]
    from laminar.operators import quality

    rows = {r.rule: r.value for r in quality.evaluate_ruleset(out, (quality.Rule("Uniqueness", "c`d", 0.5),)).collect()}
    assert rows == {"Uniqueness": 1.0}


@pytest.mark.parametrize("limit", [0, 1, 100])
def test_repeated_rows_are_found_by_hash(spark, limit):
    nan = float("nan")
    rows = [(1, "a", 0.0, [nan]), (1, "a", -0.0, [nan]), (None, "a", nan, None), (None, "a", nan, None)]
    rows += [(2, None, 1.0, [1.0]), (None, None, None, None), (3, "c", None, [])]
    df = spark.createDataFrame(rows, "id long, `odd name` string, x double, xs array<double>")
    seen = Observation()
    out = cleaning.drop_repeated_rows(df, seen, limit)
    assert out.columns == df.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, cleaning.drop_exact_duplicates(df).collect()))
    assert seen.get["n"] == 7


def test_collated_rows_are_compared_in_full(spark):
    df = spark.sql("SELECT s COLLATE UTF8_LCASE AS s FROM VALUES ('a'), ('A'), ('b') t(s)")
    seen = Observation()
    assert cleaning.drop_repeated_rows(df, seen).count() == 2 and seen.get["n"] == 3


def test_rows_that_occur_once_are_not_shuffled(spark, tmp_path):
    spark.range(1000).selectExpr("id", "cast(id as string) as v").write.parquet(f"{tmp_path}/t")
    observed = cleaning.ObservedCleaning(spark.read.parquet(f"{tmp_path}/t"))
    assert "Exchange" not in observed.frame._jdf.queryExecution().executedPlan().toString()
    observed.frame.write.parquet(f"{tmp_path}/out")
    assert observed.report()["input_rows"] == observed.report()["output_rows"] == 1000
