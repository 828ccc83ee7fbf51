"""Q1-Q4 rulesets."""

import pytest

from laminar.operators import quality


def _rows(df):
    return {r.rule: r for r in df.collect()}


def test_ruleset_values(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    rows = _rows(quality.evaluate_ruleset(df))
    assert rows["ColumnCount"].value == 1.0 and rows["ColumnCount"].passed
    assert rows["Completeness"].value == 0.75 and not rows["Completeness"].passed
    assert rows["Uniqueness"].value == 1 / 3 and not rows["Uniqueness"].passed


def test_missing_column_fails_without_error(spark):
    df = spark.createDataFrame([(1,)], "other long")
    rows = _rows(quality.evaluate_ruleset(df))
    assert rows["Completeness"].value is None and rows["Completeness"].passed is False
    assert rows["ColumnCount"].passed
    with pytest.raises(ValueError):
        quality.quality_gate(quality.evaluate_ruleset(df))


def test_gate_passes_clean_keys(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "id long")
    assert len(quality.quality_gate(quality.evaluate_ruleset(df))) == 3


def test_rules_on_two_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id long, code string")
    rules = (
        quality.Rule("ColumnCount", None, 0.0),
        quality.Rule("Uniqueness", "id", 0.99),
        quality.Rule("Completeness", "code", 0.5),
        quality.Rule("Uniqueness", "code", 0.5),
        quality.Rule("Completeness", "absent", 0.5),
    )
    got = {(r.rule, r.column): (r.value, r.passed) for r in quality.evaluate_ruleset(df, rules).collect()}
    assert got == {
        ("ColumnCount", None): (2.0, True),
        ("Uniqueness", "id"): (1.0, True),
        ("Completeness", "code"): (2 / 3, True),
        ("Uniqueness", "code"): (0.0, False),
        ("Completeness", "absent"): (None, False),
    }


def test_composite_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1), (None, 3)], "m string, n int")
    rules = (quality.Rule("Completeness", ("m", "n"), 0.5), quality.Rule("Uniqueness", ("m", "n"), 0.5))
    got = {(r.rule, r.column): round(r.value, 6) for r in quality.evaluate_ruleset(df, rules).collect()}
    assert got == {("Completeness", "m,n"): 0.8, ("Uniqueness", "m,n"): 0.5}
