"""Data-quality rulesets (Q1-Q4): ColumnCount, Completeness, Uniqueness.

A ruleset is evaluated with one grouping of the key column (partial aggregation,
so a hot key value costs one row per task) and one global aggregate on top.
Uniqueness is the share of non-null rows whose value occurs exactly once.
A rule on a column the table lacks yields a failed row, not an exception.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str  # "ColumnCount" | "Completeness" | "Uniqueness"
    column: str | tuple[str, ...] | None  # a tuple is a composite key
    threshold: float

    @property
    def columns(self) -> tuple[str, ...]:
        if self.column is None:
            return ()
        return (self.column,) if isinstance(self.column, str) else tuple(self.column)

    @property
    def label(self) -> str | None:
        return None if self.column is None else ",".join(self.columns)


# The ruleset every layer declares.
DEFAULT_RULESET = (
    Rule("ColumnCount", None, 0.0),
    Rule("Completeness", "id", 0.95),
    Rule("Uniqueness", "id", 0.99),
)


def _key_stats(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """One row: total rows, non-null keys, keys occurring exactly once. A composite
    key counts as present only when all its columns are."""
    keys = [F.col("`" + n.replace("`", "``") + "`").alias(f"__v{i}") for i, n in enumerate(names)]
    present = None
    for i in range(len(names)):
        c = F.col(f"__v{i}").isNotNull()
        present = c if present is None else present & c
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).withColumn("__v", F.when(present, 1))
    return g.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("total"),
        F.coalesce(F.sum(F.when(F.col("__v").isNotNull(), F.col("__n"))), F.lit(0))
        .cast("long")
        .alias("non_null"),
        F.coalesce(F.sum(F.when(F.col("__v").isNotNull() & (F.col("__n") == 1), 1)), F.lit(0))
        .cast("long")
        .alias("singles"),
    )


def _rule_row(r: Rule, n_columns: int, has_stats: bool):
    if r.kind == "ColumnCount":
        value = F.lit(float(n_columns))
    elif r.kind not in ("Completeness", "Uniqueness"):
        raise ValueError(f"unknown rule {r.kind!r}")
    elif not has_stats:  # the column is missing: a failed rule, not an error
        value = F.lit(None).cast("double")
    elif r.kind == "Completeness":
        value = F.try_divide(F.col("non_null").cast("double"), F.col("total").cast("double"))
    else:
        value = F.try_divide(F.col("singles").cast("double"), F.col("non_null").cast("double"))
    return F.struct(
        F.lit(r.kind).alias("rule"),
        F.lit(r.label).cast("string").alias("column"),
        value.alias("value"),
        F.lit(float(r.threshold)).alias("threshold"),
        F.coalesce(value > F.lit(float(r.threshold)), F.lit(False)).alias("passed"),
    )


def evaluate_ruleset(df: DataFrame, rules=DEFAULT_RULESET) -> DataFrame:
    """Q4: one row per rule -> rule, column, value, threshold, passed (value > threshold).

    One grouping per column the rules examine (partial aggregation, so a hot value
    costs one row per task), one global aggregate on top of each; rules that need no
    statistics ride along with the first of them.
    """
    if not rules:  # empty ruleset: typed, empty result
        return df.agg(F.count(F.lit(1))).select(
            F.lit(None).cast("string").alias("rule"),
            F.lit(None).cast("string").alias("column"),
            F.lit(None).cast("double").alias("value"),
            F.lit(None).cast("double").alias("threshold"),
            F.lit(None).cast("boolean").alias("passed"),
        ).where(F.lit(False))
    groups: dict[tuple[str, ...] | None, list[Rule]] = {}
    for r in rules:
        usable = r.kind != "ColumnCount" and r.columns and all(c in df.columns for c in r.columns)
        groups.setdefault(r.columns if usable else None, []).append(r)
    keyed = [k for k in groups if k is not None]
    if keyed and None in groups:
        groups[keyed[0]] = groups.pop(None) + groups[keyed[0]]
    frames = []
    for key, rs in groups.items():
        base = _key_stats(df, key) if key else df.agg(F.count(F.lit(1)).alias("total"))
        rows = [_rule_row(r, len(df.columns), key is not None and r.columns == key) for r in rs]
        frames.append(base.select(F.inline(F.array(*rows))))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def quality_gate(results: DataFrame) -> list[dict]:
    """Raise if any rule failed; returns the (few) rule rows otherwise."""
    rows = [r.asDict() for r in results.collect()]
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise ValueError(f"data-quality rules failed: {failed}")
    return rows
