"""Schema discovery on change (S12): what each load's files hold, against what came before.

The schema of a load is merged from the footers of its files (one distributed job reading
footers only). It is appended to a schema-history table, a row per column, and compared
with the loads before it: columns added, lost, or retyped. A retyped column is widened
where one type holds the values of both (``byte < short < int < long < decimal``,
``float < double``, ``int < double``, ``date < timestamp_ntz``: what Spark's Parquet reader
can read as the wider type), otherwise the two conflict.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HISTORY_SCHEMA = "table_name string, load long, position int, column string, type string"

# Whole-number types from narrow to wide, with their decimal digits.
WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
# Whole-number types that a floating type holds exactly.
EXACT_IN = {"double": ("tinyint", "smallint", "int")}


def widened_type(a: str, b: str) -> str | None:
    """The narrowest type that holds the values of both (DDL names), None if none does."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if x in WHOLE and y in WHOLE and WHOLE[x] < WHOLE[y]:
            return y
        if x in EXACT_IN.get(y, ()):
            return y
        if (x, y) in (("float", "double"), ("date", "timestamp_ntz")):
            return y
        if y.startswith("decimal") and (x in WHOLE or x.startswith("decimal")):
            return _wider_decimal(x, y)
    return None


def _wider_decimal(a: str, b: str) -> str | None:
    def digits(t: str) -> tuple[int, int]:
        if t in WHOLE:
            return WHOLE[t], 0
        precision, scale = t[len("decimal("):-1].split(",")
        return int(precision) - int(scale), int(scale)

    (whole_a, scale_a), (whole_b, scale_b) = digits(a), digits(b)
    whole, scale = max(whole_a, whole_b), max(scale_a, scale_b)
    return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else None


def merged_schema(old: dict | None, new: dict) -> dict:
    """JSON schemas merged: columns of the old first, then new ones; retyped columns widened.
    Two types without a common one are an error."""
    if old is None:
        return new
    fields = {f.name: f for f in T.StructType.fromJson(old)}
    for f in T.StructType.fromJson(new):
        have = fields.get(f.name)
        if have is None or have.dataType == f.dataType:
            fields.setdefault(f.name, f)
            continue
        wide = widened_type(have.dataType.simpleString(), f.dataType.simpleString())
        if wide is None:
            raise ValueError(
                f"column {f.name}: {have.dataType.simpleString()} and {f.dataType.simpleString()} have no common type"
            )
        fields[f.name] = T.StructField(f.name, T._parse_datatype_string(wide))
    return json.loads(T.StructType(list(fields.values())).json())


def load_schema(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(column, type) of the files of one load, merged from all their footers; partition
    columns included."""
    read = spark.read.option("mergeSchema", "true").parquet(path)
    return [(f.name, f.dataType.simpleString()) for f in read.schema]


def record_schema(spark: SparkSession, history_path: str, table: str, load: int, path: str) -> None:
    """Append what a load's files hold to the schema-history table. The rows of one load go
    to a folder of their own, which a repeated run replaces."""
    rows = [(table, load, i, c, t) for i, (c, t) in enumerate(load_schema(spark, path))]
    folder = f"{history_path.rstrip('/')}/recorded={table}-{load}"
    spark.createDataFrame(rows, HISTORY_SCHEMA).coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(folder)


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    read = spark.read.schema(HISTORY_SCHEMA + ", recorded string").parquet(history_path)
    return read.drop("recorded")


def schema_changes(history: DataFrame) -> DataFrame:
    """(table_name, load, column, change, old_type, new_type, widened): one row per column
    that a load added, lost or retyped against the load before it in which the table was
    seen; the first load of a table adds nothing. ``widened`` is the type that holds both
    (null: they conflict, or the column was added or lost)."""
    loads = history.select("table_name", "load").distinct()
    order = Window.partitionBy("table_name").orderBy("load")  # a row per load
    steps = loads.withColumn("before", F.lag("load").over(order)).where("before is not null")
    new = history.select("table_name", "load", "column", F.col("type").alias("new_type"))
    old = history.select(
        "table_name", F.col("load").alias("before"), "column", F.col("type").alias("old_type")
    )
    new = new.join(steps, ["table_name", "load"])
    old = old.join(steps, ["table_name", "before"])
    both = new.join(old, ["table_name", "load", "before", "column"], "full")
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "lost")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    changed = both.withColumn("change", change).where("change is not null")
    return changed.select(
        "table_name", "load", "column", "change", "old_type", "new_type",
        _widened(F.col("old_type"), F.col("new_type")).alias("widened"),
    )


def _widened(a, b):
    """:func:`widened_type` on columns, for the types without parameters; decimals are
    widened by their digits."""
    names = [*WHOLE, "float", "double", "date", "timestamp_ntz"]
    pairs = [(x, y, w) for x in names for y in names if x != y and (w := widened_type(x, y))]
    out = F.lit(None).cast("string")
    for x, y, w in pairs:
        out = F.when((a == x) & (b == y), w).otherwise(out)

    def digits(t):
        known = F.lit(None).cast("int")
        for name, n in WHOLE.items():
            known = F.when(t == name, n).otherwise(known)
        precision = F.regexp_extract(t, r"^decimal\((\d+),(\d+)\)$", 1).try_cast("int")
        scale = F.regexp_extract(t, r"^decimal\((\d+),(\d+)\)$", 2).try_cast("int")
        return F.coalesce(known, precision - scale), F.coalesce(scale, F.lit(0))

    (whole_a, scale_a), (whole_b, scale_b) = digits(a), digits(b)
    whole, scale = F.greatest(whole_a, whole_b), F.greatest(scale_a, scale_b)
    decimal = F.concat(
        F.lit("decimal("), (whole + scale).cast("string"), F.lit(","), scale.cast("string"), F.lit(")")
    )
    is_decimal = (a.startswith("decimal") | b.startswith("decimal")) & whole_a.isNotNull() & whole_b.isNotNull()
    return F.when(is_decimal & (whole + scale <= 38), decimal).otherwise(out)
