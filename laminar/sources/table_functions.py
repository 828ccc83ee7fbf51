"""Gold datasets as SQL table functions, called with a run date or a date of reference.

    SELECT * FROM customer_analytics_on(DATE '2024-05-01')
    SELECT * FROM customers_as_of(DATE '2024-05-01', DATE '2024-08-01')

The functions are Spark SQL functions over registered gold tables: Spark puts their body in
place of the call, so that a constant run date prunes the partitions of the scan and only
the columns that the query uses are read. No Python runs. A run date without a partition, or
a null one, gives no rows.

Spark calls table functions by a bare name: the session's own (``temporary``, the default) or
one of the current database, where ``temporary=False`` keeps them for other sessions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from laminar.functions import labels
from laminar.sources import layers
from laminar.sources.catalog import _columns, literal, quoted


def _partition_columns(schema: T.StructType) -> Sequence[str] | None:
    for names in (layers.LOAD_PARTITION_COLUMNS, layers.PARTITION_COLUMNS):
        if all(n in schema.names for n in names):
            return names
    return None


def _on_run_date(schema: T.StructType, function: str) -> str:
    parts = _partition_columns(schema)
    if parts is None:
        raise ValueError(f"the table of {function} has no run date")
    told = f"{quoted(function)}.run_date"
    taken = zip(("year", "month", "day"), parts)
    return " AND ".join(f"t.{quoted(c)} = {f}({told})" for f, c in taken)


def _create(
    spark: SparkSession, database: str, function: str, arguments: str, schema: T.StructType, body: str, temporary: bool
) -> str:
    kind, name = ("TEMPORARY FUNCTION", function) if temporary else ("FUNCTION", f"{database}.{function}")
    spark.sql(
        f"CREATE OR REPLACE {kind} {quoted(name)}({arguments}) "
        f"RETURNS TABLE ({_columns(schema, ())}) RETURN {body}"
    )
    return name


def register_run_functions(
    spark: SparkSession, database: str, datasets: Sequence[str], temporary: bool = True
) -> list[str]:
    """``<dataset>_on(run_date DATE)`` for each registered gold dataset: the rows of a run,
    with all columns of the table. Calling it again brings the functions to the tables'
    present columns. Returns the functions' names."""
    made = []
    for dataset in datasets:
        function = f"{dataset}_on"
        schema = spark.table(f"{database}.{dataset}").schema
        columns = ", ".join(f"t.{quoted(c)}" for c in schema.names)
        body = (
            f"SELECT {columns} FROM {quoted(f'{database}.{dataset}')} t "
            f"WHERE {_on_run_date(schema, function)}"
        )
        made.append(_create(spark, database, function, "run_date DATE", schema, body, temporary))
    return made


def _bands_sql(value: str, bands, otherwise: str) -> str:
    cases = " ".join(f"WHEN {value} > {literal(limit)} THEN {literal(label)}" for limit, label in bands)
    return f"CASE {cases} ELSE {literal(otherwise)} END"


def register_as_of(
    spark: SparkSession, database: str, dataset: str = "customer_analytics", temporary: bool = True
) -> str:
    """``customers_as_of(run_date DATE, as_of DATE)``: a run's customers with E3 and E5, what
    depends on the day of looking, told for another day. A null ``as_of`` gives null days
    and the last churn label, as customers without transactions have."""
    function = "customers_as_of"
    schema = spark.table(f"{database}.{dataset}").schema
    days = f"datediff({function}.as_of, t.last_transaction_date)"
    told = {
        "days_since_last_transaction": days,
        "churn_risk": _bands_sql(days, labels.CHURN_BANDS, labels.CHURN_OTHERWISE),
    }
    columns = ", ".join(f"{told[c]} AS {quoted(c)}" if c in told else f"t.{quoted(c)}" for c in schema.names)
    body = (
        f"SELECT {columns} FROM {quoted(f'{database}.{dataset}')} t "
        f"WHERE {_on_run_date(schema, function)}"
    )
    return _create(spark, database, function, "run_date DATE, as_of DATE", schema, body, temporary)
