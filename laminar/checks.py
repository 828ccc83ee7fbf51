"""Spark query vs SQL oracle comparison (row count, column names and types, values).

The comparison is order-insensitive: columns are sorted by name and rows by their
canonical text. Floats compare exactly by default; ``float_digits`` rounds them first.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math

# The test tables the oracle sees as views.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(
            f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')"
        )
    return con


def _canon(v, float_digits: int | None):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if float_digits is not None:
            return repr(round(v, float_digits) + 0.0)
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    return str(v)


def canonical_rows(columns, rows, float_digits=None):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = ["|".join(_canon(r[i], float_digits) for i in order) for r in rows]
    return sorted(columns), sorted(out)


_SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "tinyint": "TINYINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def duck_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type.upper().replace(" ", "")
    return _SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def type_mismatches(spark_df, con, sql: str) -> dict:
    """Columns whose Spark type does not map to the oracle's DuckDB type."""
    rel = con.sql(sql)
    duck = {c: str(t).replace(" ", "") for c, t in zip(rel.columns, rel.dtypes)}
    out = {}
    for c, t in spark_df.dtypes:
        want = duck.get(c)
        if want is not None and duck_type(t).replace(" ", "") != want:
            out[c] = (t, want)
    return out


def compare(spark_df, con, sql: str, float_digits: int | None = None) -> dict:
    """Run both sides and report differences (small results only: this is a test aid)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    sc, sr = canonical_rows(s_cols, s_rows, float_digits)
    dc, dr = canonical_rows(d_cols, d_rows, float_digits)
    result = {
        "spark_rows": len(sr),
        "oracle_rows": len(dr),
        "columns_match": sc == dc,
        "values_match": sc == dc and sr == dr,
    }
    bad_types = type_mismatches(spark_df, con, sql)
    result["types_match"] = not bad_types
    if bad_types:
        result["type_mismatches"] = bad_types
    if sc != dc:
        result["spark_only_cols"] = sorted(set(sc) - set(dc))
        result["oracle_only_cols"] = sorted(set(dc) - set(sc))
    elif sr != dr:
        ss, ds = set(sr), set(dr)
        result["spark_only_sample"] = sorted(ss - ds)[:3]
        result["oracle_only_sample"] = sorted(ds - ss)[:3]
        result["columns"] = sc
    return result
