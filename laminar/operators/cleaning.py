"""Bronze -> silver cleaning.

Each rule is a DataFrame -> DataFrame function and fires only when its column exists,
as in the published job. Bad dates and numbers become null / 0.0 through ``try_*``
functions, so the rules also hold with ANSI mode on (the Spark 4 default).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns each rule looks for, the date format, the e-mail pattern
# and the audit label.
KEY_COLUMN = "id"
DATE_COLUMNS = ("created_date", "updated_date", "transaction_date")
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
NUMERIC_COLUMNS = ("amount", "quantity", "price", "total")
EMAIL_COLUMN = "email"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
DATA_SOURCE_LABEL = "bronze_layer"
# Fixed value: most hashes of repeated rows that are handed to every task (a few MB).
MAX_REPEATED = 500_000


def _c(name: str) -> Column:
    """Column by exact name (raw names may hold spaces, dashes, dots or backticks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows equal in every column collapse to one (map-side partial dedup first)."""
    return df.dropDuplicates()


def _hashable(df: DataFrame) -> bool:
    """Whether rows that are equal in every column also have equal hashes: collated text may
    not, and names that differ in case alone cannot be told apart."""
    names = {c.lower() for c in df.columns}
    return bool(names) and len(names) == len(df.columns) and not any("collate" in t for _, t in df.dtypes)


def drop_repeated_rows(df: DataFrame, seen: Observation, max_repeated: int = MAX_REPEATED) -> DataFrame:
    """C1 of a large table, where most rows occur once: only row hashes are grouped, and only
    rows whose hash occurs again are compared in full; all others stay where they are. A job
    runs when this is called; ``seen`` then has the number of rows (``n``). With more than
    ``max_repeated`` such hashes, or where hashes don't tell, all rows are grouped."""
    if not _hashable(df):
        return drop_exact_duplicates(df.observe(seen, F.count(F.lit(1)).alias("n")))
    from laminar.session import shared_root

    shared_root(df.sparkSession)
    # 40 bits: fewer bytes to shuffle; chance collisions are compared like repeated rows
    row_hash = F.shiftright(F.xxhash64(*[_c(c) for c in df.columns]), 24)
    hashes = df.select(row_hash.alias("__hash")).groupBy("__hash").agg(F.count(F.lit(1)).alias("__n"))
    hashes = hashes.observe(seen, F.sum("__n").alias("n"))
    repeated = hashes.where("__n > 1").select("__hash").checkpoint(eager=True)
    found = repeated.limit(max_repeated + 1).count()
    if not found:
        return df
    if found > max_repeated:
        return drop_exact_duplicates(df)
    part = lambda how: df.join(F.broadcast(repeated), row_hash == F.col("__hash"), how)
    return part("left_anti").union(drop_exact_duplicates(part("left_semi")))


def drop_null_keys(df: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    """Only when a column is named exactly ``key`` (case-sensitive, before renaming)."""
    if key in df.columns:
        return df.where(_c(key).isNotNull())
    return df


def normalized_name(name: str) -> str:
    return name.lower().replace(" ", "_").replace("-", "_")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Lower case, spaces and dashes to underscores, in one projection.

    Two source names that normalize alike would make an ambiguous table; that is
    reported here instead of at write time.
    """
    new = [normalized_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both normalize to {n!r}")
        seen[n] = old
    return df.select(*[_c(old).alias(n) for old, n in zip(df.columns, new)])


def add_audit_columns(
    df: DataFrame,
    run_ts: _dt.datetime | None = None,
    run_date: _dt.date | None = None,
    source_label: str = DATA_SOURCE_LABEL,
) -> DataFrame:
    """C4: processed_timestamp, data_source, processing_date (clock unless pinned)."""
    return df.withColumns(
        {
            "processed_timestamp": F.lit(run_ts) if run_ts is not None else F.current_timestamp(),
            "data_source": F.lit(source_label),
            "processing_date": F.lit(run_date) if run_date is not None else F.current_date(),
        }
    )


def parse_dates(
    df: DataFrame, columns: Sequence[str] = DATE_COLUMNS, fmt: str = DATE_FORMAT
) -> DataFrame:
    """Text in ``fmt`` to a timestamp without time zone; anything else (including a
    date without time) becomes null."""
    present = {}
    types = dict(df.dtypes)
    for name in columns:
        if name not in types:
            continue
        if types[name] == "string":
            present[name] = F.try_to_timestamp(_c(name), F.lit(fmt)).cast("timestamp_ntz")
        else:
            present[name] = _c(name).cast("timestamp_ntz")
    return df.withColumns(present) if present else df


def coerce_numbers(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """To double; null or unparsable becomes 0.0."""
    present = {
        name: F.coalesce(_c(name).try_cast(T.DoubleType()), F.lit(0.0))
        for name in columns
        if name in df.columns
    }
    return df.withColumns(present) if present else df


def flag_emails(df: DataFrame, column: str = EMAIL_COLUMN, pattern: str = EMAIL_PATTERN) -> DataFrame:
    """``email_valid`` by pattern; a null address is not valid."""
    if column not in df.columns:
        return df
    return df.withColumn("email_valid", F.coalesce(_c(column).rlike(pattern), F.lit(False)))


def correct_schema(df: DataFrame) -> DataFrame:
    """C5 -> C6 -> C7."""
    return flag_emails(coerce_numbers(parse_dates(df)))


def apply_quality_rules(
    df: DataFrame,
    run_ts: _dt.datetime | None = None,
    run_date: _dt.date | None = None,
    key: str = KEY_COLUMN,
) -> DataFrame:
    """C1 -> C2 -> C3 -> C4 -> C5..C7, in the published order."""
    out = drop_exact_duplicates(df)
    out = drop_null_keys(out, key)
    out = normalize_column_names(out)
    out = add_audit_columns(out, run_ts, run_date)
    return correct_schema(out)


def add_partition_columns(df: DataFrame, date_column: str = "processing_date") -> DataFrame:
    """Year / month / day of the processing date."""
    d = _c(date_column)
    return df.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})


def clean_for_silver(
    df: DataFrame,
    run_ts: _dt.datetime | None = None,
    run_date: _dt.date | None = None,
    key: str = KEY_COLUMN,
) -> DataFrame:
    """C0 then C8: the frame the silver sink writes."""
    return add_partition_columns(apply_quality_rules(df, run_ts, run_date, key))


def cleaning_report(df: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    """C9 as a DataFrame: one grouping of the raw rows gives every count.

    Columns: input_rows, duplicates_removed, null_keys_removed, output_rows.
    """
    grouped = df.groupBy(*[_c(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    null_key = (
        F.sum(F.when(_c(key).isNull(), 1).otherwise(0))
        if key in df.columns
        else F.lit(0)
    )
    counts = grouped.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("input_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(null_key, F.lit(0)).cast("long").alias("null_keys_removed"),
    )
    return counts.select(
        "input_rows",
        (F.col("input_rows") - F.col("distinct_rows")).alias("duplicates_removed"),
        "null_keys_removed",
        (F.col("distinct_rows") - F.col("null_keys_removed")).alias("output_rows"),
    )


class ObservedCleaning:
    """C9 during a write: input rows are counted while the repeated ones are looked for
    (:func:`drop_repeated_rows`, when this is made), the others while the cleaned frame is
    written. Read :meth:`report` after the action has run."""

    def __init__(self, df: DataFrame, run_ts=None, run_date=None, key: str = KEY_COLUMN):
        tag = uuid.uuid4().hex[:8]  # observation names must not clash between queries
        self._in = Observation(f"clean_in_{tag}")
        self._dedup = Observation(f"clean_dedup_{tag}")
        self._out = Observation(f"clean_out_{tag}")
        distinct = drop_repeated_rows(df, self._in)
        dedup = distinct.observe(self._dedup, F.count(F.lit(1)).alias("n"))
        rest = drop_null_keys(dedup, key)
        rest = normalize_column_names(rest)
        rest = add_audit_columns(rest, run_ts, run_date)
        rest = add_partition_columns(correct_schema(rest))
        self.frame = rest.observe(self._out, F.count(F.lit(1)).alias("n"))

    def report(self) -> dict[str, int]:
        from laminar.sources.layers import observed_count

        n_in = observed_count(self._in, "n")
        n_dedup = observed_count(self._dedup, "n")
        n_out = observed_count(self._out, "n")
        return {
            "input_rows": n_in,
            "duplicates_removed": n_in - n_dedup,
            "null_keys_removed": n_dedup - n_out,
            "output_rows": n_out,
        }
