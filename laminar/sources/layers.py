"""Layer reads and writes, lineage, and catalog registration.

Layers are folders of Parquet tables under a root each (``<root>/<table>/``),
optionally registered in the session catalog. Writes are partitioned by
``year/month/day``; gold writes replace only the partitions of the run's day
(dynamic partition overwrite), so a retried job rewrites instead of appending twice.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminar.session import PARQUET_BLOCK_SIZE, PARQUET_PAGE_SIZE

# Partition columns of every layer and the lineage transformation labels.
PARTITION_COLUMNS = ("year", "month", "day")
LOAD_PARTITION_COLUMNS = ("load_year", "load_month", "load_day")
LINEAGE_COLUMNS = (
    "source_table",
    "target_table",
    "transformation_type",
    "execution_time",
    "job_name",
    "record_count",
    "processing_time",
)
LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("transformation_type", T.StringType()),
        T.StructField("execution_time", T.TimestampType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("processing_time", T.DoubleType()),
    ]
)


def observed_count(obs: Observation, name: str = "rows") -> int:
    """The count an Observation collected during an action that has run. A frame
    with no partitions reports no metrics at all (there is no row to convert: a null
    pointer or a failed assertion in the JVM); that is zero rows. Any other failure is raised."""
    try:
        value = obs.get.get(name)
    except Py4JJavaError as e:
        missing = ("NullPointerException", "AssertionError")
        if e.java_exception.getClass().getSimpleName() not in missing:
            raise
        return 0
    return int(value or 0)


def read_table(spark: SparkSession, name_or_path: str, merge_schema: bool = False) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path.

    ``merge_schema`` unions the file schemas (columns added over time), as schema
    discovery would; partition columns come from the ``name=value`` folders either way. A
    folder that holds a versioned table is read at its latest version; a table that a stopped
    :func:`publish` left aside is put back first.
    """
    from laminar.sources import snapshots

    if "/" in name_or_path or ":" in name_or_path:
        if snapshots.is_versioned(spark, name_or_path):
            return snapshots.read(spark, name_or_path)
        recover(spark, name_or_path)
        return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(name_or_path)
    return spark.table(name_or_path)


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a layer table's files (of its latest version, if it is versioned)."""
    from laminar.session import input_bytes
    from laminar.sources import snapshots

    if snapshots.is_versioned(spark, path):
        return snapshots.size_bytes(spark, path)
    return input_bytes(spark, [path])


def _parquet_writer(df: DataFrame, partition_cols: Sequence[str]):
    writer = (
        df.write.option("compression", "snappy")
        .option("parquet.block.size", str(PARQUET_BLOCK_SIZE))
        .option("parquet.page.size", str(PARQUET_PAGE_SIZE))
    )
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    return writer


def write_layer(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = PARTITION_COLUMNS,
    mode: str = "append",
) -> None:
    """Parquet/snappy, 128 MB row groups, 1 MB pages, partitioned by date parts.

    ``overwrite`` replaces the whole folder, all its dates, whatever the session's
    partition overwrite mode is: the new content is written beside it and published
    when complete. No repartitioning by the partition columns: they hold the run date, one value
    per run, and clustering on them would send every row to a single task.
    """
    if mode != "overwrite":
        _parquet_writer(df, partition_cols).mode(mode).parquet(path)
        return
    recover(df.sparkSession, path)
    staging = staging_path(path)
    try:
        _parquet_writer(df, partition_cols).mode("errorifexists").parquet(staging)
        publish(df.sparkSession, staging, path)
    finally:
        remove_folder(df.sparkSession, staging)


def _file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system): any store Spark can write."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def staging_path(path: str) -> str:
    """A new hidden folder beside ``path`` to write its next content to."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_staging-{name}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, staging: str, path: str) -> None:
    """Put a fully written (and checked) folder in the place of the table at ``path``.

    The table stays as it is until the new content is complete: a failed write leaves the
    old one. The old folder is renamed aside, put back if the second rename fails, and
    removed at the end; between the two renames a reader finds no table, and :func:`recover`
    puts the old one back if the job stopped there. Versioned tables
    (:mod:`laminar.sources.snapshots`) have no such gap and move no data.
    """
    new, fs = _file_system(spark, staging)
    target, _ = _file_system(spark, path)
    old, _ = _file_system(spark, staging.replace("/_staging-", "/_old-"))
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot publish {staging} as {path}")
    inside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, new.getName())
    if fs.exists(inside):  # a table had come back there: a rename goes into it then
        fs.delete(inside, True)
        raise OSError(f"{path} came back while {staging} was published")
    if had:
        fs.delete(old, True)


def recover(spark: SparkSession, path: str) -> bool:
    """Put back the table that a stopped :func:`publish` had renamed aside, if nothing has
    its place; whether it did. (While a publish runs, between its renames, this would undo
    the first of them: the publish then fails and the old table stays.)"""
    target, fs = _file_system(spark, path)
    if fs.exists(target):
        return False
    parent = target.getParent()
    name = f"_old-{target.getName()}-"
    if parent is None or not fs.exists(parent):
        return False
    aside = [st for st in fs.listStatus(parent) if st.getPath().getName().startswith(name)]
    # the suffix of a publish has 12 hex digits: tables with longer names are others
    aside = [st for st in aside if len(st.getPath().getName()) == len(name) + 12]
    if not aside:
        return False
    latest = max(aside, key=lambda st: st.getModificationTime())
    return bool(fs.rename(latest.getPath(), target))


def add_gold_metadata(
    df: DataFrame,
    dataset_name: str,
    run_ts: _dt.datetime | None = None,
    run_date: _dt.date | None = None,
) -> DataFrame:
    """S8 metadata: created_timestamp, dataset_name and the load date parts.

    A dataset that already has ``year``/``month`` columns of its own (monthly
    metrics) keeps them; the load date then goes to ``load_year/load_month/load_day``.
    Likewise a dataset with its own ``dataset_name`` column (the job summary) keeps
    it, and the sink's label goes to ``gold_dataset``.
    """
    ts = F.lit(run_ts) if run_ts is not None else F.current_timestamp()
    day = F.lit(run_date) if run_date is not None else F.current_date()
    names = (
        LOAD_PARTITION_COLUMNS
        if any(c in df.columns for c in PARTITION_COLUMNS)
        else PARTITION_COLUMNS
    )
    label = "gold_dataset" if "dataset_name" in df.columns else "dataset_name"
    return df.withColumns(
        {
            "created_timestamp": ts,
            label: F.lit(dataset_name),
            names[0]: F.year(day),
            names[1]: F.month(day),
            names[2]: F.dayofmonth(day),
        }
    )


def gold_partition_columns(df: DataFrame) -> tuple[str, ...]:
    return LOAD_PARTITION_COLUMNS if "load_year" in df.columns else PARTITION_COLUMNS


def write_gold(
    df: DataFrame,
    gold_root: str,
    dataset_name: str,
    run_ts: _dt.datetime | None = None,
    run_date: _dt.date | None = None,
) -> dict:
    """Write one gold dataset, replacing only this run's partition.

    Returns ``{"path", "record_count"}``; the count is read from the footers of the files
    written, which retried tasks cannot inflate. An empty result leaves an empty partition:
    rows that an earlier run of the day wrote go.
    """
    spark = df.sparkSession
    path = f"{gold_root.rstrip('/')}/{dataset_name}"
    out = add_gold_metadata(df, dataset_name, run_ts, run_date)
    columns = gold_partition_columns(out)
    day = run_date or spark.range(1).select(F.current_date()).first()[0]
    part = "/".join([path, *[f"{k}={v}" for k, v in zip(columns, (day.year, day.month, day.day))]])
    before = _file_names(spark, part)
    (
        _parquet_writer(out, columns)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )
    # Dynamic overwrite replaces only partitions that have rows: files of before that are
    # still there (names are new in every write) belong to an earlier run.
    if _file_names(spark, part) <= before:
        remove_folder(spark, part)
        return {"path": path, "record_count": 0}
    written = spark.read.schema(out.drop(*columns).schema).parquet(part)
    return {"path": path, "record_count": written.count()}


def _file_names(spark: SparkSession, path: str) -> set[str]:
    p, fs = _file_system(spark, path)
    return {st.getPath().getName() for st in fs.listStatus(p)} if fs.exists(p) else set()


def lineage_record(
    spark: SparkSession,
    job_name: str,
    source_table: str,
    target_table: str,
    record_count: int,
    processing_time: float,
    transformation_type: str = "bronze_to_silver",
    execution_time: _dt.datetime | None = None,
) -> DataFrame:
    """One lineage row (schema of the declared lineage table plus count and time)."""
    row = (
        source_table,
        target_table,
        transformation_type,
        execution_time or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
        job_name,
        int(record_count),
        float(processing_time),
    )
    return spark.createDataFrame([row], LINEAGE_SCHEMA)


def append_lineage(lineage_df: DataFrame, lineage_path: str) -> None:
    """Add records to the external Parquet lineage table.

    Each call writes its own ``record_id=<uuid>`` folder: concurrent writers (jobs in
    one driver, or several drivers) never share the committer's temporary folder, as
    they would when appending to one path. Readers see ``record_id`` as a column.
    """
    path = f"{lineage_path.rstrip('/')}/record_id={uuid.uuid4().hex}"
    lineage_df.write.mode("errorifexists").option("compression", "snappy").parquet(path)


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    partitioned: bool = True,
) -> DataFrame:
    """Register a Parquet folder in the session catalog and discover partitions.

    A table of that name at the same place is kept and its partitions are discovered
    again; one at another place is not touched, that is an error."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    place = lambda p: p.split(":", 1)[-1].replace("//", "/").rstrip("/")
    if told is None or place(told["data_type"]) != place(path):
        raise ValueError(f"{name} exists at {told and told['data_type']}, not at {path}")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def register_views(tables: dict[str, DataFrame]) -> None:
    """S13 helper: expose DataFrames to ``spark.sql`` under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


class Timer:
    """Wall-clock seconds for lineage and job summaries."""

    def __init__(self) -> None:
        self.start = time.monotonic()

    def seconds(self) -> float:
        return time.monotonic() - self.start


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
