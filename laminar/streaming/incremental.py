"""S5 incremental bronze -> silver: each run cleans only files not seen before.

A file-source stream with ``trigger(availableNow=True)`` replaces job bookmarks: the
checkpoint records which files were processed, and it advances only after a batch
has been written (a failed run leaves it behind, unlike a bookmark committed in a
``finally``). Each micro-batch is written to its own ``batch_id=<n>`` folder in
overwrite mode, so a replayed batch replaces its own output instead of appending
twice. De-duplication is per batch, as in the batch job; the silver layer stays
an append log and gold is recomputed from it in full.

``versioned`` silver tables get a snapshot per micro-batch, published under the stream's id
and the batch number, so that a batch that was written but not committed by the stream is
replaced when it runs again. :func:`load_tables` loads several tables and publishes their
versions together, last of all: gold reads that load (``sources/snapshots.read_load``) and
never one table's new rows without the others'.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.util import inheritable_thread_target

from laminar.operators.cleaning import KEY_COLUMN, ObservedCleaning
from laminar.sources import snapshots
from laminar.sources.layers import PARTITION_COLUMNS, write_layer


def stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id that a stream keeps in its checkpoint from run to run."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir.rstrip('/')}/metadata")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def load_increment(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | None,
    silver_dir: str,
    checkpoint_dir: str,
    run_date: _dt.date | None = None,
    key: str = KEY_COLUMN,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    archive_dir: str | None = None,
    versioned: bool = False,
    after_batch: Callable[[dict], None] | None = None,
) -> list[dict]:
    """Process every new file under ``source_dir`` and stop; returns one cleaning
    report per micro-batch (empty when nothing new arrived).

    ``transform`` runs on each raw batch before the cleaning rules. If a batch fails,
    the query stops with the error and the checkpoint stays before that batch, so
    the next run processes the same files again.

    ``schema=None`` takes the schema from the Parquet footers already in
    ``source_dir`` (metadata only). ``archive_dir`` moves processed files there
    (``cleanSource=archive``), so later runs do not list an ever-growing folder.

    ``versioned``: ``silver_dir`` is a versioned table, a snapshot per batch. A stream whose
    checkpoint was lost reads all of ``source_dir`` again under a new id: its first batch
    takes the place of what the old stream had loaded. With ``archive_dir`` the files are no
    longer there to be read again, so what is loaded stays. ``after_batch`` is called with
    the report of each batch once it is written (published); if it fails, so does the batch.
    """
    if schema is None:
        schema = spark.read.format(fmt).load(source_dir).schema
    reports: list[dict] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if transform is not None:
            batch = transform(batch)
        observed = ObservedCleaning(batch, run_date=run_date, key=key)
        report: dict = {}
        if versioned:
            stream = stream_id(spark, checkpoint_dir)
            label = f"{stream}/{batch_id}"
            entry = snapshots.stage(observed.frame, silver_dir, PARTITION_COLUMNS)

            def replaced(e: dict) -> bool:
                other_stream = "/" in e["label"] and not e["label"].startswith(f"{stream}/")
                return e["label"] == label or (other_stream and not archive_dir)

            report["version"] = snapshots.commit(spark, silver_dir, entry, replaced, label)
        else:
            write_layer(
                observed.frame, f"{silver_dir.rstrip('/')}/batch_id={batch_id}", mode="overwrite"
            )
        report.update(observed.report())
        if versioned:
            report["output_rows"] = entry["rows"]
        report["batch_id"] = batch_id
        if after_batch is not None:
            after_batch(report)
        reports.append(report)

    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    query = (
        reader.load(source_dir)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return reports


@dataclass
class Source:
    """Where a table's new files land."""

    landing: str
    schema: StructType | None = None  # None: from the footers that are there
    key: str = KEY_COLUMN
    fmt: str = "parquet"
    transform: Callable[[DataFrame], DataFrame] | None = None
    archive_dir: str | None = None


def load_tables(
    spark: SparkSession,
    sources: dict[str, Source],
    silver_root: str,
    checkpoint_root: str,
    run_date: _dt.date | None = None,
    parallel: int = 3,
    max_files_per_trigger: int | None = None,
) -> dict:
    """Load what is new of several tables (silver name -> source) into versioned silver
    tables, at most ``parallel`` at once, then publish their versions as one load.

    If a table fails, no load is published and the reader of the last one sees none of the
    new rows; the next run goes on where each stream stopped. Returns the load's number and
    the batch reports. A load is published also if nothing new arrived (a run before may
    have stopped in between)."""
    from laminar.plans.layers import scheduler_pool

    root = silver_root.rstrip("/")

    def one(name: str) -> list[dict]:
        source = sources[name]
        with scheduler_pool(spark, f"load_{name}"):
            return load_increment(
                spark, source.landing, source.schema, f"{root}/{name}",
                f"{checkpoint_root.rstrip('/')}/{name}", run_date, source.key, source.fmt,
                max_files_per_trigger, source.transform, source.archive_dir, versioned=True,
            )

    with ThreadPoolExecutor(max_workers=max(1, parallel), thread_name_prefix="load") as pool:
        futures = {n: pool.submit(inheritable_thread_target(spark)(one), n) for n in sources}
        errors = [e for f in futures.values() if (e := f.exception()) is not None]
        if errors:
            raise errors[0]
        reports = {n: f.result() for n, f in futures.items()}
    versions = {n: snapshots.current_version(spark, f"{root}/{n}") for n in sources}
    versions = {n: v for n, v in versions.items() if v}  # nothing has arrived for the others yet
    load = snapshots.commit_load(spark, root, versions, {"run_date": str(run_date) if run_date else None})
    for name in versions:
        snapshots.vacuum(spark, f"{root}/{name}")
    return {"load": load, "versions": versions, "batches": reports}
