"""Session construction and the shared working folder.

Configuration goes through the builder only: some settings (the serializer, for one)
cannot be changed on a running session in Spark 4.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The tuning the layered jobs ask for.
SKEW_PARTITION_THRESHOLD = "256MB"
PARQUET_BLOCK_SIZE = 134217728  # 128 MB row groups
PARQUET_PAGE_SIZE = 1048576  # 1 MB pages

BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # post-shuffle partitions (and so written files) of about one 128 MB row group
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": SKEW_PARTITION_THRESHOLD,
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.parquet.enableVectorizedReader": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # gold datasets are written as concurrent jobs; share executors fairly among them
    "spark.scheduler.mode": "FAIR",
    # ranking pins its range partitions with reliable checkpoints; drop them once unused
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "laminar",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the layered-analytics configuration."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Only a local-mode session without that setting (a test) gets a private folder,
    registered back as its checkpoint directory so later calls agree.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for the cluster"
            )
        current = spark.sparkContext.getCheckpointDir()
        if current:
            root = current
        else:
            root = tempfile.mkdtemp(prefix="laminar-")
    if not spark.sparkContext.getCheckpointDir():
        # DataFrame.checkpoint() writes to the context's folder: make it the shared one
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused sub-folder of the shared root (one per run, never reused)."""
    return f"{shared_root(spark)}/laminar/{label}-{uuid.uuid4().hex[:12]}"


def default_partitions(spark: SparkSession) -> int:
    """Partition count for operators that must fix one (range partitioning)."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


# Fixed value: target input bytes per shuffle partition when sizing from the input.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
# Fixed value: most shuffle partitions sized from the input (map outputs are cut as often).
MAX_SHUFFLE_PARTITIONS = 20_000


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (file-system metadata, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def size_shuffle_partitions(
    spark: SparkSession, total_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES
) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to about one partition per ``target_bytes``
    of input, at most ``MAX_SHUFFLE_PARTITIONS``, never lowering it. AQE coalesces partitions that turn out small, but it
    cannot split a shuffle that was planned with too few."""
    current = default_partitions(spark)
    wanted = max(current, min(MAX_SHUFFLE_PARTITIONS, math.ceil(total_bytes / target_bytes)))
    if wanted != current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


@contextmanager
def sized_shuffles(spark: SparkSession, total_bytes: int):
    """Shuffle partitions sized for so many bytes within the block, then set back."""
    before = spark.conf.get("spark.sql.shuffle.partitions", "200")
    size_shuffle_partitions(spark, total_bytes)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# Fixed value: the session setting that lets Spark remove a job's shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of jobs started within the block go as soon as their result is written or
    pinned. Otherwise they stay until the driver's garbage collection happens to find them: a
    flow of many jobs then holds the shuffles of all of them. (A frame that is run again
    shuffles again; Spark before 4.1 does not know the setting.)"""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
