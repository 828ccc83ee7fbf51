"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import laminar
from laminar.session import shared_root

# Fixed value: what separates words (space and the controls 9 to 13), and a word.
WORD = r"[^\x20\x09-\x0D]+"
# Fixed value: bytes of whole texts that Spark hands to a Python worker at a time.
BATCH_BYTES, BATCH_ROWS = 2 << 20, 1_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, prefixed until no column of ``df`` has them (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    prefix = "_"
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return [prefix + n for n in names]


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: lineage is cut, every executor can
    read it again, and it is computed once."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def workers_import_package() -> None:
    """Let Python workers started from now on find this package where the driver found it (a
    cluster that gets it by --py-files, or has it installed, needs nothing more)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(laminar.__file__)))
    env = SparkSession.active().sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if os.path.isdir(root) and root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def small_batches(spark: SparkSession) -> None:
    """Let whole texts go to the Python workers in batches of about ``BATCH_BYTES`` and at most
    ``BATCH_ROWS`` rows (Spark's default is 10,000 rows of any size, held several times over by
    executor and worker). Holds for the session from now on, since plans are made when they
    run; smaller settings stay."""
    for name, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        key = f"spark.sql.execution.arrow.{name}"
        now = re.match(r"(-?\d+)b?$", spark.conf.get(key), re.IGNORECASE)
        if now and not 0 < int(now[1]) <= most:
            spark.conf.set(key, str(most))
