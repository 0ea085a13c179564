"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp rule in this package reads wall time as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting (tests, a laptop) gets a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def settle(frame: DataFrame) -> DataFrame:
    """Materialise a frame reliably: executors may be lost afterwards."""
    checkpoint_root(frame.sparkSession)
    return frame.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder for an intermediate table."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: A file counts as 4 MB when Spark deals files to tasks, so a task gets 32 small ones; this way it gets some thousands.
OPEN_COST, SMALL_OPEN_COST = "spark.sql.files.openCostInBytes", str(64 << 10)


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """While it holds, what is computed may read thousands of small files in one task."""
    before = spark.conf.get(OPEN_COST)
    spark.conf.set(OPEN_COST, SMALL_OPEN_COST)
    try:
        yield
    finally:
        spark.conf.set(OPEN_COST, before)


#: Batches that go to Python hold 10,000 rows and up to 64 MB by default; texts of some kilobytes then cost an executor hundreds of megabytes.
BATCH_BYTES, SMALL_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"


def bounded_batches(spark: SparkSession) -> None:
    """From now on this session cuts what it hands to Python by bytes as well; rows and results stay the same."""
    spark.conf.set(BATCH_BYTES, SMALL_BATCH)


def written(frame: DataFrame, name: str) -> DataFrame:
    """A frame written once to the shared folder and read again: computed once, its lineage ends there."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)
