"""Intermediate tables in the cluster's shared folder, and scoped caching."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    A local session without the setting gets a folder of its own; on a cluster the
    setting is required, because a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="tabwright-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path never handed out before; what is written there goes when the application ends."""
    folder = f"{shared_folder(spark)}/tabwright/{spark.sparkContext.applicationId}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop_path)
    files.deleteOnExit(hadoop_path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


_open_scopes: list[list[str]] = []


@contextmanager
def scoped_staging(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside the block at its end, errors included.

    A table that is still read afterwards must be staged outside, or under ``keep``.
    """
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and carry on from the written table.

    Cuts the lineage, survives the loss of executors, fixes the row order for the
    readers, and keeps column pruning and filter pushdown for them. Inside
    ``scoped_staging`` the table goes at the end of the block, unless ``keep``.
    """
    path = scratch_path(df.sparkSession, name)
    if _open_scopes and not keep:
        _open_scopes[-1].append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside the block, a query's shuffle files go when it ends, not when the driver next collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP_SETTING, None)
    spark.conf.set(SHUFFLE_CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_SETTING)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_SETTING, before)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``, for column types that Parquet cannot hold."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def persisted(
    *frames: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames that are read several times, and release them on the way out."""
    held = tuple(f.persist(level) for f in frames)
    try:
        yield held
    finally:
        for f in held:
            f.unpersist()
