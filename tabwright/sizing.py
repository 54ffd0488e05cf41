"""Shuffle partitions in step with the stored input."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTING = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Stored bytes per shuffle partition.
PARTITION_BYTES = 256 * 1024**2


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files at ``path``, which may hold the wildcards that readers take."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(hadoop_path)
    if not found:
        raise FileNotFoundError(f"no files at {path}")
    return sum(files.getContentSummary(status.getPath()).getLength() for status in found)


@contextmanager
def sized_shuffles(spark: SparkSession, *paths: str) -> Iterator[int]:
    """Shuffle into enough partitions for the tables at ``paths`` while the block runs.

    The session's own number is only ever raised, without a ceiling; adaptive execution
    joins partitions that turn out small. Row sizes in memory differ from stored ones, so
    this is a starting point that spilling and skew handling build on. The setting is the
    session's: run jobs that overlap in sessions of their own (``spark.newSession()``).
    """
    before = spark.conf.get(SETTING, None)
    current = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-sum(stored_bytes(spark, p) for p in paths) // PARTITION_BYTES)
    partitions = max(current, wanted)
    spark.conf.set(SETTING, str(partitions))
    try:
        yield partitions
    finally:
        if before is None:
            spark.conf.unset(SETTING)
        else:
            spark.conf.set(SETTING, before)
