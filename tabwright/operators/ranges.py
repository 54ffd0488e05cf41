"""A total order over a table without a task that sees all of it.

Spark deals the rows by range and each keeps the number of its range, staged, so that it
stays the same for all that read it. What lies before a range is a sum over a row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.scratch import stage

RANGE = "_range"
RANGE_ROWS = 50_000


def in_ranges(df: DataFrame, order: Sequence[Column | str], ranges: int) -> DataFrame:
    """``df`` in about equal ranges of ``order``; ``_range`` numbers them in that order.

    Spark finds the borders from a sample that it bounds. Rows equal in ``order`` are in one
    range.
    """
    dealt = df.repartitionByRange(ranges, *order)
    return stage(dealt.withColumn(RANGE, F.spark_partition_id()), "ranges")


def numbered(df: DataFrame, order: Sequence[Column | str], name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` with the place of each row in ``order``, from 0; ``order`` must leave no ties."""
    ranges = max(1, -(-df.count() // range_rows))
    ranged = in_ranges(df, order, ranges)
    # A row per range, not per row of the table.
    sizes = ranged.groupBy(RANGE).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(RANGE, F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    return ranged.withColumn("_within", within).join(starts, RANGE).select(
        *df.columns, (F.col("_before") + F.col("_within") - 1).cast("long").alias(name)
    )
