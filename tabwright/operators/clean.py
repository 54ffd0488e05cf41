"""Trimming, casting, defaults for missing text, keyed deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tabwright.functions import blank_to_null, to_double


def trim_all(df: DataFrame) -> DataFrame:
    """Trim every column and keep its name; every column becomes text."""
    return df.select([F.trim(F.col(c).cast("string")).alias(c) for c in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim the text columns; numbers keep their type and their digits."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select([F.trim(c).alias(c) if c in text else F.col(c) for c in df.columns])


def blanks_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: blank_to_null(c) for c in columns})


def cast_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to double; blank or malformed text becomes null."""
    return df.withColumns({c: to_double(c) for c in columns})


def fill_text(
    df: DataFrame, columns: Sequence[str], default: str, blank_as_null: bool = False
) -> DataFrame:
    """Replace null text by ``default``; blank text too when ``blank_as_null`` is set."""
    if blank_as_null:
        df = blanks_to_null(df, columns)
    return df.fillna({c: default for c in columns})


def dedup(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """The first row of each key, in the order of ``order_by``.

    Without ``order_by`` all other columns order the rows, so the kept row does not
    depend on the layout. Null keys form one group. The rank limit makes Spark keep one
    row per key and map task before the shuffle, so a hot key costs one row per task.
    """
    order = list(order_by) if order_by else [c for c in df.columns if c not in keys]
    if not order:
        return df.dropDuplicates(list(keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
