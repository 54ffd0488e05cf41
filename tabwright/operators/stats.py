"""Counts, shares, profiles and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import weight_for


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows and non-null count, from one pass."""
    types = [t for _, t in df.dtypes]
    # Counts by position: a column may have any name.
    filled = [F.count(F.col(f"`{c.replace('`', '``')}`")).alias(f"_{i}") for i, c in enumerate(df.columns)]
    counts = df.agg(F.count("*").alias("n_rows"), *filled)
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(c).alias("column_name"),
                F.lit(t).alias("data_type"),
                F.col("n_rows").alias("n_rows"),
                F.col(f"_{i}").alias("non_null"),
            )
            for i, (c, t) in enumerate(zip(df.columns, types))
        ]
    )
    return counts.select(F.inline(entries))


def preview(df: DataFrame, *order_by: str, rows: int = 5) -> DataFrame:
    """The first rows; in the order of ``order_by`` when given."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count"))


def class_percentage(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share of the total per class; the total reuses the grouped counts."""
    counts = class_counts(df, label)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percentage", F.col("count") / total * 100)


def _balanced(total, rows):
    return total / (2.0 * rows)


def fit_class_weights(df: DataFrame, label: str = "label") -> dict[float, float]:
    """Balanced weights total / (2 * class size); both classes must be present."""
    row = df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(label) == 0.0).alias("negative"),
        F.count_if(F.col(label) == 1.0).alias("positive"),
    ).first()
    return weights_from_counts(row["total"], row["negative"], row["positive"])


def weights_from_counts(total: int, negative: int, positive: int) -> dict[float, float]:
    if negative + positive != total:
        raise ValueError("labels must be 0.0 or 1.0")
    if negative == 0 or positive == 0:
        raise ValueError("both classes must occur in the training rows")
    return {0.0: _balanced(total, negative), 1.0: _balanced(total, positive)}


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """The balanced weights as a table, one row per class."""
    counts = class_counts(df, label)
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(label, "count", _balanced(total, F.col("count")).alias("weight"))


def with_class_weight(
    df: DataFrame, weights: dict[float, float], label: str = "label", weight: str = "classWeight"
) -> DataFrame:
    return df.withColumn(weight, weight_for(label, weights))
