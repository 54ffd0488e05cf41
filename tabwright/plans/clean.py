"""Raw customer CSV to train and test tables."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.fixed import (
    CUSTOMERS,
    MEDIAN_ERROR,
    MISSING_CATEGORY,
    SEED,
    SERVICE_VALUES,
    TENURE_BOUNDS,
    TENURE_LABELS,
    TRAIN_SHARE,
    CustomerTable,
)
from tabwright.functions import binary_label, bucket, count_matching, safe_ratio
from tabwright.operators.clean import cast_doubles, dedup, fill_text, trim_strings
from tabwright.operators.impute import apply_medians, fit_medians
from tabwright.operators.split import in_first_part
from tabwright.scratch import scoped_staging, shared_folder, stage
from tabwright.sizing import sized_shuffles
from tabwright.sources.tables import read_csv, read_parquet, text_schema, write_parquet, write_together


def typed(df: DataFrame, table: CustomerTable = CUSTOMERS) -> DataFrame:
    """Trimmed text, and numbers as doubles."""
    return cast_doubles(trim_strings(df), table.numeric)


def features(df: DataFrame, table: CustomerTable = CUSTOMERS) -> DataFrame:
    """Label, tenure group, service count and average monthly spend."""
    return df.withColumns(
        {
            "label": binary_label(table.target, table.positive),
            "tenure_group": bucket(table.tenure, TENURE_BOUNDS, TENURE_LABELS),
            "service_count": count_matching(table.services, SERVICE_VALUES),
            "avg_monthly_spend": safe_ratio(table.total, table.tenure, table.monthly),
        }
    )


def prepare(
    rows: DataFrame,
    medians: dict[str, float],
    table: CustomerTable = CUSTOMERS,
    blank_as_null: bool = False,
) -> DataFrame:
    """Typed rows to model input: defaults, medians and derived columns."""
    filled = fill_text(rows, table.categorical, MISSING_CATEGORY, blank_as_null)
    return features(apply_medians(filled, medians), table)


def blank_categories(df: DataFrame, table: CustomerTable = CUSTOMERS) -> list[str]:
    """Categorical columns with a cell that holds nothing but blanks."""
    row = df.agg(*[F.count_if(F.trim(c) == "").alias(c) for c in table.categorical]).first()
    return [c for c in table.categorical if row[c]]


def part_counts(train: DataFrame, test: DataFrame) -> DataFrame:
    """part, label, count and percentage of the part."""
    both = train.select("label", F.lit("train").alias("part")).unionAll(test.select("label", F.lit("test").alias("part")))
    counts = both.groupBy("part", "label").agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy("part"))
    return counts.withColumn("percentage", F.col("count") / total * 100)


def run_clean(
    spark: SparkSession,
    raw_path: str | Sequence[str],
    train_path: str,
    test_path: str,
    table: CustomerTable = CUSTOMERS,
    medians_from: str = "train",
    median_error: float = MEDIAN_ERROR,
    train_share: float = TRAIN_SHARE,
    seed: int = SEED,
    blank_as_null: bool = False,
    keep_key: bool = False,
    refuse_blanks: bool = False,
    versioned: bool = False,
) -> DataFrame:
    """Write the train and test tables; returns rows and share per part and class.

    The raw text is read once, under the table's column names, which the header of every
    file must match. ``medians_from="train"`` learns the medians from the training rows
    only; ``"all"`` learns them from every raw row, before deduplication and split. A model
    cannot be trained on blank categories: they are warned of, or refused before anything
    is written, unless ``blank_as_null`` fills them. ``versioned`` writes both tables as one
    new version, so that they change together; ``read_parquet`` finds the last whole one.
    """
    if medians_from not in ("train", "all"):
        raise ValueError("medians_from must be 'train' or 'all'")
    shared_folder(spark)
    paths = [raw_path] if isinstance(raw_path, str) else list(raw_path)
    with sized_shuffles(spark, *paths), scoped_staging(spark):
        schema = text_schema(table.columns) if table.columns else None
        raw = typed(read_csv(spark, paths, schema), table)
        if medians_from == "all":
            raw = stage(raw, "typed")
        part = F.when(in_first_part([table.key], train_share, seed), "train").otherwise("test")
        rows = stage(dedup(raw, [table.key]).withColumn("_part", part), "customers", ("_part",))
        blank = [] if blank_as_null or not table.categorical else blank_categories(rows, table)
        if blank:
            message = f"blank categories in {', '.join(blank)}: training refuses them; blank_as_null fills them"
            if refuse_blanks:
                raise ValueError(message)
            warnings.warn(message, stacklevel=2)
        train = rows.filter("_part = 'train'")
        numeric = list(table.numeric)
        medians = fit_medians(train if medians_from == "train" else raw, numeric, median_error)

        unwanted = [table.target, "_part", *([] if keep_key else [table.key])]
        ready = prepare(rows, medians, table, blank_as_null)
        parts = {name: ready.filter(F.col("_part") == name).drop(*unwanted) for name in ("train", "test")}
        paths = {"train": train_path.rstrip("/"), "test": test_path.rstrip("/")}
        if versioned:
            roots = {path.rpartition("/")[0] for path in paths.values()}
            if len(roots) != 1 or len(set(paths.values())) != 2:
                raise ValueError("versioned tables must be two folders side by side")
            write_together({path.rpartition("/")[2]: parts[name] for name, path in paths.items()}, roots.pop())
        else:
            for name, path in paths.items():
                write_parquet(parts[name], path)
    return part_counts(read_parquet(spark, train_path), read_parquet(spark, test_path))
