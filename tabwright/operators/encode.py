"""Feature stages, and the checks a training table must pass before they are fitted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.ranges import numbered
from tabwright.operators.stats import weights_from_counts
from tabwright.scratch import stage

RAW_VECTOR = "unscaled_features"
SCALED_VECTOR = "features"
# Categories of a column that the driver may list; more stay a distributed table.
DRIVER_CATEGORIES = 100_000


def feature_stages(categorical: Sequence[str], numeric: Sequence[str], scale: bool = True) -> list:
    """Index, one-hot, assemble and, when asked, scale to unit deviation without centring.

    Categories rank by frequency, then alphabetically. Unseen and null categories take
    an extra last index, which the one-hot step drops: they become the zero vector.
    """
    stages: list = []
    inputs = list(numeric)
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        encoded = [f"{c}_encoded" for c in categorical]
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
        ]
        inputs += encoded
    stages.append(VectorAssembler(inputCols=inputs, outputCol=RAW_VECTOR, handleInvalid="keep"))
    if scale:
        stages.append(scaler())
    return stages


def category_table(df: DataFrame, column: str) -> DataFrame:
    """category, rows and index (from 0) of every category of a column, staged.

    Frequent ones come first, ties in the order of code points, as the indexer stage has it.
    Nulls are no category. Nothing is gathered: categories are dealt by range.
    """
    category = F.col(column).cast("string").alias("category")
    counts = df.select(category).filter("category is not null").groupBy("category").agg(F.count("*").alias("rows"))
    order = [F.desc("rows"), "category"]
    return stage(numbered(stage(counts, "categories"), order, "index"), "categories")


def index_categories(
    df: DataFrame, columns: Sequence[str], on_driver: int = DRIVER_CATEGORIES, suffix: str = "_index"
) -> DataFrame:
    """``df`` with the index of each column's category; null takes the index after the last.

    A column's categories are counted: up to ``on_driver`` they become a list in the indexer
    stage, beyond it they stay a table that the rows are joined to. Both give the same
    indices.
    """
    for c in columns:
        table = category_table(df, c)
        size = table.count()
        if size <= on_driver:
            labels = [r["category"] for r in table.orderBy("index").collect()]
            model = StringIndexerModel.from_labels(labels, c, f"{c}{suffix}", "keep")
            df = model.transform(df)
        else:
            found = table.select(F.col("category").alias("_category"), F.col("index").cast("double").alias("_found"))
            joined = df.join(found, F.col(c).cast("string") == F.col("_category"), "left")
            index = F.coalesce("_found", F.lit(float(size)))
            df = joined.withColumn(f"{c}{suffix}", index).drop("_category", "_found")
    return df


def scaler() -> StandardScaler:
    return StandardScaler(inputCol=RAW_VECTOR, outputCol=SCALED_VECTOR, withMean=False, withStd=True)


def build_pipeline(
    categorical: Sequence[str], numeric: Sequence[str], estimator: Estimator | None = None, scale: bool = True
) -> Pipeline:
    """The feature stages, with ``estimator`` as the last stage when given."""
    last = [] if estimator is None else [estimator]
    return Pipeline(stages=[*feature_stages(categorical, numeric, scale), *last])


def training_weights(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str = "label", **options
) -> dict[float, float]:
    """The class weights of a training table that passes the checks of ``training_facts``."""
    return training_facts(df, categorical, numeric, label, **options)[1]


def training_facts(
    df: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str = "label",
    max_categories: int | None = None,
) -> tuple[int, dict[float, float]]:
    """Rows and class weights of a training table, checked in the same pass.

    Refuses a missing class, a label other than 0 and 1, missing numbers (the models
    cannot take them) and blank categories (a vector slot needs a name). The categories
    of a column become a list on the driver and slots of a vector; ``max_categories``, when
    given, refuses columns with more, counted exactly.
    """
    aggregates = [
        F.count("*").alias("rows"),
        F.count_if(F.col(label) == 0.0).alias("negative"),
        F.count_if(F.col(label) == 1.0).alias("positive"),
    ]
    for c in numeric:
        value = F.col(c).cast("double")
        aggregates.append(F.count_if(value.isNull() | F.isnan(value)).alias(f"missing:{c}"))
    for c in categorical:
        aggregates.append(F.count_if(F.col(c) == "").alias(f"blank:{c}"))
        if max_categories is not None:
            aggregates.append(F.count_distinct(c).alias(f"categories:{c}"))
    row = df.agg(*aggregates).first()

    missing = [c for c in numeric if row[f"missing:{c}"]]
    if missing:
        raise ValueError(f"missing numbers in {', '.join(missing)}: fill them before training")
    blank = [c for c in categorical if row[f"blank:{c}"]]
    if blank:
        raise ValueError(f"blank categories in {', '.join(blank)}: fill them before training")
    if max_categories is not None:
        crowded = [c for c in categorical if row[f"categories:{c}"] > max_categories]
        if crowded:
            raise ValueError(f"more than {max_categories} categories in {', '.join(crowded)}")
    return row["rows"], weights_from_counts(row["rows"], row["negative"], row["positive"])
