"""Fit, evaluate, store and log the two default models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwright.fixed import ARTIFACTS, CUSTOMERS, FOREST_SETTINGS, LOGISTIC_SETTINGS, MODELS, CustomerTable
from tabwright.operators.evaluate import metric_values
from tabwright.operators.models import forest, logistic
from tabwright.operators.search import model_metrics, refit, training_set
from tabwright.scratch import scoped_staging, shared_folder
from tabwright.sizing import sized_shuffles
from tabwright.sources.models import save_model
from tabwright.sources.runlog import log_run
from tabwright.sources.tables import read_parquet

EXPERIMENT = "Customer outcome"


def run_train(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    output_path: str,
    table: CustomerTable = CUSTOMERS,
    experiment: str = EXPERIMENT,
    logistic_settings: dict | None = None,
    forest_settings: dict | None = None,
    max_categories: int | None = None,
    fit_pieces: int | None = None,
) -> DataFrame:
    """Rows of (model, metric, value) on the test table.

    Checks, class weights and feature stages are shared by both models. Models go to ``output_path/models``, the run log to ``output_path/runs``.
    """
    columns = [*table.model_categorical, *table.model_numeric, "label"]
    shared_folder(spark)
    train, test = (read_parquet(spark, p) for p in (train_path, test_path))
    train = train.select(*[c for c in train.columns if c in {table.key, *columns}])
    settings = {
        "LogisticRegression": {**LOGISTIC_SETTINGS, **(logistic_settings or {})},
        "RandomForest": {**FOREST_SETTINGS, **(forest_settings or {})},
    }
    estimators = {
        "LogisticRegression": logistic(**settings["LogisticRegression"]),
        "RandomForest": forest(**settings["RandomForest"]),
    }
    results = {}
    with sized_shuffles(spark, train_path, test_path), scoped_staging(spark):
        training = training_set(train, table.model_categorical, table.model_numeric, max_categories=max_categories)
        for name, estimator in estimators.items():
            model, metrics = refit(estimator, training, test, name == "LogisticRegression", fit_pieces)
            stored = save_model(model, f"{output_path}/models/{ARTIFACTS[name]}")
            log_run(
                spark,
                f"{output_path}/runs",
                experiment,
                name,
                params={"model": name, **settings[name]},
                metrics=metric_values(metrics),
                artifacts={ARTIFACTS[name]: stored},
            )
            results[name] = metrics
    return model_metrics(results)
