"""Search settings of both models, refit the best ones, choose a winner, log everything."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwright.fixed import (
    CUSTOMERS,
    FINAL_RUN,
    FINAL_TYPE,
    MODELS,
    SEARCH_RUN,
    SEARCH_TYPE,
    SEED,
    SELECTION_RUN,
    TRAIN_SHARE,
    TRIALS,
    CustomerTable,
)
from tabwright.operators.encode import build_pipeline, training_weights
from tabwright.operators.evaluate import METRICS, metric_values
from tabwright.operators.models import PLACE, forest, logistic, row_place
from tabwright.operators.search import (
    FOREST_SPACE,
    LOGISTIC_SPACE,
    best_trial,
    draw_trials,
    featurize,
    model_metrics,
    refit,
    run_trials,
    selection_record,
    training_set,
)
from tabwright.operators.split import VALIDATION_SALT, hash_split
from tabwright.operators.stats import with_class_weight
from tabwright.scratch import scoped_staging, shared_folder, stage
from tabwright.sizing import sized_shuffles
from tabwright.sources.models import save_model
from tabwright.sources.runlog import log_run
from tabwright.sources.tables import read_parquet, write_csv

EXPERIMENT = "Customer outcome search"
SPACES = {"LogisticRegression": LOGISTIC_SPACE, "RandomForest": FOREST_SPACE}
ESTIMATORS = {"LogisticRegression": logistic, "RandomForest": forest}


def tuning_tables(
    train: DataFrame, table: CustomerTable = CUSTOMERS, max_categories: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Assembled tuning and validation rows, staged for the many fits that read them.

    Training rows carry no key any more unless it was kept; without it a row's own
    content decides its part, so that equal rows never fall on both sides.
    """
    keys = [table.key] if table.key in train.columns else sorted(train.columns)
    tuning, validation = hash_split(train, keys, TRAIN_SHARE, VALIDATION_SALT)
    weights = training_weights(tuning, table.model_categorical, table.model_numeric, max_categories=max_categories)
    weighted = with_class_weight(tuning, weights).withColumn(PLACE, row_place(*sorted(tuning.columns)))
    stages = build_pipeline(table.model_categorical, table.model_numeric).fit(weighted)
    return (
        stage(featurize(stages, weighted, weight="classWeight"), "tuning"),
        stage(featurize(stages, validation), "validation"),
    )


def run_tune(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    output_path: str,
    table: CustomerTable = CUSTOMERS,
    experiment: str = EXPERIMENT,
    trials: int = TRIALS,
    seed: int = SEED,
    parallelism: int = 2,
    max_categories: int | None = None,
    fit_pieces: int | None = None,
) -> DataFrame:
    """Rows of (model, metric, value) of the two refitted models on the test table.

    Trials go to ``output_path/trials`` as CSV, models to ``output_path/models``, and
    the search, the final models and the choice to the run log in ``output_path/runs``.
    """
    shared_folder(spark)
    with sized_shuffles(spark, train_path, test_path), scoped_staging(spark):
        return _run_tune(
            spark, train_path, test_path, output_path, table, experiment, trials, seed, parallelism, max_categories,
            fit_pieces,
        )


def _run_tune(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    output_path: str,
    table: CustomerTable,
    experiment: str,
    trials: int,
    seed: int,
    parallelism: int,
    max_categories: int | None,
    fit_pieces: int | None,
) -> DataFrame:
    log_path = f"{output_path}/runs"
    train, test = (read_parquet(spark, p) for p in (train_path, test_path))
    tuning, validation = tuning_tables(train, table, max_categories)

    settings = {}
    for name in MODELS:
        space = SPACES[name]
        drawn = draw_trials(spark, trials, space, seed)
        tried = run_trials(
            ESTIMATORS[name](), drawn, space, tuning, validation, parallelism=parallelism, pieces=fit_pieces
        )
        trials_path = f"{output_path}/trials/{name}"
        write_csv(tried, trials_path, single_file=True)
        best = best_trial(tried).first()
        settings[name] = {parameter: best[parameter] for parameter in space}
        log_run(
            spark,
            log_path,
            experiment,
            SEARCH_RUN.format(name),
            tags={"model_type": name, "run_type": SEARCH_TYPE},
            params={**{f"best_{p}": v for p, v in settings[name].items()}, "num_tuning_trials": trials},
            metrics={f"best_validation_{m}": best[m] for m in METRICS},
            artifacts={"trials": trials_path},
        )

    results = {}
    training = training_set(train, table.model_categorical, table.model_numeric, max_categories=max_categories)
    for name in MODELS:
        scale = name == "LogisticRegression"
        model, metrics = refit(ESTIMATORS[name](**settings[name]), training, test, scale, fit_pieces)
        results[name] = metrics
        log_run(
            spark,
            log_path,
            experiment,
            FINAL_RUN.format(name),
            tags={"model_type": name, "run_type": FINAL_TYPE},
            params={**settings[name], "training_data": train_path, "test_data": test_path},
            metrics={f"test_{m}": v for m, v in metric_values(metrics).items()},
            artifacts={"model": save_model(model, f"{output_path}/models/{name}")},
        )

    compared = model_metrics(results)
    record = {(r["kind"], r["key"]): r for r in selection_record(compared, MODELS).collect()}
    log_run(
        spark,
        log_path,
        experiment,
        SELECTION_RUN,
        tags={k: r["value_str"] for (kind, k), r in record.items() if kind == "tag"},
        params={k: r["value_str"] for (kind, k), r in record.items() if kind == "param"},
        metrics={k: r["value_dbl"] for (kind, k), r in record.items() if kind == "metric"},
    )
    return compared
