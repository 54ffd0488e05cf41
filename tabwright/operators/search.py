"""Seeded random search over model settings, refits, comparison and choice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.fixed import SEED
from tabwright.functions import log_uniform, pick, unit_uniform
from tabwright.operators.encode import RAW_VECTOR, SCALED_VECTOR, build_pipeline, scaler, training_facts
from tabwright.operators.evaluate import METRICS, evaluate_wide, to_long
from tabwright.operators.models import PLACE, fitted, positive_part, predictions, row_place
from tabwright.operators.stats import with_class_weight
from tabwright.scratch import stage

# Models that score one pass over the validation rows together; their trees travel with the task.
MODELS_PER_PASS = 6
WEIGHT = "classWeight"


@dataclass(frozen=True)
class Choice:
    """One of the listed values."""

    values: tuple

    def draw(self, uniform: Column) -> Column:
        return pick(uniform, self.values)


@dataclass(frozen=True)
class LogUniform:
    """A number whose logarithm is uniform between the ends."""

    low: float
    high: float

    def draw(self, uniform: Column) -> Column:
        return log_uniform(uniform, self.low, self.high)


Space = Mapping[str, Choice | LogUniform]

# Search spaces of the two models.
LOGISTIC_SPACE: Space = {
    "maxIter": Choice((50, 100, 150)),
    "regParam": LogUniform(0.0001, 0.1),
    "elasticNetParam": Choice((0.0, 0.25, 0.5, 0.75)),
}
FOREST_SPACE: Space = {
    "numTrees": Choice((50, 100, 150)),
    "maxDepth": Choice((4, 6, 8, 10)),
    "maxBins": Choice((32, 64)),
    "minInstancesPerNode": Choice((1, 2, 4)),
}


def sample_space(ids: DataFrame, space: Space, seed: int = SEED, trial_id: str = "trial_id") -> DataFrame:
    """A setting per row of ``ids``, drawn from the seed, the setting's name and the trial id."""
    draws = {name: domain.draw(unit_uniform(f"{seed}|{name}", trial_id)) for name, domain in space.items()}
    return ids.withColumns(draws)


def draw_trials(spark: SparkSession, n: int, space: Space, seed: int = SEED) -> DataFrame:
    """``n`` numbered trials; the same seed gives the same trials."""
    return sample_space(spark.range(n).withColumnRenamed("id", "trial_id"), space, seed)


def fit_trials(
    estimator: Estimator, train: DataFrame, settings: Sequence[Mapping[str, object]], parallelism: int = 2,
    pieces: int | None = None,
) -> list:
    """One model per setting, fitted on one laid-out copy of the rows."""
    return fitted(estimator, train, train.count(), settings, parallelism, pieces)


def _score_with(models: Mapping[int, object], rows: DataFrame, label: str) -> DataFrame:
    """Trial id, score, prediction and label for every row and model, from one pass over ``rows``."""
    scored = rows
    for i, model in models.items():
        model = model.copy()
        model.setRawPredictionCol(f"_raw_{i}").setPredictionCol(f"_prediction_{i}").setProbabilityCol("")
        scored = model.transform(scored)
    outcomes = F.array(
        *[
            F.struct(
                F.lit(i).cast("long").alias("trial_id"),
                positive_part(f"_raw_{i}").alias("score"),
                F.col(f"_prediction_{i}").alias("prediction"),
            )
            for i in models
        ]
    )
    return scored.select(label, F.inline(outcomes))


def run_trials(
    estimator: Estimator,
    trials: DataFrame,
    space: Space,
    train: DataFrame,
    validation: DataFrame,
    label: str = "label",
    parallelism: int = 2,
    models_per_pass: int = MODELS_PER_PASS,
    pieces: int | None = None,
) -> DataFrame:
    """The trials with the six validation metrics of each.

    ``train`` and ``validation`` hold assembled vectors: no setting changes a feature
    stage, so these are fitted once, outside. Validation rows are scored by several
    models per pass, and all trials are evaluated together.
    """
    rows = trials.orderBy("trial_id").collect()
    models = fit_trials(estimator, train, [{name: r[name] for name in space} for r in rows], parallelism, pieces)
    numbered = {r["trial_id"]: m for r, m in zip(rows, models)}
    ids = list(numbered)
    metrics = None
    for start in range(0, len(ids), models_per_pass):
        part = {i: numbered[i] for i in ids[start : start + models_per_pass]}
        wide = evaluate_wide(_score_with(part, validation, label), by=["trial_id"], label=label)
        metrics = wide if metrics is None else metrics.unionByName(wide)
    drawn = trials.sparkSession.createDataFrame(rows, trials.schema)
    return stage(drawn.join(metrics, "trial_id").select(*trials.columns, *METRICS), "trials")


def best_trial(trials: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The trial with the largest metric; the lowest id wins a tie."""
    return trials.orderBy(F.desc(metric), "trial_id").limit(1)


def featurize(
    model: PipelineModel, df: DataFrame, label: str = "label", weight: str | None = None
) -> DataFrame:
    """Only the vectors, the label and the weight: what fitting and validating read.

    Rows to fit on (with a weight) keep their place in the layout.
    """
    out = model.transform(df)
    vectors = [v for v in (RAW_VECTOR, SCALED_VECTOR) if v in out.columns]
    return out.select(*vectors, label, *([weight, PLACE] if weight else []))


@dataclass(frozen=True)
class TrainingSet:
    """Checked and weighted training rows, and the fitted stages up to the unscaled vector."""

    rows: int
    weighted: DataFrame
    stages: PipelineModel
    label: str

    def vectors(self, scaled: bool) -> tuple[list, DataFrame]:
        """The fitted stages that make the vector, and the rows to fit a model on."""
        made = self.stages.transform(self.weighted)
        if not scaled:
            return list(self.stages.stages), made.select(RAW_VECTOR, self.label, WEIGHT, PLACE)
        fitted = scaler().fit(made)
        return [*self.stages.stages, fitted], fitted.transform(made).select(SCALED_VECTOR, self.label, WEIGHT, PLACE)


def training_set(
    train: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str = "label",
    max_categories: int | None = None,
) -> TrainingSet:
    """One pass for the checks and class weights, one fit of the stages; for any number of models.

    Rows take their place from all columns of ``train``: keep its key to spread equal rows.
    """
    rows, weights = training_facts(train, categorical, numeric, label, max_categories)
    weighted = with_class_weight(train, weights, label, WEIGHT)
    weighted = weighted.withColumn(PLACE, row_place(*sorted(train.columns)))
    return TrainingSet(rows, weighted, build_pipeline(categorical, numeric, scale=False).fit(weighted), label)


def fit_model(estimator: Estimator, training: TrainingSet, scale: bool, pieces: int | None = None) -> PipelineModel:
    """All stages and the model, fitted on rows laid out by their content."""
    stages, vectors = training.vectors(scale)
    return PipelineModel([*stages, *fitted(estimator, vectors, training.rows, pieces=pieces)])


def refit(
    estimator: Estimator,
    training: TrainingSet,
    test: DataFrame,
    scale: bool = True,
    pieces: int | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Fit a model on all training rows, weighted by their own classes; test metrics."""
    model = fit_model(estimator, training, scale, pieces)
    label = training.label
    return model, stage(evaluate_wide(predictions(model, test, label), label=label), "metrics", keep=True)


def compare_models(metrics: DataFrame, models: Sequence[str], places: int = 4) -> DataFrame:
    """One row per metric and one column per model, from rows of (model, metric, value)."""
    pivoted = metrics.groupBy("metric").pivot("model", list(models)).agg(F.first("value"))
    return pivoted.select("metric", *[F.round(m, places).alias(m) for m in models])


def best_model(metrics: DataFrame, models: Sequence[str], metric: str = "roc_auc") -> DataFrame:
    """The model with the largest metric; the one listed first wins a tie."""
    rank = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    return (
        metrics.filter((F.col("metric") == metric) & F.col("model").isin(list(models)))
        .orderBy(F.desc("value"), rank)
        .limit(1)
        .select("model", "metric", "value")
    )


def selection_record(metrics: DataFrame, models: Sequence[str], metric: str = "roc_auc") -> DataFrame:
    """Run-log entries of the choice: the winner as a tag, the deciding metric, its six metrics."""
    winner = best_model(metrics, models, metric).select(F.col("model").alias("winner"))
    own = metrics.join(winner, metrics["model"] == winner["winner"], "left_semi")
    values = own.select(
        F.lit("metric").alias("kind"),
        F.concat(F.lit("best_model_"), F.col("metric")).alias("key"),
        F.lit(None).cast("string").alias("value_str"),
        F.col("value").alias("value_dbl"),
    )
    choice = winner.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("tag").alias("kind"),
                    F.lit("best_model").alias("key"),
                    F.col("winner").alias("value_str"),
                    F.lit(None).cast("double").alias("value_dbl"),
                ),
                F.struct(
                    F.lit("param").alias("kind"),
                    F.lit("selection_metric").alias("key"),
                    F.lit(metric).alias("value_str"),
                    F.lit(None).cast("double").alias("value_dbl"),
                ),
            )
        )
    )
    return choice.unionByName(values)


def model_metrics(wide_by_model: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of (model, metric, value) from one wide metrics row per model."""
    parts = [to_long(wide.withColumn("model", F.lit(name)), ["model"]) for name, wide in wide_by_model.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
