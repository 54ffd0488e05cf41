"""The six metrics of scored line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import CANDIDATES_SQL, candidates, metrics_ctes, one_candidate, query
from tabwright.operators.evaluate import all_metrics, class_metrics, evaluate, score_table
from tabwright.scratch import stage


def _single(name: str, candidate: int) -> str:
    return (
        f"with {metrics_ctes(one_candidate(candidate))} "
        f"select metric, round(value, 6) as value from metric_rows where metric = '{name}'"
    )


def _one_metric(spark, sf_dir, name, candidate, metrics):
    scored = candidates(spark, sf_dir, candidate)
    wide = metrics(stage(score_table(scored, ["trial_id"]), "scores"), ["trial_id"])
    return wide.select(F.lit(name).alias("metric"), F.round(name, 6).alias("value"))


@query("metric_roc_auc", _single("roc_auc", 0))
def metric_roc_auc(spark, sf_dir):
    return _one_metric(spark, sf_dir, "roc_auc", 0, all_metrics)


@query("metric_pr_auc", _single("pr_auc", 0))
def metric_pr_auc(spark, sf_dir):
    return _one_metric(spark, sf_dir, "pr_auc", 0, all_metrics)


@query("metric_roc_auc_fine", _single("roc_auc", 1))
def metric_roc_auc_fine(spark, sf_dir):
    """Nearly every row has a score of its own, so the score ranges carry the load."""
    return _one_metric(spark, sf_dir, "roc_auc", 1, all_metrics)


@query("metric_pr_auc_fine", _single("pr_auc", 1))
def metric_pr_auc_fine(spark, sf_dir):
    return _one_metric(spark, sf_dir, "pr_auc", 1, all_metrics)


@query("metric_accuracy", _single("accuracy", 0))
def metric_accuracy(spark, sf_dir):
    return _one_metric(spark, sf_dir, "accuracy", 0, class_metrics)


@query("metric_f1", _single("f1", 0))
def metric_f1(spark, sf_dir):
    return _one_metric(spark, sf_dir, "f1", 0, class_metrics)


@query("metric_precision", _single("precision", 0))
def metric_precision(spark, sf_dir):
    return _one_metric(spark, sf_dir, "precision", 0, class_metrics)


@query("metric_recall", _single("recall", 0))
def metric_recall(spark, sf_dir):
    return _one_metric(spark, sf_dir, "recall", 0, class_metrics)


@query(
    "evaluate",
    f"with {metrics_ctes(one_candidate(1))} select metric, round(value, 6) as value from metric_rows",
)
def evaluate_one(spark, sf_dir):
    return evaluate(candidates(spark, sf_dir, 1).drop("trial_id")).withColumn("value", F.round("value", 6))


@query(
    "evaluate_many",
    f"with {metrics_ctes(CANDIDATES_SQL)} select trial_id, metric, round(value, 6) as value from metric_rows",
)
def evaluate_many(spark, sf_dir):
    """Several models over the same rows, evaluated together."""
    return evaluate(candidates(spark, sf_dir), ["trial_id"]).withColumn("value", F.round("value", 6))


NULL_MODEL_SQL = f"select coalesce(nullif(trial_id, 1), -1) as trial_id, score, prediction, label from ({CANDIDATES_SQL})"


@query(
    "evaluate_null_models",
    f"""with {metrics_ctes(NULL_MODEL_SQL)} select coalesce(nullif(trial_id, -1)::varchar, 'none') as model, metric,
    round(value, 6) as value from metric_rows""",
)
def evaluate_null_models(spark, sf_dir):
    """One of the models has no id, and enough distinct scores for several ranges."""
    scored = candidates(spark, sf_dir).withColumn("trial_id", F.nullif("trial_id", F.lit(1).cast("long")))
    model = F.coalesce(F.col("trial_id").cast("string"), F.lit("none")).alias("model")
    return evaluate(scored, ["trial_id"]).select(model, "metric", F.round("value", 6).alias("value"))
