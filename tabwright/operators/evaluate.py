"""The six metrics of a binary classifier from one pass over its predictions.

Predictions are first counted per score. Everything else reads that table: the four
outcome counts add up to the confusion matrix, and the cumulative counts in descending
score order give the two areas, exactly and without binning scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.ranges import RANGE, RANGE_ROWS, in_ranges
from tabwright.scratch import stage

# Order of the metrics in result tables.
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
OUTCOMES = ["tp", "fn", "fp", "tn"]


def score_table(
    df: DataFrame,
    by: Sequence[str] = (),
    score: str = "score",
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Outcome counts per model (``by``) and score; counted map-side before the shuffle.

    A missing score is refused: no place in the order is right for it. Null model ids are a
    model of their own.
    """
    actual, predicted = F.col(label), F.col(prediction)
    ranked = F.coalesce(F.col(score).cast("double"), F.raise_error(F.lit("scores must not be null")).cast("double"))
    known = F.when(actual.isin(0.0, 1.0) & predicted.isin(0.0, 1.0), True)
    checked = F.coalesce(known, F.raise_error(F.lit("labels and predictions must be 0.0 or 1.0")).cast("boolean"))
    return df.groupBy(*by, ranked.alias("score")).agg(
        F.count_if(checked & (actual == 1.0) & (predicted == 1.0)).alias("tp"),
        F.count_if((actual == 1.0) & (predicted == 0.0)).alias("fn"),
        F.count_if((actual == 0.0) & (predicted == 1.0)).alias("fp"),
        F.count_if((actual == 0.0) & (predicted == 0.0)).alias("tn"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _rates() -> list[Column]:
    """Accuracy, and precision, recall and F1 of both classes weighted by class size."""
    tp, fn, fp, tn = (F.col(c) for c in OUTCOMES)
    positives, negatives = tp + fn, tn + fp
    rows = positives + negatives

    def weighted(of_positive: Column, of_negative: Column) -> Column:
        return (positives * of_positive + negatives * of_negative) / rows

    return [
        ((tp + tn) / rows).alias("accuracy"),
        weighted(_share(tp, tp + fp), _share(tn, tn + fn)).alias("precision"),
        weighted(_share(tp, positives), _share(tn, negatives)).alias("recall"),
        weighted(_share(2 * tp, 2 * tp + fp + fn), _share(2 * tn, 2 * tn + fp + fn)).alias("f1"),
    ]


def class_metrics(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The four metrics of predicted classes, per model."""
    return table.groupBy(*by).agg(*[F.sum(c).alias(c) for c in OUTCOMES]).select(*by, *_rates())


def _curve(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cumulative outcomes at each score, all scores of a model in one task."""
    model = Window.partitionBy(*by)
    so_far = model.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table.select(
        "*",
        F.sum("pos").over(so_far).alias("hits"),
        F.sum("neg").over(so_far).alias("misses"),
        F.sum("pos").over(model).alias("all_pos"),
        F.sum("neg").over(model).alias("all_neg"),
    )


def _ranged_curve(table: DataFrame, by: Sequence[str], ranges: int) -> DataFrame:
    """The same, one score range per task.

    Spark deals the rows by model and score: a large model gets many ranges, small ones
    share one. The totals of the ranges, a row each per model, are accumulated first; each
    range then starts from what the higher scores hold. Null model ids meet their own totals.
    """
    ranged = in_ranges(table, [*by, F.desc("score")], ranges)
    # As fields of a struct, null ids equal one another, and one shuffle serves all that follows.
    keys = ["_model", RANGE] if by else [RANGE]
    ranged = ranged.withColumn("_model", F.struct(*by)) if by else ranged
    totals = ranged.groupBy(*keys).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    every = Window.partitionBy(*keys[:-1])
    higher = every.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys,
        F.coalesce(F.sum("pos").over(higher), F.lit(0)).alias("start_hits"),
        F.coalesce(F.sum("neg").over(higher), F.lit(0)).alias("start_misses"),
        F.sum("pos").over(every).alias("all_pos"),
        F.sum("neg").over(every).alias("all_neg"),
    )
    so_far = (
        Window.partitionBy(*keys).orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return ranged.join(starts, keys).select(
        *table.columns,
        (F.col("start_hits") + F.sum("pos").over(so_far)).alias("hits"),
        (F.col("start_misses") + F.sum("neg").over(so_far)).alias("misses"),
        "all_pos",
        "all_neg",
    )


def all_metrics(table: DataFrame, by: Sequence[str] = (), range_rows: int = RANGE_ROWS) -> DataFrame:
    """The six metrics per model from its score table; scores are not binned."""
    counted = table.withColumns({"pos": F.col("tp") + F.col("fn"), "neg": F.col("fp") + F.col("tn")})
    ranges = -(-table.count() // range_rows)
    curve = _ranged_curve(counted, by, ranges) if ranges > 1 else _curve(counted, by)
    pos, neg, hits, misses = (F.col(c) for c in ("pos", "neg", "hits", "misses"))
    precision = hits / (hits + misses)
    before = (hits - pos) + (misses - neg)
    precision_before = F.when(before > 0, (hits - pos) / before).otherwise(precision)
    sums = curve.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in OUTCOMES],
        F.sum(pos.cast("double") * (F.col("all_neg") - misses + neg / 2)).alias("won"),
        F.sum(pos * (precision + precision_before) / 2).alias("precision_sum"),
    )
    positives, negatives = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    return sums.select(
        *by,
        *_rates(),
        F.when(positives == 0, 0.0)
        .when(negatives == 0, 1.0)
        .otherwise(F.col("won") / positives / negatives)
        .alias("roc_auc"),
        _share(F.col("precision_sum"), positives).alias("pr_auc"),
    )


def evaluate_wide(
    df: DataFrame,
    by: Sequence[str] = (),
    score: str = "score",
    label: str = "label",
    prediction: str = "prediction",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row of six metrics per model; one row in all without ``by``.

    The score table is staged because several jobs read it, while the predictions,
    which may be dear to compute, are read once.
    """
    return all_metrics(stage(score_table(df, by, score, label, prediction), "scores"), by, range_rows)


def to_long(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metric rows instead of metric columns."""
    return wide.unpivot(list(by), METRICS, "metric", "value")


def evaluate(df: DataFrame, by: Sequence[str] = (), **columns) -> DataFrame:
    """The six metrics as rows: ``by`` columns, metric, value."""
    return to_long(evaluate_wide(df, by, **columns), by)


def metric_values(wide: DataFrame) -> dict[str, float]:
    """The six numbers of a single model."""
    row = wide.first()
    if row is None or row["accuracy"] is None:
        raise ValueError("no predictions to evaluate")
    return {m: float(row[m]) for m in METRICS}
