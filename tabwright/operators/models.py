"""The two weighted classifiers, and scoring with a fitted one."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.fixed import FOREST_SETTINGS, LOGISTIC_SETTINGS, SEED
from tabwright.operators.encode import RAW_VECTOR, SCALED_VECTOR
from tabwright.operators.folds import can_fold, fit_cells, fold
from tabwright.scratch import persisted, stage

# Rows of one piece of a training table, and the fewest pieces.
ROWS_PER_PIECE = 1_000_000
LEAST_PIECES = 8
PLACE = "_place"
GROUP_WEIGHT = "_weight"
# Groups of equal rows that one piece holds: a pass over them is shorter than dealing them out.
SMALL_GROUPS = 20_000
# Rows from which the jobs of one fit fill the executors, and fits no longer overlap.
ROWS_PER_FIT = 4_000_000
# Rows from which a forest is fitted on folded rows, and how many rows a fold must hold on average:
# trees on folded rows are fitted one by one, each at several times the cost of a row.
FOLDED_FROM = 4_000_000
ROWS_PER_FOLD = 8


def logistic(label: str = "label", weight: str | None = "classWeight", **settings) -> LogisticRegression:
    """Weighted logistic regression on the scaled vector."""
    model = LogisticRegression(featuresCol=SCALED_VECTOR, labelCol=label, **{**LOGISTIC_SETTINGS, **settings})
    return model.setWeightCol(weight) if weight else model


def forest(label: str = "label", weight: str | None = "classWeight", **settings) -> RandomForestClassifier:
    """Weighted random forest on the unscaled vector.

    Each row's place in the trees is cached from level to level instead of being found
    again from the root, and checkpointed at the interval.
    """
    defaults = {**FOREST_SETTINGS, "seed": SEED, "cacheNodeIds": True, "checkpointInterval": 10}
    model = RandomForestClassifier(featuresCol=RAW_VECTOR, labelCol=label, **{**defaults, **settings})
    return model.setWeightCol(weight) if weight else model


def row_place(*columns: str) -> Column:
    """A number from the row's content, to lay rows out by."""
    return F.xxhash64(*columns)


def fit_layout(df: DataFrame, rows: int, place: str = PLACE, pieces: int | None = None) -> DataFrame:
    """Training rows in pieces and in an order that depend on the rows alone.

    A fit adds numbers up piece by piece, and a forest draws its samples per piece, so the
    same rows give the same model only in the same layout, whatever the number of cores.
    Rows are dealt by their content into one piece per ``ROWS_PER_PIECE``, ``LEAST_PIECES``
    at least, unless ``pieces`` says how many.
    """
    pieces = pieces or max(LEAST_PIECES, -(-rows // ROWS_PER_PIECE))
    return df.repartition(pieces, place).sortWithinPartitions(place)


def _folded(df: DataFrame, estimator: LogisticRegression) -> tuple[DataFrame, int, float]:
    """Groups of rows equal in vector, label and weight, their number, and what folding does to variances.

    A group's weight is that of all its rows, so every sum that the fit takes is the same.
    Only the unbiased variance also reads the squares of the weights; folding multiplies
    that of every feature by the same number.
    """
    alike = [estimator.getFeaturesCol(), estimator.getLabelCol()]
    if estimator.isDefined(estimator.weightCol):
        weight, alike = F.col(estimator.getWeightCol()), [*alike, estimator.getWeightCol()]
    else:
        weight = F.lit(1.0)
    counted = df.groupBy(*alike).agg(F.count("*").alias("_rows"))
    total = (weight * F.col("_rows")).alias(GROUP_WEIGHT)
    groups = stage(counted.select("*", total, row_place(*alike).alias(PLACE)), "groups")
    sums = groups.agg(
        F.count("*").alias("groups"),
        F.sum(GROUP_WEIGHT).alias("total"),
        F.sum(F.col(GROUP_WEIGHT) * weight).alias("squares"),
        F.sum(F.col(GROUP_WEIGHT) * F.col(GROUP_WEIGHT)).alias("folded"),
    ).first()
    if not sums["total"]:
        return groups, sums["groups"], 1.0
    whole, folded = (sums["total"] - sums[c] / sums["total"] for c in ("squares", "folded"))
    # Rounded, because sums differ in the last digits from run to run.
    return groups, sums["groups"], round(whole / folded, 12) if whole > 0 and folded > 0 else 1.0


def _same_penalty(estimator: LogisticRegression, setting: Mapping[str, object], variances: float) -> dict[str, object]:
    """``setting`` with the penalties that mean on folded rows what it means on all rows.

    Coefficients are penalised on the scale of their feature's deviation, which folding changes.
    """
    regular, mixed = (
        setting.get(name, estimator.getOrDefault(name)) for name in ("regParam", "elasticNetParam")
    )
    if not estimator.getStandardization() or not regular or variances == 1.0:
        return dict(setting)
    lasso, ridge = regular * mixed / math.sqrt(variances), regular * (1.0 - mixed) / variances
    return {**setting, "regParam": lasso + ridge, "elasticNetParam": lasso / (lasso + ridge)}


def _fit_each(
    estimator: Estimator, rows: DataFrame, settings: Sequence[Mapping[str, object]], parallelism: int
) -> list[Model]:
    """One model per setting; fits overlap so that short jobs do not leave executors idle."""
    maps = [{estimator.getParam(name): value for name, value in s.items()} for s in settings]
    fits = estimator.fitMultiple(rows, maps)
    with ThreadPool(min(parallelism, len(maps))) as pool:
        models = dict(pool.imap_unordered(lambda _: next(fits), range(len(maps))))
    return [models[i] for i in range(len(maps))]


def fitted(
    estimator: Estimator,
    df: DataFrame,
    rows: int,
    settings: Sequence[Mapping[str, object]] = ({},),
    parallelism: int = 1,
    pieces: int | None = None,
) -> list[Model]:
    """One model per setting, fitted on the laid-out rows.

    A regression passes over its rows a hundred times: rows equal in vector, label and
    weight are first folded into one of their total weight, which leaves the optimum as it
    is. A large forest folds rows that its bins cannot tell apart, where few enough are left;
    every tree draws from all rows still. Otherwise a forest reads all rows at every level.
    """
    if isinstance(estimator, LogisticRegression):
        groups, n, variances = _folded(df, estimator)
        layout = fit_layout(groups, n, pieces=pieces or (1 if n <= SMALL_GROUPS else None))
        folded = estimator.copy().setWeightCol(GROUP_WEIGHT)
        again = [_same_penalty(estimator, s, variances) for s in settings]
        with persisted(layout, level=StorageLevel.DISK_ONLY) as (held,):
            models = _fit_each(folded, held, again, parallelism)
        # The models tell the settings that were asked for.
        for model, setting in zip(models, settings):
            for name in ("regParam", "elasticNetParam"):
                model.set(model.getParam(name), setting.get(name, estimator.getOrDefault(name)))
            if estimator.isDefined(estimator.weightCol):
                model.set(model.weightCol, estimator.getWeightCol())
            else:
                model.clear(model.weightCol)
        return models

    if isinstance(estimator, RandomForestClassifier) and len(settings) == 1 and rows > FOLDED_FROM:
        chosen = estimator.copy({estimator.getParam(name): value for name, value in settings[0].items()})
        folded = fold(df, chosen, PLACE) if can_fold(chosen) else None
        if folded is not None and (n := folded[0].count()) <= rows // ROWS_PER_FOLD:
            return [fit_cells(chosen, fit_layout(folded[0], n, pieces=pieces), *folded[1:])]

    layout = fit_layout(df, rows, pieces=pieces)
    if rows > ROWS_PER_FIT:
        # Each fit holds rows of its own in memory.
        parallelism = 1
    if len(settings) == 1:
        return _fit_each(estimator, layout, settings, 1)
    # Made once and read a few times by each fit; the memory is for the fits.
    with persisted(layout, level=StorageLevel.DISK_ONLY) as (held,):
        return _fit_each(estimator, held, settings, parallelism)


def positive_part(vector: str) -> Column:
    """The entry of the positive class in a two-class vector column."""
    return vector_to_array(vector)[1]


def score(model: Model, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Batch scoring: the kept columns, the positive probability and the predicted class."""
    return model.transform(df).select(
        *keep, positive_part("probability").alias("probability"), "prediction"
    )


def predictions(model: Model, df: DataFrame, label: str = "label") -> DataFrame:
    """Label, raw score and predicted class: all that evaluation reads."""
    return model.transform(df).select(
        label, positive_part("rawPrediction").alias("score"), "prediction"
    )
