"""Rows folded by the buckets that a forest can tell apart, and forests fitted on such folds."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.scratch import persisted, scratch_path, stage

# Edges per bin that are counted to place a slot's cuts, and rows that propose them.
EDGES_PER_BIN = 32
PROPOSING_ROWS = 100_000
# A slot of at most this many values per bin keeps its values.
VALUES_PER_BIN = 2
# Trees that are fitted at the same time.
TREES_AT_ONCE = 8
# Trees whose draws are held at the same time.
TREES_PER_DRAW = 24
# Cells from which trees are fitted one after the other, as each fit holds them in memory.
CELLS_AT_ONCE = 4_000_000


def cell_columns(slots: Sequence[int]) -> list[str]:
    return [f"_c{i}" for i in slots]


def slot_columns(rows: DataFrame, vector: str, slots: Sequence[int]) -> DataFrame:
    """``rows`` with a column per slot of the vector, missing ones as NaN."""
    values = [F.coalesce(F.get("_x", F.lit(i)), F.lit(float("nan"))).alias(f"_v{i}") for i in slots]
    return rows.withColumn("_x", vector_to_array(vector)).select(*rows.columns, *values)


def bucketed(rows: DataFrame, slots: Sequence[int], cuts: Mapping[int, Sequence[float]]) -> DataFrame:
    """Slot columns replaced by cells: a slot's bucket, or its value in a slot without cuts.

    Bucket k holds values above cut k-1 and up to cut k, as the splits of a tree do; missing
    values come last, and so go right at every split.
    """
    out = rows.withColumns({f"_c{i}": F.col(f"_v{i}") for i in slots if i not in cuts})
    cut = [i for i in slots if i in cuts]
    if cut:
        # Buckets of the library hold their lower end, so each begins right after a cut.
        splits = [[-np.inf, *np.nextafter(cuts[i], np.inf).tolist(), np.inf] for i in cut]
        out = Bucketizer(
            splitsArray=splits, inputCols=[f"_v{i}" for i in cut], outputCols=cell_columns(cut), handleInvalid="keep"
        ).transform(out)
    return out.drop(*[f"_v{i}" for i in slots])


def weighted_cuts(edges: Sequence[float], masses: Sequence[float], bins: int) -> list[float]:
    """At most ``bins`` - 1 of the edges as cuts, so that bins weigh about the same.

    ``masses`` are those up to the first edge, between edges, and above the last.
    """
    ends = np.cumsum(masses)
    inner = ends[:-1] < ends[-1]
    usable, ends_of = np.asarray(edges)[inner], ends[:-1][inner]
    if not len(usable):
        return []
    wanted = ends[-1] * np.arange(1, bins) / bins
    chosen = np.unique(np.minimum(np.searchsorted(ends_of, wanted), len(usable) - 1))
    return usable[chosen].tolist()


def _cuts(slots: DataFrame, many: Sequence[int], label: str, weights: Mapping[float, float], rows: int, bins: int) -> dict:
    """The cuts of slots of many values.

    Rows picked by their place propose edges, and all rows are counted between them: counts
    do not hang on the order of tasks, so the same rows give the same cuts.
    """
    share = round(min(1.0, PROPOSING_ROWS / rows) * 2**31)
    picked = slots.filter(F.pmod("_place", F.lit(2**31)) < share)
    proposed = picked.agg(*[F.sort_array(F.collect_set(f"_v{i}")).alias(f"_v{i}") for i in many]).first()
    cuts = {}
    for i in many:
        values = proposed[f"_v{i}"]
        at = np.linspace(0, len(values) - 1, min(len(values), EDGES_PER_BIN * bins)).round().astype(int)
        edges = [values[k] for k in np.unique(at)]
        if not edges:
            continue
        counted = bucketed(slots.select(label, f"_v{i}"), [i], {i: edges}).groupBy(label, f"_c{i}").count()
        masses = np.zeros(len(edges) + 2)
        for r in sorted(counted.collect()):
            masses[int(r[f"_c{i}"])] += r["count"] * weights[r[label]]
        # Missing values lie above all cuts.
        masses[-2] += masses[-1]
        cuts[i] = weighted_cuts(edges, masses[:-1], bins)
    return {i: found for i, found in cuts.items() if found}


def _attributes(df: DataFrame, vector: str) -> tuple[dict, set[int]]:
    """The metadata of a vector column, and its categorical slots."""
    metadata = df.schema[vector].metadata
    attributes = metadata.get("ml_attr", {}).get("attrs", {})
    return metadata, {a["idx"] for kind in ("binary", "nominal") for a in attributes.get(kind, [])}


def can_fold(estimator: RandomForestClassifier) -> bool:
    """Whether the settings read rows through their weights alone, so that folded rows give the same."""
    return estimator.getMinInstancesPerNode() == 1 and estimator.getMinWeightFractionPerNode() == 0.0


def _weighed(df: DataFrame, estimator: RandomForestClassifier, place: str) -> tuple[DataFrame, str, str, str]:
    """Rows of vector, label, weight and place, and the names of the first three."""
    vector, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    named = estimator.isDefined(estimator.weightCol)
    weight = F.col(estimator.getWeightCol()) if named else F.lit(1.0)
    columns = [F.col(label).cast("double").alias(label), weight.cast("double").alias("_weight"), F.col(place).alias("_place")]
    return df.select(vector, *columns), vector, label, "_weight"


def _draws(estimator: RandomForestClassifier, trees: Sequence[int]) -> Column:
    """How often each tree draws the rows of a cell: the sum of its rows' own draws."""
    rate, bootstrap = estimator.getSubsamplingRate(), estimator.getBootstrap()
    seeds = [(estimator.getSeed() + t) % 2**63 for t in trees]

    def draws(counts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # Pieces of a layout keep their number and their order, so a piece draws the same again.
        piece = TaskContext.get().partitionId()
        rngs = [np.random.default_rng([seed, piece]) for seed in seeds]
        for n in counts:
            yield pd.DataFrame(
                {f"_d{t}": r.poisson(rate * n) if bootstrap else r.binomial(n, rate) for t, r in zip(trees, rngs)}
            )

    return F.pandas_udf(draws, ", ".join(f"_d{t} long" for t in trees)).asNondeterministic()("_rows")


def fold(
    df: DataFrame, estimator: RandomForestClassifier, place: str
) -> tuple[DataFrame, dict[int, list[float]], dict[float, float]] | None:
    """Cells of rows that no tree can tell apart, staged; the cuts of the slots, and the weight of each label.

    A slot of many values is cut into ``maxBins`` bins of about equal weight, counted over
    all rows; one of few values, or of categories, keeps them. None where rows of one label
    differ in weight, because then weights do not tell how many rows a node holds.
    """
    rows, vector, label, weight = _weighed(df, estimator, place)
    metadata, categorical = _attributes(df, vector)
    size = len(rows.select(vector).first()[0])
    slots = stage(slot_columns(rows, vector, range(size)).drop(vector), "slots")
    numeric = [i for i in range(size) if i not in categorical]
    facts = (
        slots.groupBy(label)
        .agg(
            F.count("*").alias("n"), F.min(weight).alias("least"), F.max(weight).alias("most"),
            *[F.approx_count_distinct(f"_v{i}").alias(f"d{i}") for i in numeric],
        )
        .collect()
    )
    if any(r[label] is None or r["least"] is None or r["least"] != r["most"] or not r["least"] > 0 for r in facts):
        return None
    weights = {r[label]: r["least"] for r in facts}
    bins = estimator.getMaxBins()
    many = [i for i in numeric if max(r[f"d{i}"] for r in facts) > VALUES_PER_BIN * bins]
    cuts = _cuts(slots, many, label, weights, sum(r["n"] for r in facts), bins) if many else {}
    columns = cell_columns(range(size))
    counted = bucketed(slots, range(size), cuts).groupBy(label, weight, *columns).agg(F.count("*").alias("_rows"))
    classes = {"ml_attr": {"type": "nominal", "num_vals": int(max(weights)) + 1}}
    cells = counted.select(
        array_to_vector(F.array(*columns)).alias(vector), label, weight, "_rows", F.xxhash64(label, *columns).alias("_place")
    )
    staged = stage(cells, "cells")
    return (
        staged.withColumn(vector, F.col(vector).alias(vector, metadata=metadata))
        .withColumn(label, F.col(label).alias(label, metadata=classes)),
        cuts,
        weights,
    )


def _subsets(estimator: RandomForestClassifier) -> str:
    """What the strategy means for the whole forest, said of a tree alone."""
    strategy = estimator.getFeatureSubsetStrategy()
    return strategy if strategy != "auto" else "all" if estimator.getNumTrees() == 1 else "sqrt"


def fit_cells(
    estimator: RandomForestClassifier,
    layout: DataFrame,
    cuts: Mapping[int, Sequence[float]],
    weights: Mapping[float, float],
) -> RandomForestClassificationModel:
    """The forest of the folded rows, with splits on the values of the slots.

    Each tree is fitted by itself on its own draws: a cell's draws are distributed as the sum
    of its rows' draws. The stored trees are put together as a stored forest, their splits on
    buckets replaced by the cuts, and cells counted as the rows drawn.
    """
    spark = layout.sparkSession
    vector, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    whole = {estimator.bootstrap: False, estimator.subsamplingRate: 1.0}
    alone = estimator.copy({
        **whole, estimator.numTrees: 1, estimator.featureSubsetStrategy: _subsets(estimator),
        estimator.cacheNodeIds: False, estimator.weightCol: "_drawn_weight",
    })
    path, n_trees, seed = scratch_path(spark, "trees"), estimator.getNumTrees(), estimator.getSeed()
    drawn_anew = estimator.getBootstrap() or estimator.getSubsamplingRate() < 1.0
    with persisted(layout, level=StorageLevel.DISK_ONLY) as (held,):
        at_once = TREES_AT_ONCE if held.count() <= CELLS_AT_ONCE else 1

        def fit_tree(rows: DataFrame, tree: int) -> None:
            drawn = F.col(f"_d{tree}" if drawn_anew else "_rows")
            own = rows.filter(drawn > 0).select(vector, label, (drawn * F.col("_weight")).alias("_drawn_weight"))
            alone.copy({alone.seed: seed + tree}).fit(own).write().save(f"{path}/{tree}")

        with ThreadPool(min(at_once, n_trees)) as pool:
            if not drawn_anew:
                pool.map(lambda t: fit_tree(held, t), range(n_trees), chunksize=1)
            else:
                for start in range(0, n_trees, TREES_PER_DRAW):
                    trees = range(start, min(start + TREES_PER_DRAW, n_trees))
                    draws = held.withColumn("_d", _draws(estimator, trees)).select(vector, label, "_weight", "_d.*")
                    with persisted(draws) as (rows,):
                        rows.count()
                        pool.map(lambda t, rows=rows: fit_tree(rows, t), trees, chunksize=1)
        # A forest of as many trees, to take names and settings from.
        one_each = held.dropDuplicates([label]).select(vector, label, *_weight_column(estimator))
        frame = estimator.copy(whole).fit(one_each)
    for param in whole:
        frame.set(frame.getParam(param.name), estimator.getOrDefault(param))
    frame.write().save(f"{path}/frame")

    known = [(i, [float(c) for c in found]) for i, found in cuts.items()]
    table = spark.createDataFrame(known, "slot int, cuts array<double>")
    trees = spark.read.parquet(*[f"{path}/{t}/data" for t in range(n_trees)]).withColumn(
        "treeID", F.regexp_extract(F.input_file_name(), r"/(\d+)/data/[^/]*$", 1).cast("int")
    )
    split = F.col("nodeData.split")
    place = split["leftCategoriesOrThreshold"]
    # Between buckets a and b, a split lies at the cut after the last whole number below it.
    cut = F.when(F.col("cuts").isNotNull(), F.array(F.get("cuts", F.floor(place[0]).cast("int")))).otherwise(place)
    drawn = sum(F.round(F.col("nodeData.impurityStats")[int(c)] / F.lit(w)) for c, w in weights.items())
    nodes = trees.join(F.broadcast(table), split["featureIndex"] == F.col("slot"), "left").select(
        "treeID",
        F.col("nodeData")
        .withField("rawCount", drawn.cast("long"))
        .withField("split", split.withField("leftCategoriesOrThreshold", cut))
        .alias("nodeData"),
    )
    nodes.write.parquet(f"{path}/forest/data")
    spark.read.text(f"{path}/frame/metadata").write.text(f"{path}/forest/metadata")
    spark.read.parquet(f"{path}/frame/treesMetadata").write.parquet(f"{path}/forest/treesMetadata")
    return RandomForestClassificationModel.load(f"{path}/forest")


def _weight_column(estimator: RandomForestClassifier) -> list[Column]:
    if not estimator.isDefined(estimator.weightCol):
        return []
    return [F.col("_weight").alias(estimator.getWeightCol())]
