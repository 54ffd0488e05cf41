"""Forests fitted on folded rows: all rows weighed and drawn, splits on values, counts of rows."""

import numpy as np
import pytest
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import models
from tabwright.operators.folds import bucketed, fold, weighted_cuts
from tabwright.operators.models import PLACE, fit_layout, fitted, forest, row_place, score
from tabwright.operators.trees import forest_grid, forest_nodes, leaf_rates, route, routed_probability
from tabwright.scratch import stage

ROWS = 6000


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    data = []
    for i in range(ROWS):
        x, k, c = float(rng.exponential()), float(rng.integers(5)), float(rng.integers(3))
        label = float(rng.uniform() < (0.8 if (x > 0.7) != (k > 2) else 0.3) - 0.1 * c)
        data.append((i, x, k, c, label, 1.5 if label else 0.75))
    df = spark.createDataFrame(data, "id int, x double, k double, c double, label double, classWeight double")
    df = OneHotEncoder(inputCol="c", outputCol="h").fit(df).transform(df)
    made = VectorAssembler(inputCols=["x", "k", "h"], outputCol="unscaled_features").transform(df)
    kept = made.select("id", "unscaled_features", "label", "classWeight", row_place("id").alias(PLACE))
    return stage(kept, "rows")


@pytest.fixture
def folding(monkeypatch):
    monkeypatch.setattr(models, "FOLDED_FROM", 0)
    monkeypatch.setattr(models, "ROWS_PER_FOLD", 2)


def leaves(spark, model, rows):
    nodes = forest_nodes(spark, model)
    return nodes, leaf_rates(route(rows, nodes, ["label", "classWeight"]), nodes).collect()


def test_large_forests_read_folded_rows(rows, folding, monkeypatch):
    laid = []
    monkeypatch.setattr(models, "fit_layout", lambda df, n, **kw: laid.append(n) or fit_layout(df, n, **kw))
    (model,) = fitted(forest(numTrees=2, maxDepth=3), rows, ROWS)
    # 32 bins, 5 values, 3 categories and 2 labels.
    assert laid[0] <= 32 * 5 * 3 * 2 < ROWS // 2
    assert model.getNumTrees == 2 and model.getBootstrap() and model.getOrDefault("numTrees") == 2


def test_leaves_of_folded_forests_hold_their_rows(spark, rows, folding):
    (model,) = fitted(forest(numTrees=4, maxDepth=6, bootstrap=False), rows, ROWS)
    nodes, found = leaves(spark, model, rows)
    assert nodes.filter("node = 0").select("rows").distinct().collect() == [(ROWS,)]
    assert nodes.filter("categories is not null").count() > 0 and nodes.filter("feature = 0").count() > 0
    for leaf in found:
        assert leaf["rows"] == leaf["routed_rows"] and leaf["rate"] == pytest.approx(leaf["probability"], abs=1e-12)
    expected = {r["id"]: r["probability"] for r in score(model, rows, ["id"]).collect()}
    routed = routed_probability(route(rows, nodes, ["id"]), ["id"]).collect()
    assert {r["id"]: r["probability"] for r in routed} == pytest.approx(expected, abs=1e-12)


def test_slots_of_few_values_give_the_plain_tree(spark, rows, folding):
    few = VectorAssembler(inputCols=["k", "q"], outputCol="unscaled_features").transform(
        rows.withColumn("_x", vector_to_array("unscaled_features"))
        .select("label", "classWeight", PLACE, F.get("_x", F.lit(1)).alias("k"), F.round(F.get("_x", F.lit(0)) * 4).alias("q"))
    )
    tree = forest(numTrees=1, maxDepth=5, bootstrap=False, featureSubsetStrategy="all", maxBins=64)
    (folded,) = fitted(tree, few, ROWS)
    plain = tree.fit(fit_layout(few, ROWS))
    columns = ["node", "feature", "threshold", "rows"]
    a, b = (sorted(forest_nodes(spark, m).select(*columns).collect(), key=lambda r: r["node"]) for m in (folded, plain))
    assert a == b


def test_trees_draw_rows_not_folds(spark, rows, folding):
    (model,) = fitted(forest(numTrees=40, maxDepth=2), rows, ROWS)
    drawn = [r["rows"] for r in forest_nodes(spark, model).filter("node = 0").collect()]
    # The number of drawn rows deviates by the root of the rows; draws of whole folds would by several times that.
    assert len(set(drawn)) > 30 and abs(np.mean(drawn) - ROWS) < 60
    assert 0.6 < np.std(drawn) / np.sqrt(ROWS) < 1.5


def test_same_rows_give_the_same_folded_forest(spark, rows, folding):
    fits = [fitted(forest(numTrees=3, maxDepth=4), rows.repartition(n), ROWS)[0] for n in (3, 7)]
    assert len({m.toDebugString.split("\n", 1)[1] for m in fits}) == 1


def test_settings_that_count_rows_are_not_folded(rows, folding):
    laid = fitted(forest(numTrees=1, maxDepth=4, bootstrap=False, minInstancesPerNode=700), rows, ROWS)[0]
    plain = forest(numTrees=1, maxDepth=4, bootstrap=False, minInstancesPerNode=700).fit(fit_layout(rows, ROWS))
    assert laid.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1]
    uneven = rows.withColumn("classWeight", 1.0 + F.col("id") % 2)
    assert fold(uneven, forest(), PLACE) is None


def test_buckets_part_values_as_splits_do(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 1.0000000000000002, 2.0, 3.0, float("nan"))], "_v0 double")
    found = [r["_c0"] for r in bucketed(df, [0], {0: [1.0, 2.0]}).collect()]
    assert found == [0, 0, 1, 1, 2, 3]


def test_cuts_share_the_weight():
    assert weighted_cuts([1.0, 2.0, 3.0, 4.0], [1, 1, 1, 1, 0], 4) == [1.0, 2.0, 3.0]
    assert weighted_cuts([1.0, 2.0, 3.0], [97, 1, 1, 1], 2) == [1.0]
    assert weighted_cuts([5.0], [3, 0], 32) == []


def test_cells_take_the_way_of_their_rows(spark, rows):
    model = forest(numTrees=6, maxDepth=7).fit(rows)
    nodes = forest_nodes(spark, model)
    grid = forest_grid(nodes)
    celled = stage(grid.of(rows.select("id", "unscaled_features")), "celled")
    cells = celled.select(*grid.columns).distinct().withColumn("unscaled_features", grid.vector())
    assert cells.count() < ROWS
    routed = routed_probability(route(cells, nodes, grid.columns), grid.columns)
    found = {r["id"]: r["probability"] for r in celled.join(routed, grid.columns).collect()}
    expected = {r["id"]: r["probability"] for r in score(model, rows, ["id"]).collect()}
    assert found == pytest.approx(expected, abs=1e-12)
