import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from tabwright.operators.encode import build_pipeline
from tabwright.operators import models
from tabwright.operators.models import PLACE, fit_layout, forest, logistic, row_place, score
from tabwright.operators.search import featurize
from tabwright.operators.stats import fit_class_weights, with_class_weight
from tabwright.scratch import scratch_path, stage
from tabwright.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    n = 1200
    x, z = rng.normal(size=n), rng.normal(size=n)
    label = (rng.uniform(size=n) < 1 / (1 + np.exp(-(1.5 * x - z - 1)))).astype(float)
    data = [(i, float(a), float(b), float(y)) for i, (a, b, y) in enumerate(zip(x, z, label))]
    df = spark.createDataFrame(data, "id int, x double, z double, label double")
    return stage(with_class_weight(df, fit_class_weights(df)).withColumn(PLACE, row_place("id")), "rows")


def newton(features, labels, weights, ridge, steps=50):
    """Brute force: the weighted logistic optimum with a ridge on all but the intercept."""
    design = np.column_stack([features, np.ones(len(features))])
    penalty = np.diag([ridge] * features.shape[1] + [0.0])
    total, beta = weights.sum(), np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weights * (p - labels)) / total + penalty @ beta
        hessian = (design * (weights * p * (1 - p))[:, None]).T @ design / total + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta


def test_logistic_reaches_the_weighted_optimum(spark, rows):
    fitted = build_pipeline([], ["x", "z"], logistic()).fit(rows)
    features = featurize(fitted, rows, weight="classWeight")
    pdf = features.select(vector_to_array("features").alias("f"), "label", "classWeight").toPandas()
    expected = newton(np.stack(pdf.f), pdf.label.values, pdf.classWeight.values, ridge=0.01)
    model = fitted.stages[-1]
    assert [*model.coefficients, model.intercept] == pytest.approx(expected, abs=2e-3)


def test_forest_repeats_on_the_same_layout(spark, rows):
    fits = [build_pipeline([], ["x", "z"], forest(numTrees=5, maxDepth=4), scale=False).fit(rows) for _ in range(2)]
    first, second = (score(m, rows, ["id"]).orderBy("id").collect() for m in fits)
    assert first == second


def test_cached_node_ids_change_speed_only(rows):
    vectors = featurize(build_pipeline([], ["x", "z"], scale=False).fit(rows), rows, weight="classWeight")
    trees = [
        forest(numTrees=5, maxDepth=6, cacheNodeIds=cached).fit(vectors).toDebugString.split("\n", 1)[1]
        for cached in (True, False)
    ]
    assert trees[0] == trees[1]


def test_layout_depends_on_the_rows_alone(spark, rows, monkeypatch):
    vectors = build_pipeline([], ["x", "z"], scale=False).fit(rows).transform(rows)
    fits = [
        forest(numTrees=5, maxDepth=4).fit(fit_layout(vectors.repartition(n), 1200)).toDebugString.split("\n", 1)[1]
        for n in (1, 3, 7)
    ]
    assert fits[0] == fits[1] == fits[2]
    assert fit_layout(vectors, 1200).rdd.getNumPartitions() == models.LEAST_PIECES
    assert fit_layout(vectors, 1200, pieces=3).rdd.getNumPartitions() == 3
    monkeypatch.setattr(models, "ROWS_PER_PIECE", 100)
    assert fit_layout(vectors, 1200).rdd.getNumPartitions() == 12


SAME_FOREST = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master(sys.argv[1]).config("spark.ui.enabled", "false").config("spark.driver.memory", "2g").getOrCreate()
from catalog.modelling import _parts, CATEGORICAL, NUMERIC
from tabwright.operators.models import forest
from tabwright.operators.search import fit_model, training_set
train, _ = _parts(spark, "/root/testdata/sf0.01")
model = fit_model(forest(numTrees=3, maxDepth=4), training_set(train, CATEGORICAL, NUMERIC), scale=False)
print("TREES", hash(model.stages[-1].toDebugString.split("\\n", 1)[1]))
"""


def test_same_forest_on_any_number_of_cores():
    outputs = []
    for master in ("local[2]", "local[8]"):
        done = subprocess.run(
            [sys.executable, "-c", SAME_FOREST, master], capture_output=True, text=True, timeout=600,
            env=os.environ | {"PYTHONHASHSEED": "1", "PYTHONPATH": str(Path(__file__).resolve().parents[1])},
        )
        assert done.returncode == 0, done.stderr[-2000:]
        outputs.append([line for line in done.stdout.splitlines() if line.startswith("TREES")])
    assert outputs[0] == outputs[1] and len(outputs[0]) == 1


def test_defaults_of_the_two_models():
    lr, rf = logistic(), forest()
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getElasticNetParam(), lr.getWeightCol()) == (100, 0.01, 0.0, "classWeight")
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getSeed(), rf.getFeaturesCol()) == (100, 8, 42, "unscaled_features")
    assert logistic(maxIter=5).getMaxIter() == 5


def test_reloaded_model_scores_alike(spark, rows):
    model = build_pipeline([], ["x", "z"], logistic()).fit(rows)
    loaded = load_model(save_model(model, scratch_path(spark, "model")))
    assert score(model, rows, ["id"]).orderBy("id").collect() == score(loaded, rows, ["id"]).orderBy("id").collect()
    assert score(model, rows, ["id", "label"]).columns == ["id", "label", "probability", "prediction"]
