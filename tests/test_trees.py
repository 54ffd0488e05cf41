"""Forests as node tables: walked by SQL, routed by joins, and held against their rows."""

import duckdb
import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators.models import forest, score
from tabwright.operators.trees import forest_nodes, leaf_rates, route, routed_probability
from tabwright.scratch import stage

WALK = """with recursive walk as (
    select r.id, n.tree, 0 as at from rows r, (select distinct tree from nodes) n
    union all
    select w.id, w.tree, case when x <= threshold then "left" else "right" end
    from walk w join nodes n on n.tree = w.tree and n.node = w.at and n."left" is not null
    join (select id, unnest(xs) as x, unnest(range(len(xs))) as feature from rows) v on v.id = w.id and v.feature = n.feature)
select id, avg(probability) as probability from walk w join nodes n on n.tree = w.tree and n.node = w.at
where n."left" is null group by id"""


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    data = []
    for i in range(900):
        x, y, z = (float(v) for v in rng.normal(size=3))
        data.append((i, x, y, z, float(rng.uniform() < (0.85 if x * y > 0 else 0.2)), float(rng.uniform(0.5, 2))))
    df = spark.createDataFrame(data, "id int, x double, y double, z double, label double, classWeight double")
    return stage(VectorAssembler(inputCols=["x", "y", "z"], outputCol="unscaled_features").transform(df), "rows")


@pytest.fixture(scope="module")
def fitted(rows):
    return forest(numTrees=12, maxDepth=8).fit(rows)


def test_walking_the_nodes_in_sql_gives_the_probabilities(spark, rows, fitted):
    con = duckdb.connect()
    con.register("nodes", forest_nodes(spark, fitted).drop("weights", "categories").toPandas())
    con.register("rows", rows.select("id", vector_to_array("unscaled_features").alias("xs")).toPandas())
    walked = dict(con.sql(WALK).fetchall())
    expected = {r["id"]: r["probability"] for r in score(fitted, rows, ["id"]).collect()}
    assert len(expected) == 900 and walked == pytest.approx(expected, abs=1e-12)


def test_routing_by_joins_gives_the_probabilities(spark, rows, fitted):
    found = routed_probability(route(rows, forest_nodes(spark, fitted), ["id"]), ["id"])
    expected = {r["id"]: r["probability"] for r in score(fitted, rows, ["id"]).collect()}
    assert {r["id"]: r["probability"] for r in found.collect()} == pytest.approx(expected, abs=1e-12)
    assert {r["n_trees"] for r in found.collect()} == {12}


def test_large_node_tables_are_not_broadcast(spark, rows, fitted, monkeypatch):
    monkeypatch.setattr("tabwright.operators.trees.BROADCAST_NODES", 0)
    found = route(rows, forest_nodes(spark, fitted), ["id"])
    assert "rightHint=(strategy=broadcast)" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 12 * 900


def test_node_tables(spark, rows, fitted):
    nodes = forest_nodes(spark, fitted)
    assert nodes.count() == fitted.totalNumNodes
    assert nodes.filter("node = 0 and depth = 0").count() == 12
    assert nodes.agg(F.max("depth")).first()[0] == max(t.depth for t in fitted.trees)
    # Children lie one level below, and hold their parent's rows between them.
    left, right = [nodes.select("tree", F.col("node").alias(c), F.col("rows").alias(f"{c}_rows"), F.col("depth").alias(f"{c}_depth")) for c in ("left", "right")]
    met = nodes.filter("left is not null").join(left, ["tree", "left"]).join(right, ["tree", "right"])
    assert met.count() == nodes.filter("left is not null").count()
    assert met.filter("left_rows + right_rows != rows or left_depth != depth + 1 or right_depth != depth + 1").count() == 0


def test_leaves_have_the_rates_of_their_rows(spark, rows):
    model = forest(numTrees=5, maxDepth=6, bootstrap=False).fit(rows)
    nodes = forest_nodes(spark, model)
    leaves = leaf_rates(route(rows, nodes, ["label", "classWeight"]), nodes).collect()
    assert len(leaves) == nodes.filter("left is null").count()
    for leaf in leaves:
        assert leaf["rows"] == leaf["routed_rows"] and leaf["rate"] == pytest.approx(leaf["probability"], abs=1e-12)
    # Rows of another set do not.
    other = rows.withColumn("label", 1 - F.col("label"))
    wrong = leaf_rates(route(other, nodes, ["label", "classWeight"]), nodes).filter("abs(rate - probability) > 1e-6")
    assert wrong.count() > 0


def test_categorical_slots(spark):
    df = spark.range(400).selectExpr("id", "cast(id % 7 as double) as k", "cast(id % 5 as double) as x", "cast(id % 7 in (1, 4, 6) as double) as label")
    vectors = VectorAssembler(inputCols=["k", "x"], outputCol="v").transform(df)
    indexed = VectorIndexer(inputCol="v", outputCol="unscaled_features", maxCategories=7).fit(vectors).transform(vectors)
    model = forest(weight=None, numTrees=3, maxDepth=3).fit(indexed)
    nodes = forest_nodes(spark, model)
    assert nodes.filter("categories is not null").count() > 0
    found = routed_probability(route(indexed, nodes, ["id"]), ["id"])
    expected = {r["id"]: r["probability"] for r in score(model, indexed, ["id"]).collect()}
    assert {r["id"]: r["probability"] for r in found.collect()} == pytest.approx(expected, abs=1e-12)
