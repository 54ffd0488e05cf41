"""A fitted forest as a table of nodes, and rows routed through it by joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators.encode import RAW_VECTOR
from tabwright.operators.folds import bucketed, cell_columns, slot_columns
from tabwright.scratch import scratch_path, stage

# A node table is broadcast only when it was counted and is not longer than this.
BROADCAST_NODES = 1_000_000


def forest_nodes(spark, model: RandomForestClassificationModel | PipelineModel) -> DataFrame:
    """A row per node of a fitted forest, staged.

    tree, node (0: the root), depth, feature (its slot in the vector), threshold or
    categories (of a categorical slot, those that go left), left and right (null in leaves),
    impurity, gain, rows (drawn ones, a row drawn twice counting twice), weights per class,
    probability of the positive class and prediction.
    """
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    path = scratch_path(spark, "forest")
    model.write().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    inner = node["leftChild"] >= 0
    numeric = split["numCategories"] < 0
    stored = stage(
        spark.read.parquet(f"{path}/data").select(
            F.col("treeID").alias("tree"), node["id"].alias("node"),
            F.when(inner, split["featureIndex"]).alias("feature"),
            F.when(inner & numeric, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
            F.when(inner & ~numeric, split["leftCategoriesOrThreshold"]).alias("categories"),
            F.when(inner, node["leftChild"]).alias("left"), F.when(inner, node["rightChild"]).alias("right"),
            node["impurity"].alias("impurity"), F.when(inner, node["gain"]).alias("gain"),
            node["rawCount"].alias("rows"), node["impurityStats"].alias("weights"),
            (node["impurityStats"][1] / (node["impurityStats"][0] + node["impurityStats"][1])).alias("probability"),
            node["prediction"].alias("prediction"),
        ),
        "nodes",
    )
    children = stored.filter("left is not null").select("tree", F.explode(F.array("left", "right")).alias("node"), F.col("node").alias("parent"))
    level = stored.filter("node = 0").select("tree", "node")
    depths = level.withColumn("depth", F.lit(0))
    for depth in range(1, model.getMaxDepth() + 1):
        level = children.join(level.withColumnRenamed("node", "parent"), ["tree", "parent"]).select("tree", "node")
        depths = depths.unionAll(level.withColumn("depth", F.lit(depth)))
    return stage(stored.join(depths, ["tree", "node"]), "nodes")


def route(rows: DataFrame, nodes: DataFrame, keep: Sequence[str], vector: str = RAW_VECTOR) -> DataFrame:
    """The kept columns, tree, leaf and the leaf's probability: a row per row and tree.

    A step down is a join with the splits, which are broadcast when counted and few: rows
    stay where they are, and no tree is walked row by row.
    """
    facts = nodes.agg(F.count("*").alias("n"), F.max("tree").alias("last"), F.max("depth").alias("depth")).first()
    if not facts["n"]:
        raise ValueError("no nodes to route rows through")
    splits = nodes.filter("left is not null").select(
        F.col("tree").alias("of"), F.col("node").alias("at"), "feature", "threshold", "categories", "left", "right"
    )
    leaves = nodes.filter("left is null").select(F.col("tree").alias("of"), F.col("node").alias("leaf"), "probability")
    if facts["n"] <= BROADCAST_NODES:
        splits, leaves = F.broadcast(splits), F.broadcast(leaves)
    trees = F.explode(F.sequence(F.lit(0), F.lit(facts["last"]))).alias("tree")
    now = rows.select(*keep, vector_to_array(vector).alias("_x"), trees).withColumn("_at", F.lit(0))
    for _ in range(facts["depth"]):
        met = now.join(splits, (F.col("tree") == F.col("of")) & (F.col("_at") == F.col("at")), "left")
        x = F.get("_x", F.col("feature"))
        goes_left = F.when(F.col("categories").isNotNull(), F.array_contains("categories", x)).otherwise(x <= F.col("threshold"))
        step = F.when(F.col("left").isNull(), F.col("_at")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        now = met.select(*keep, "_x", "tree", step.alias("_at"))
    found = now.join(leaves, (F.col("tree") == F.col("of")) & (F.col("_at") == F.col("leaf")))
    return found.select(*keep, "tree", "leaf", "probability")


@dataclass(frozen=True)
class Grid:
    """The cells that a forest's splits cut rows into: rows of one cell go to the same leaves."""

    slots: Sequence[int]
    cuts: Mapping[int, Sequence[float]]

    @property
    def columns(self) -> list[str]:
        return cell_columns(self.slots)

    def of(self, rows: DataFrame, vector: str = RAW_VECTOR) -> DataFrame:
        """``rows`` with the columns of their cell in place of the vector."""
        return bucketed(slot_columns(rows, vector, self.slots), self.slots, self.cuts).drop(vector)

    def vector(self) -> Column:
        """A vector of the cell: it lies at the cut that ends each bucket."""
        values = [F.lit(0.0)] * (max(self.slots) + 1)
        for i in self.slots:
            values[i] = F.col(f"_c{i}")
            if i in self.cuts:
                ends = F.array(*[F.lit(float(c)) for c in self.cuts[i]])
                values[i] = F.coalesce(F.get(ends, values[i].cast("int")), F.lit(float("inf")))
        return array_to_vector(F.array(*values))


def forest_grid(nodes: DataFrame) -> Grid:
    """The grid of a node table. The driver lists its distinct splits, at most the bins of each slot."""
    splits = nodes.filter("left is not null").groupBy("feature")
    found = {r["feature"]: r["cuts"] for r in splits.agg(F.sort_array(F.collect_set("threshold")).alias("cuts")).collect()}
    return Grid(sorted(found) or [0], {i: cuts for i, cuts in found.items() if cuts})


def routed_probability(routed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The forest's probability of each row: the mean over its trees; and the number of trees."""
    return routed.groupBy(*keys).agg(F.avg("probability").alias("probability"), F.count("*").alias("n_trees"))


def leaf_rates(
    routed: DataFrame, nodes: DataFrame, label: str = "label", weight: str = "classWeight", count: str | None = None
) -> DataFrame:
    """tree, leaf, rows and rate of the routed rows of each leaf, beside the leaf's own numbers.

    ``routed`` keeps the label and the weight, and ``count`` where a row stands for several.
    Rows of a training set that was not resampled give every leaf its own rows and its own rate.
    """
    rows = F.lit(1) if count is None else F.col(count)
    weighed = F.col(weight) * rows
    found = routed.groupBy("tree", "leaf").agg(
        F.sum(rows).alias("routed_rows"), (F.sum(weighed * F.col(label)) / F.sum(weighed)).alias("rate")
    )
    own = nodes.filter("left is null").select("tree", F.col("node").alias("leaf"), "rows", "probability")
    return own.join(found, ["tree", "leaf"], "left").fillna(0, ["routed_rows"])
