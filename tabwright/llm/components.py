"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.scratch import stage


def _least_neighbour(links: DataFrame) -> DataFrame:
    """For each node ``u`` of rows (u, v): the least of itself and its neighbours."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least_neighbour(both), "u")
    return joined.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(down)
    joined = down.join(least, "u").select("v", "least").filter("v > least")
    return joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionAll(
        least.select("u", F.col("least").alias("v"))
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v); the component is its least node.

    Each round is written to the shared folder. Rounds go on until the links do not change;
    their number grows with the logarithm of the longest chain. Minima are combined before
    each shuffle, so a node that holds most links sends one row per task.
    """
    links = stage(links.select("u", "v").filter("u != v").distinct(), "links")
    before = None
    while True:
        sums = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        state = links.agg(F.count("*").alias("n"), sums.alias("sum")).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        links = stage(_small_star(_large_star(links)).filter("u != v").distinct(), "links")
