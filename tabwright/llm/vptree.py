"""Nearest neighbours with a vantage-point tree per shard.

Vectors go to the shard of their nearest centre; centres are spread vectors of a bounded
sample, and a centre with many vectors has several shards. Each shard builds a tree once: a
node's vantage point splits its vectors at the median distance into an inner and an outer
half. A search visits the half that the query lies in first. The other half can be left out
when the query's distance to the border is greater than that to the worst neighbour found so
far, divided by ``relaxation``: at 1 the triangle inequality guarantees the exact result,
above 1 more is left out. Whole shards are left out alike: a query first searches a shard of
its own nearest centre, and then goes only to those whose ball reaches what it found there.
Queries of a block go down a tree together, as arrays. The best of all shards are merged per
query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.support import prepare
from tabwright.scratch import stage

SHARD_ROWS = 8_192
QUERY_ROWS = 4_096
LEAF_ROWS = 256
# Most centres, and vectors of the sample that each is picked from.
MOST_CENTRES = 1_024
SAMPLE_PER_CENTRE = 8

TREE = "dim int, centre int, part int, radius double, ids binary, vectors binary, nodes binary, borders binary, order binary"
FOUND = "query_id long, vec_id long, score double"


class Best:
    """The ``k`` nearest found so far of each query; ties go to the smaller id."""

    def __init__(self, queries: int, k: int) -> None:
        self.distances = np.full((queries, k), np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def worst(self, rows: np.ndarray) -> np.ndarray:
        return self.distances[rows, -1]

    def add(self, rows: np.ndarray, distances: np.ndarray, ids: np.ndarray) -> None:
        """Offer the same ``ids`` to each of ``rows``, at ``distances`` (rows by ids)."""
        k = self.ids.shape[1]
        near = (distances <= self.distances[rows, -1][:, None]).any(axis=1)
        rows, distances = rows[near], distances[near]
        if not len(rows):
            return
        both = np.concatenate([self.distances[rows], distances], axis=1)
        names = np.concatenate([self.ids[rows], np.broadcast_to(ids, distances.shape)], axis=1)
        order = np.lexsort((names, both), axis=1)[:, :k]
        self.distances[rows] = np.take_along_axis(both, order, axis=1)
        self.ids[rows] = np.take_along_axis(names, order, axis=1)


def distances_between(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; squares are added up component by component."""
    total = np.zeros((len(queries), len(vectors)))
    for a, b in zip(queries.T, vectors.T, strict=True):
        apart = a[:, None] - b
        apart *= apart
        total += apart
    return np.sqrt(total)


class Tree:
    """Vantage-point tree over the rows of ``vectors``, in arrays.

    Node i has the row of its vantage point, its inner and its outer child; a leaf has -1 and
    the slice of ``order`` that lists its rows.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS, built: tuple | None = None) -> None:
        self.ids, self.vectors, self.leaf_rows = ids, vectors, leaf_rows
        self.visited = 0
        if built is None:
            made: list[tuple] = []
            order: list[np.ndarray] = [np.empty(0, np.int64)]
            self._build(np.arange(len(ids)), made, order, [0])
            self.nodes = np.array([m[:3] for m in made], np.int64).reshape(-1, 3)
            self.borders = np.array([m[3] for m in made])
            self.order = np.concatenate(order)
        else:
            self.nodes, self.borders, self.order = built

    def _build(self, rows: np.ndarray, made: list[tuple], order: list[np.ndarray], placed: list[int]) -> int:
        number = len(made)
        if len(rows) <= self.leaf_rows:
            made.append((-1, placed[0], placed[0] + len(rows), 0.0))
            order.append(rows)
            placed[0] += len(rows)
            return number
        made.append(())
        # The vantage point is the row farthest from the first one: borders far out cut more.
        first = np.sqrt(((self.vectors[rows] - self.vectors[rows[0]]) ** 2).sum(axis=1))
        point = rows[int(first.argmax())]
        rest = rows[rows != point]
        away = np.sqrt(((self.vectors[rest] - self.vectors[point]) ** 2).sum(axis=1))
        near_first = np.argsort(away, kind="stable")
        half = len(near_first) // 2
        # Inner distances are at most the border, outer ones at least.
        border = float(away[near_first[half]])
        inner = self._build(rest[near_first[:half]], made, order, placed)
        outer = self._build(rest[near_first[half:]], made, order, placed)
        made[number] = (int(point), inner, outer, border)
        return number

    def search(
        self, names: np.ndarray, queries: np.ndarray, k: int, relaxation: float, limits: np.ndarray | None = None
    ) -> Best:
        """The nearest of each query; ``limits`` are distances within which each has ``k`` already."""
        best = Best(len(names), k)
        limits = np.full(len(names), np.inf) if limits is None else limits

        def offer(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
            found = distances_between(queries[rows], self.vectors[points])
            self.visited += found.size
            own = names[rows][:, None] == self.ids[points][None, :]
            best.add(rows, np.where(own, np.inf, found), self.ids[points])
            return found

        def visit(node: int, rows: np.ndarray) -> None:
            if not len(rows):
                return
            point, inner, outer = self.nodes[node]
            if point < 0:
                if outer > inner:
                    offer(rows, self.order[inner:outer])
                return
            border = self.borders[node]
            away = offer(rows, np.array([point]))[:, 0]
            inside = away < border
            visit(inner, rows[inside])
            visit(outer, rows[~inside])
            # A hair of slack: distances are rounded.
            gap = np.abs(away - border) - 1e-9 * (1 + border)
            cross = gap <= np.minimum(best.worst(rows), limits[rows]) / relaxation
            visit(inner, rows[~inside & cross])
            visit(outer, rows[inside & cross])

        visit(0, np.arange(len(names)))
        return best


def spread(vectors: np.ndarray, wanted: int) -> np.ndarray:
    """``wanted`` of the rows, each the farthest from those picked before."""
    picked = [0]
    away = np.sqrt(((vectors - vectors[0]) ** 2).sum(axis=1))
    while len(picked) < min(wanted, len(vectors)) and away.max() > 0:
        picked.append(int(away.argmax()))
        away = np.minimum(away, np.sqrt(((vectors - vectors[picked[-1]]) ** 2).sum(axis=1)))
    return vectors[picked]


def _vectors(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    column = batch.column("vector")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(batch.num_rows, -1)


def _centres(index: DataFrame, wanted: int) -> dict[int, np.ndarray]:
    """Centres by length of vector, from a sample of at most SAMPLE_PER_CENTRE * MOST_CENTRES rows."""
    wanted = min(wanted, MOST_CENTRES)
    sample = index.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_CENTRE * wanted).select("dim", "vector").collect()
    groups: dict[int, list] = {}
    for r in sample:
        groups.setdefault(r["dim"], []).append(r["vector"])
    return {dim: spread(np.array(rows), max(1, wanted * len(rows) // len(sample))) for dim, rows in groups.items()}


def _to_centres(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` (id, vector, dim) with their nearest centre and its distance; -1 where their length has none."""
    kind = "id long, vector array<double>, dim int, centre int, away double"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            centre, away = np.full(len(dims), -1, np.int32), np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if int(dim) in centres:
                    apart = distances_between(_vectors(batch.take(pa.array(at))), centres[int(dim)])
                    centre[at] = apart.argmin(axis=1)
                    away[at] = apart.min(axis=1)
            columns = [*[batch.column(c) for c in ("id", "vector", "dim")], pa.array(centre), pa.array(away)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "dim", "centre", "away"])

    return rows.select("id", "vector", "dim").mapInArrow(assign, kind)


def _grow(group: pa.Table) -> pa.Table:
    """The tree of a shard, packed."""
    ids = group.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    tree = Tree(ids[order], _vectors(group)[order])
    row = {c: group.column(c)[0].as_py() for c in ("dim", "centre", "part")}
    # Rows far from any centre of their length have no ball.
    row["radius"] = float(group.column("away").to_numpy().max()) if row["centre"] >= 0 else float("inf")
    arrays = {"ids": tree.ids, "vectors": tree.vectors, "nodes": tree.nodes, "borders": tree.borders, "order": tree.order}
    packed = {name: np.ascontiguousarray(x).tobytes() for name, x in arrays.items()}
    kinds = [pa.int32()] * 3 + [pa.float64()] + [pa.binary()] * 5
    schema = pa.schema([(f.split()[0], k) for f, k in zip(TREE.split(", "), kinds, strict=True)])
    return pa.Table.from_pylist([{**row, **packed}], schema)


def _search(k: int, relaxation: float) -> Callable:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(queries: pa.Table, trees: pa.Table) -> pa.Table:
        if not queries.num_rows or not trees.num_rows:
            return schema.empty_table()
        row = trees.to_pylist()[0]
        ids = np.frombuffer(row["ids"], np.int64)
        built = [np.frombuffer(row[c], t) for c, t in (("nodes", np.int64), ("borders", np.float64), ("order", np.int64))]
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)
        tree = Tree(ids, vectors, built=(built[0].reshape(-1, 3), *built[1:]))
        names = queries.column("id").to_numpy()
        limits = queries.column("reach").to_numpy()
        best = tree.search(names, _vectors(queries), k, relaxation, limits)
        found = np.isfinite(best.distances)
        columns = [np.repeat(names, found.sum(axis=1)), best.ids[found], best.distances[found]]
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=schema)

    return search


def _visits(asked: DataFrame, trees: DataFrame, centres: dict[int, np.ndarray], relaxation: float) -> DataFrame:
    """id, dim, centre and part of each shard whose ball reaches a query's ``reach``."""
    shards = trees.select("dim", "centre", "part", "radius")
    # At most MOST_CENTRES rows for each length in the sample, and one more for each other length.
    widest = {(r["dim"], r["centre"]): r["radius"] for r in shards.groupBy("dim", "centre").agg(F.max("radius").alias("radius")).collect()}

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            dims, ids, limits = (batch.column(c).to_numpy() for c in ("dim", "id", "reach"))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                known = sorted(c for d, c in widest if d == dim)
                if dim in centres:
                    apart = distances_between(_vectors(batch.take(pa.array(at))), centres[dim])[:, known]
                else:
                    apart = np.zeros((len(at), len(known)))
                least = apart - np.array([widest[dim, c] for c in known]) - 1e-9 * (1 + apart)
                for i, j in zip(*np.nonzero(least <= limits[at][:, None] / relaxation), strict=True):
                    for column, value in zip(rows, (ids[at[i]], dim, known[j], apart[i, j], limits[at[i]]), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
            arrays = [pa.array(r, kind) for r, kind in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "dim", "centre", "apart", "reach"])

    met = asked.select("id", "vector", "dim", "reach").mapInArrow(reach, "id long, dim int, centre int, apart double, reach double")
    near = F.col("apart") - F.col("radius") - 1e-9 * (1 + F.col("apart")) <= F.col("reach") / relaxation
    return met.join(shards, ["dim", "centre"]).filter(near).select("id", "dim", "centre", "part")


def _searched(asked: DataFrame, visits: DataFrame, trees: DataFrame, blocks: int, k: int, relaxation: float) -> DataFrame:
    """query_id, vec_id and score from the visited shards; queries of a block go together."""
    keys = ["dim", "centre", "part", "block"]
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    visits = stage(visits.select("id", "dim", "centre", "part", block), "visits")
    left = visits.join(asked.select("id", "vector", "reach"), "id").groupBy(*keys)
    met = stage(visits.select(*keys).distinct(), "met")
    right = trees.join(met, ["dim", "centre", "part"]).groupBy(*keys)
    return left.cogroup(right).applyInArrow(_search(k, relaxation), FOUND)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    relaxation: float = 1.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of each query's ``k`` nearest vectors.

    A query's own id is no candidate. Distances are taken in double precision; ties go to
    the smaller id. Vectors that are null or zero or hold a null, NaN or infinity take no
    part, nor do rows without an id. A query meets vectors of its own length only. Rows that
    repeat an id count once, with the least of its vectors. Other columns are not read;
    without vectors or queries there are no rows.
    """
    spark = prepare(vectors.sparkSession)

    def usable(df: DataFrame) -> DataFrame:
        vector = F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("vector")
        bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        some = F.exists("vector", lambda x: x != 0)
        rows = df.select(F.col(id_col).cast("long").alias("id"), vector).filter("id is not null and vector is not null")
        rows = rows.filter(~bad & some)
        return rows.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))

    index, asked = stage(usable(vectors), "vectors"), stage(usable(queries), "queries")
    size, n_asked = index.count(), asked.count()
    if not size or not n_asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    centres = _centres(index, -(-size // shard_rows))
    dealt = stage(_to_centres(index, centres), "dealt")
    # A centre with many vectors has several shards.
    parts = dealt.groupBy("dim", "centre").agg(F.ceil(F.count("*") / shard_rows).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")
    shards = dealt.join(parts, ["dim", "centre"]).select("id", "vector", "dim", "centre", "away", part)
    trees = stage(shards.groupBy("dim", "centre", "part").applyInArrow(_grow, TREE), "trees")
    blocks = max(1, -(-n_asked // query_rows))

    # First a shard of the query's own centre: how far its k-th best is there bounds the rest.
    everywhere = F.lit(float("inf")).alias("reach")
    first_part = trees.groupBy("dim", "centre").agg(F.min("part").alias("part"))
    home = stage(_to_centres(asked, centres).select("id", "dim", "centre").join(first_part, ["dim", "centre"]), "home")
    first = stage(_searched(asked.select("*", everywhere), home, trees, blocks, k, relaxation), "first")
    bounds = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") == k, F.max("score")).alias("kth"))
    bounded_ = asked.join(bounds, "id", "left").select("id", "vector", "dim", F.coalesce("kth", everywhere).alias("reach"))
    bounded_ = stage(bounded_, "bounded")
    shard = ["id", "dim", "centre", "part"]
    visits = _visits(bounded_, trees, centres, relaxation).join(home, shard, "left_anti")
    found = first.unionAll(_searched(bounded_, visits, trees, blocks, k, relaxation))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
