"""Nearest neighbours against all distances."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import vptree
from tabwright.llm.vptree import Tree, nearest


def brute_force(rows, queries, k):
    out = {}
    for q, a in queries:
        found = sorted((float(np.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))), i) for i, b in rows if i != q and len(a) == len(b))
        out[q] = [i for _, i in found[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def by_query(result):
    out = {}
    for r in sorted(result.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


@pytest.fixture(scope="module")
def clustered():
    """Copies, clusters and ties on a grid."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 6)) * 4
    points = np.concatenate([centres[rng.integers(0, 8, 700)] + rng.normal(size=(700, 6)), rng.integers(1, 3, (150, 6))])
    return [(i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points)]


def test_exact_search(spark, clustered):
    docs = table(spark, clustered)
    found = by_query(nearest(docs, docs.filter("vec_id % 10 = 0"), k=7, shard_rows=300, query_rows=20))
    assert found == brute_force(clustered, [r for r in clustered if r[0] % 10 == 0], 7)


def test_scores_and_ranks(spark, clustered):
    docs = table(spark, clustered)
    vectors = dict(clustered)
    for r in nearest(docs, docs.filter("vec_id % 50 = 0"), k=5, shard_rows=100).collect():
        assert 1 <= r["rank"] <= 5
        assert r["score"] == pytest.approx(np.linalg.norm(np.subtract(vectors[r["query_id"]], vectors[r["vec_id"]])))


def test_relaxing_visits_less_and_keeps_recall(clustered):
    ids = np.array([i for i, _ in clustered])
    vectors = np.array([v for _, v in clustered])
    asked = ids % 10 == 0
    visited, recall, exact = [], [], None
    for relaxation in (1.0, 2.0, 4.0):
        tree = Tree(ids, vectors, leaf_rows=8)
        best = tree.search(ids[asked], vectors[asked], 5, relaxation)
        exact = best.ids if exact is None else exact
        visited.append(tree.visited)
        recall.append(np.mean([len(set(a) & set(b)) / 5 for a, b in zip(best.ids, exact)]))
    assert visited[0] < 0.8 * len(ids) * asked.sum()
    assert visited[0] > visited[1] > visited[2]
    assert recall[0] == 1 and recall[1] >= 0.95


def test_queries_skip_shards_of_clustered_vectors(spark, monkeypatch):
    """At factor 1 the result is exact and most (query, shard) pairs and most vectors are left out."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(16, 32)) * 5
    points = centres[rng.integers(0, 16, 4000)] + 0.4 * rng.normal(size=(4000, 32))
    rows = [(i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points)]
    docs = table(spark, rows)
    real, visits = vptree._searched, []

    def counted(asked, visited, trees, *rest):
        visits.append((visited.count(), trees.count()))
        return real(asked, visited, trees, *rest)

    monkeypatch.setattr(vptree, "_searched", counted)
    queries = docs.filter("vec_id % 40 = 0")
    found = by_query(nearest(docs, queries, k=5, shard_rows=250))
    assert found == brute_force(rows, [r for r in rows if r[0] % 40 == 0], 5)
    shards = visits[0][1]
    assert shards >= 16 and sum(v for v, _ in visits) < 0.5 * 100 * shards


@pytest.mark.parametrize("relaxation, least", [(1.0, 1.0), (2.0, 0.95), (4.0, 0.9)])
def test_recall_of_relaxed_searches(spark, clustered, relaxation, least):
    docs = table(spark, clustered)
    exact = brute_force(clustered, [r for r in clustered if r[0] % 10 == 0], 5)
    found = by_query(nearest(docs, docs.filter("vec_id % 10 = 0"), k=5, relaxation=relaxation, shard_rows=200))
    assert np.mean([len(set(found[q]) & set(ids)) / 5 for q, ids in exact.items()]) >= least


def test_many_vectors_of_one_centre_and_mixed_lengths(spark):
    rows = [(i, [1.0, 2.0, float(i % 3)]) for i in range(300)] + [(1000 + i, [float(i), 1.0]) for i in range(5)]
    docs = table(spark, rows)
    found = by_query(nearest(docs, docs.filter("vec_id % 100 = 0"), k=4, shard_rows=20))
    assert found == brute_force(rows, [r for r in rows if r[0] % 100 == 0], 4)


def test_packed_trees_search_alike(clustered):
    ids, vectors = np.array([i for i, _ in clustered]), np.array([v for _, v in clustered])
    tree = Tree(ids, vectors, leaf_rows=16)
    again = Tree(ids, vectors, built=(tree.nodes, tree.borders, tree.order))
    one, two = tree.search(ids[:50], vectors[:50], 7, 1.0), again.search(ids[:50], vectors[:50], 7, 1.0)
    assert (one.ids == two.ids).all() and sorted([*tree.order, *tree.nodes[tree.nodes[:, 0] >= 0, 0]]) == list(range(len(ids)))


def test_given_embeddings_recall(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in docs.collect()]
    found = by_query(nearest(docs, docs.filter("vec_id % 100 = 0"), shard_rows=100))
    assert found == brute_force(rows, [r for r in rows if r[0] % 100 == 0], 10)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 1.0]),
            (6, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (None, [1.0, 0.0]), (8, [1.0]), (9, []), (10, [2.0, 0.0])]
    docs = table(spark, rows).withColumns({"id": F.lit("x"), "shard": F.lit(1), "vector": F.lit(None)})
    found = by_query(nearest(docs, docs, k=10))
    assert found == {0: [6, 7, 10], 6: [0, 7, 10], 7: [0, 6, 10], 10: [0, 6, 7]}
    assert nearest(docs.limit(0), docs).count() == 0
    assert nearest(docs, docs.limit(0)).count() == 0
