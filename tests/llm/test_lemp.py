"""Hard negatives against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm.lemp import LEAST, MOST, Bucket, Questions, Search, feasible, hard_negatives, raised

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows, anchors, positives=5, negatives=5, percent=80, scale=256):
    rows = [(i, tuple(int(np.floor(x * scale)) for x in v), c) for i, v, c in rows]
    out = set()
    for a, q, label in rows:
        if not anchors(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, c) for i, v, c in rows if i != a and len(v) == len(q))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and -s * percent <= -x[0] * 100 <= -s * 100][:negatives]
            out |= {(a, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(fits, 1)}
    return out


def result(df):
    rows = df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    found = [tuple(r) for r in rows]
    assert len(found) == len(set(found))
    return set(found)


@pytest.fixture(scope="module")
def mixed():
    """Clusters, copies, ties, unlike lengths and opposite directions."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    points = centres[rng.integers(0, 12, 400)] * rng.uniform(0.2, 3, (400, 1)) + 0.1 * rng.normal(size=(400, 8))
    points = np.concatenate([points, points[:60], np.ones((50, 8)), -centres, np.zeros((3, 8))])
    return [(i, [float(x) for x in p], int(rng.integers(0, 4))) for i, p in enumerate(points)]


@pytest.mark.parametrize("bucket_rows, block_rows", [(8192, 4096), (64, 8), (7, 1000)])
def test_equals_all_scores(spark, mixed, bucket_rows, block_rows):
    found = hard_negatives(
        spark.createDataFrame(mixed, SCHEMA), F.col("vec_id") % 10 == 0, bucket_rows=bucket_rows, block_rows=block_rows
    )
    assert result(found) == brute_force(mixed, lambda i: i % 10 == 0)


def test_other_numbers(spark, mixed):
    found = hard_negatives(
        spark.createDataFrame(mixed, SCHEMA), F.col("vec_id") < 30, positives=2, negatives=9, least_percent=55,
        scale=16, bucket_rows=100,
    )
    assert result(found) == brute_force(mixed, lambda i: i < 30, 2, 9, 55, 16)


def questions(rows, lows, highs, names=None):
    ids, vectors, labels = (np.array(x) for x in zip(*rows, strict=True))
    owners = np.arange(len(rows))
    return Questions(ids, labels, vectors, owners, owners if names is None else names, np.array(lows), np.array(highs))


def test_lists_leave_most_rows_out():
    """Near-copies at a high threshold are found through a small part of the exact products."""
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(4000, 32))
    vectors[1::2] = vectors[::2] + 0.1 * rng.normal(size=(2000, 32))
    vectors = np.floor(vectors / np.linalg.norm(vectors, axis=1, keepdims=True) * 4096).astype(np.int64)
    labels = np.arange(4000) % 2
    bucket = Bucket(np.arange(4000), labels, vectors)
    asked = questions([(i, vectors[i], labels[i]) for i in range(0, 200, 2)], [0] * 100, [MOST] * 100)
    scores = vectors[0:200:2] @ vectors.T
    asked.lows[:] = (0.97 * (vectors[0:200:2] ** 2).sum(axis=1)).astype(np.int64)
    search = Search(bucket, asked, same_label=False, k=5)
    question, place, score = search.answers()
    found = set(zip(question.tolist(), place.tolist(), score.tolist(), strict=True))
    expected = {(q, p, int(scores[q, p])) for q in range(100) for p in range(1, 4000, 2) if scores[q, p] >= asked.lows[q]}
    assert found == expected and len(found) >= 90
    assert search.verified < 0.2 * 100 * 4000


def test_feasible_ranges_hold_all_answers():
    rng = np.random.default_rng(1)
    rows, anchors = rng.integers(-300, 300, (500, 6)), rng.integers(-300, 300, (40, 6))
    scores = anchors @ rows.T
    lows = np.sort(scores, axis=1)[:, -10]
    bucket = Bucket(np.arange(500), np.zeros(500, np.int64), rows)
    low, high = feasible(anchors, np.sqrt((anchors**2).sum(axis=1)), lows, bucket.longest)
    for i in range(40):
        for row in np.flatnonzero(scores[i] >= lows[i]):
            assert (low[i] <= bucket.unit[:, row]).all() and (bucket.unit[:, row] <= high[i]).all()


def test_short_buckets_are_skipped():
    bucket = Bucket(np.arange(50), np.zeros(50, np.int64), np.ones((50, 4), np.int64))
    search = Search(bucket, questions([(99, [10, 10, 10, 10], 0)], [41], [MOST]), same_label=True, k=3)
    assert len(search.answers()[0]) == 0 and search.verified == 0
    again = Search(bucket, questions([(99, [10, 10, 10, 10], 0)], [40], [MOST]), same_label=True, k=3)
    assert again.answers()[1].tolist() == [0, 1, 2]


def test_raised_ends_keep_the_best():
    rows = [(i, [i, 1], 0) for i in range(8)]
    asked = raised(questions(rows, [LEAST] * 8, [MOST] * 8), True, 2)
    assert asked.lows.tolist() == [min(sorted((i * j + 1 for j in range(8) if j != i), reverse=True)[:2]) for i in range(8)]


def test_large_components_stay_exact(spark):
    rows = [(i, [float((i * 7919) % 8191) * 80, float(i) * 31], i % 2) for i in range(60)]
    found = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0)
    assert result(found) == brute_force(rows, lambda i: i % 10 == 0)


def test_scores_beyond_a_long_are_refused(spark):
    rows = [(0, [1e30], 0), (1, [1e30], 0)]
    with pytest.raises(Exception, match="would not fit into a long"):
        hard_negatives(spark.createDataFrame(rows, SCHEMA), F.lit(True)).collect()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.9, 0.1], 2), (2, [0.9, 0.1], 2),
        (3, None, 1), (4, [None, 1.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 2), (7, [1.0, 1.0], None),
        (None, [1.0, 0.0], 1), (8, [], 1), (9, [], 2), (10, [0.0, 0.0], 1), (11, [0.0, 0.0], 2), (12, [5.0, 1.0, 1.0], 1),
        (13, [1.0, 0.1], 1), (13, [9.0, 9.0], 3),
    ]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit("x"), "id": F.lit(7), "rank": F.lit(None)})
    clean = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.9, 0.1], 2), (8, [], 1), (9, [], 2), (10, [0.0, 0.0], 1)]
    clean += [(11, [0.0, 0.0], 2), (12, [5.0, 1.0, 1.0], 1), (13, [1.0, 0.1], 1)]
    assert result(hard_negatives(odd, F.col("vec_id") >= 0)) == brute_force(clean, lambda i: True)
    assert result(hard_negatives(odd, F.lit(None).cast("boolean"))) == set()
    assert result(hard_negatives(odd.limit(0), F.lit(True))) == set()
    assert result(hard_negatives(odd.filter("embedding is null"), F.lit(True))) == set()
