"""Mixing: targets by the stated rule, whole passes first, and what is taken."""

import math
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tabwright.llm import mixing
from tabwright.llm.mixing import mix_sources, mixed_documents
from tabwright.llm.queries import MIXING_SQL
from tests.compare import difference
from tests.llm.helpers import DOCUMENT, documents


def targets(sizes: dict) -> dict:
    """By rounds: share, stop what is above, share the excess again."""
    order = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(stopped.values())
        out = {s: left * weights[s] / sum(weights[f] for f in free) for s in free}
        above = [s for s in free if out[s] > 3 * sizes[s]]
        if not above:
            return stopped | out
        stopped |= {s: 3 * sizes[s] for s in above}


def check(rows):
    size, target, taken, largest = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for r in rows:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["taken"] == r["size"] * r["copies"] and r["copies"] <= 3
    wanted = targets(size)
    for s in size:
        assert target[s] == pytest.approx(wanted[s])
        assert target[s] - largest[s] <= taken[s] <= target[s] + 1e-6
        # Whole passes first: the numbers of copies of a source differ by one at most.
        copies = {r["copies"] for r in rows if r["source"] == s and r["size"]}
        assert not copies or max(copies) - min(copies) <= 1


def mixed(docs):
    return mix_sources(docs).join(docs.select("doc_id", "source"), "doc_id").collect()


def test_targets_and_budgets(spark):
    texts, sources = [], []
    for s, n in (("b", 400), ("a", 5), (None, 60), ("é", 30), ("z", 2), ("", 1)):
        texts += ["w " * (i * 7 % 23 + 1) for i in range(n)]
        sources += [s] * n
    check(mixed(documents(spark, texts, sources=sources)))


def test_ranges_do_not_change_the_result(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = sorted(mix_sources(docs).collect())
    monkeypatch.setattr(mixing, "RANGE_ROWS", 2)
    assert sorted(mix_sources(docs.repartition(3)).collect()) == one


def test_quality_draws_more_often(spark):
    clean, junk = "abc " * 20, "a#! " * 20
    docs = documents(spark, [clean, junk] * 500, sources=["a"] * 1000)
    docs = docs.unionAll(documents(spark, [(5000, "w " * 90_000)], sources=["b"]))
    rows = [r for r in mix_sources(docs).collect() if r["doc_id"] < 5000]
    extra = [sum(r["copies"] for r in rows if r["doc_id"] % 2 == odd) for odd in (0, 1)]
    base = min(r["copies"] for r in rows) * 500
    assert extra[0] > extra[1] > base or extra[0] == extra[1] == base == 1500


def test_draw_is_uniform(spark):
    rows = spark.range(20_000).select(mixing.draw(11, "id").alias("u")).collect()
    assert sum(r["u"] for r in rows) / 20_000 == pytest.approx(0.5, abs=0.01)
    assert all(0 < r["u"] < 1 for r in rows)
    assert sum(-math.log(r["u"]) for r in rows) / 20_000 == pytest.approx(1, abs=0.03)


def test_mix_repeats_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("row", F.lit("clash"))
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(docs).collect()}
    mixed_rows = mixed_documents(docs)
    assert mixed_rows.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in mixed_rows.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in copies.items() if n}


@pytest.mark.parametrize("parts", [1, 7])
def test_equal_rows_are_taken_one_by_one(spark, parts):
    """Half of a source are rows equal in text and (null) id: the target is still met within a document."""
    rng = random.Random(3)
    rows = [(None, "w " * 9) for _ in range(1000)] + [(i, "w " * rng.randrange(1, 9)) for i in range(1000)]
    rows += [(5, "x " * 4)] * 300
    docs = documents(spark, rows, sources=["a"] * 2000 + ["c"] * 300)
    docs = docs.unionAll(documents(spark, [(9000, "w " * 3000)], sources=["b"])).repartition(parts)
    taken, target = defaultdict(int), {}
    found = mix_sources(docs).collect()
    assert len(found) == 2301
    for r in found:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    assert len(target) == 3
    for size, wanted in target.items():
        assert wanted - (3000 if size == 3000 else 9) <= taken[size] <= wanted
    counts = mixed_documents(docs).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"\w+")))).collect()
    assert sorted(r[1] for r in counts) == sorted(taken.values())


def test_null_ids_draw_by_their_texts(spark):
    docs = documents(spark, [(None, f"word{i} " * 5) for i in range(400)], sources=["a"] * 400)
    docs = docs.unionAll(documents(spark, [(1, "w " * 900)], sources=["b"]))
    copies = {r["copies"] for r in mix_sources(docs).collect() if r["doc_id"] is None}
    assert len(copies) == 2


def test_equal_rows_beside_sql(spark, tmp_path):
    rows = [(i % 40, "a b c " * (i % 5), None, "xy"[i % 2], 0) for i in range(600)] + [(None, "q r s", None, None, 0)] * 90
    table = spark.createDataFrame(rows, DOCUMENT)
    table.write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents/*.parquet')")
    found = mix_sources(table).withColumn("doc_id", F.col("doc_id").cast("string"))
    assert difference(found.toPandas(), con.sql(f"select * replace (doc_id::varchar as doc_id) from ({MIXING_SQL})").df()) is None


def test_odd_rows(spark):
    docs = documents(spark, [None, "", "x y", (2, "x y"), (None, "z"), "w " * 100_000], sources=["s", None, "s", "s", None, "t"])
    docs = docs.withColumns({"size": F.lit("a"), "target": F.lit(1), "range": F.lit(0), "from": F.lit(2)})
    rows = mix_sources(docs).collect()
    assert len(rows) == 6
    assert sum(r["size"] for r in rows) == 100_005
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mix_sources(docs.limit(0)).count() == 0
    wordless = mix_sources(documents(spark, ["", None], sources=["a", "b"])).collect()
    assert [(r["target"], r["taken"]) for r in wordless] == [(0.0, 0)] * 2


def test_native_plan(spark):
    plan = mix_sources(documents(spark, ["a b"], sources=["s"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
