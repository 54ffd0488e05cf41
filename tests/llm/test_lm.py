"""The language model against counts in dictionaries."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import lm
from tabwright.llm.lm import BUCKETS, learn_weights, score_documents
from tests.llm.helpers import by_id, documents


def brute_force(rows):
    """Base score, score and known tokens per id, from whole dictionaries and exact rounds."""
    fold = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i, _ in rows}
    tokens = {i: (t or "").encode().lower().split() + [b"<end>"] for i, t in rows}

    def count(ids):
        single, pair, context = Counter(), Counter(), Counter()
        for i in ids:
            line = [b"<start>", *tokens[i]]
            single.update(tokens[i])
            pair.update(zip(line, line[1:]))
            context.update(line[:-1])
        return single, pair, context

    single, pair, context = count([i for i in tokens if fold[i] != 2])
    n, v = sum(single.values()), len(single)
    kept, kept_pair, kept_context = count([i for i in tokens if fold[i] not in (2, 3)])

    def parts(i, single, pair, context, n):
        line = [b"<start>", *tokens[i]]
        for a, b in zip(line, line[1:]):
            bucket = min(context[a].bit_length(), BUCKETS - 1)
            yield bucket, 1 / (v + 1), single[b] / max(n, 1), pair[a, b] / max(context[a], 1)

    held = [e for i in tokens if fold[i] == 3 for e in parts(i, kept, kept_pair, kept_context, sum(kept.values()))]
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0.5, 0.5, 0
    for _ in range(60):
        sums = np.ones((BUCKETS, 3))
        sums[0, 2] = 0
        for bucket, *p in held:
            share = weights[bucket] * p
            sums[bucket] += share / share.sum()
        weights = sums / sums.sum(axis=1, keepdims=True)
    out = {}
    for i in tokens:
        base = sum(math.log10((single[t] + 1) / (n + v + 1)) for t in tokens[i])
        score = sum(math.log10(weights[b] @ p) for b, *p in parts(i, single, pair, context, n))
        out[i] = (fold[i] == 2, len(tokens[i]), sum(single[t] > 0 for t in tokens[i]), n, base, score)
    return out


def test_scores_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])
    # Small blocks: several of each kind.
    found = by_id(score_documents(docs, block_bytes=50_000))
    assert len(found) == docs.count() == len(expected)
    for i, (held, n, known, trained, base, score) in expected.items():
        row = found[i]
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (held, n, known, trained)
        assert row["base_score"] == pytest.approx(base, rel=1e-12)
        assert row["score"] == pytest.approx(score, rel=2e-3)


def test_result_does_not_depend_on_blocks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    few, many = by_id(score_documents(docs)), by_id(score_documents(docs, block_bytes=20_000))
    assert all(few[i]["score"] == pytest.approx(many[i]["score"], rel=1e-9) for i in few)


@pytest.mark.parametrize("fan", [2, 3])
def test_hops_do_not_change_the_scores(spark, sf_dir, monkeypatch, fan):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80).coalesce(1)
    one = by_id(score_documents(docs))
    monkeypatch.setattr(lm, "MOST_FAN", fan)
    more = by_id(score_documents(docs, block_bytes=25_000))
    assert {i: r["n_known"] for i, r in one.items()} == {i: r["n_known"] for i, r in more.items()}
    assert all(one[i]["score"] == pytest.approx(more[i]["score"], rel=1e-9) for i in one)


def test_messages_grow_with_the_blocks(spark, sf_dir, monkeypatch):
    """At most ``fan`` messages per block, hop and level, however many blocks there are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    monkeypatch.setattr(lm, "MOST_FAN", 4)
    real, rows = lm._counts, {}

    def counted(asked, route):
        blocks = [r["sender"] for r in asked.select("sender").distinct().collect()]
        rows[len(blocks)] = (asked.count(), route.hops, route.fan)
        return real(asked, route)

    monkeypatch.setattr(lm, "_counts", counted)
    for size in (300_000, 90_000, 30_000):
        score_documents(docs, block_bytes=size)
    assert len(rows) == 3 and max(rows) > 4 * min(rows)
    for blocks, (sent, hops, fan) in rows.items():
        assert sent <= 2 * fan * blocks and fan <= 4 and fan**hops >= blocks > 4 ** (hops - 1)


def test_routes():
    for blocks in (1, 2, 3, 5, 104, 128, 129, 6000, 17_000):
        route = lm.Route(blocks)
        assert route.fan <= 128 and route.fan**route.hops >= blocks
        keys = np.sort(np.random.default_rng(blocks).integers(0, 2**64, 500, dtype=np.uint64))
        cuts = route.cuts(0, 0, keys)
        assert len(cuts) == route.fan + 1 and cuts == sorted(cuts)
        if route.hops > 1:
            # The parts of a part lie within it.
            own = keys[cuts[1] : cuts[2]]
            again = route.cuts(1, 1, own)
            assert again[0] == 0 and again[-1] == len(own)
    assert lm.Route(104).hops == 1 and lm.Route(6000).hops == 2


def test_model_beats_base_on_held_out(spark, sf_dir):
    held = [r for r in score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_sum_to_one(spark):
    docs = documents(spark, ["a b a", "b a", "a a", "c", "b b a", "a c", "c a b"] * 3)
    unseen = "zz"
    one_word = docs.unionAll(documents(spark, [(1000 + k, w) for k, w in enumerate(["a", "b", "c", unseen])]))
    # Ids 1000.. may train too; what counts is that all words after the start, and the end, sum to 1.
    found = by_id(score_documents(one_word))
    assert all(r["score"] < 0 for r in found.values())


def test_weights_prefer_what_predicts():
    events = np.array([[3, 5, 60, 1000], [3, 5, -(10**6), 10]])
    weights = learn_weights(events)
    assert weights[3, 2] > 0.9
    assert np.allclose(weights.sum(axis=1), 1)
    assert weights[0, 2] == 0


def test_odd_rows(spark):
    long = "word " * 60_000
    rows = [None, "", " \n", "Same Text", "same text", long, (3, "Same Text"), (None, "nobody")]
    docs = documents(spark, rows).withColumns({"block": F.lit("x"), "held_out": F.lit(1), "score": F.lit(None)})
    found = score_documents(docs).collect()
    assert len(found) == 8
    by_text = {r["doc_id"]: r for r in found}
    assert by_text[0]["n_tokens"] == by_text[1]["n_tokens"] == by_text[2]["n_tokens"] == 1
    assert by_text[5]["n_tokens"] == 60_001
    assert by_text[3]["base_score"] == pytest.approx(by_text[4]["base_score"])
    assert score_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("one", [None, 7])
def test_rows_of_one_id_fill_no_block(spark, monkeypatch, tmp_path, one):
    """Blocks stay near ``block_bytes`` in every pass, and the scores are those of one block."""
    docs = documents(spark, [(one, f"the word {i} and w{i % 7}") for i in range(600)] + [(i, "and the word") for i in range(30)])

    folder = str(tmp_path)
    ask = lm._ask
    monkeypatch.setattr(lm, "_ask", lambda *args: spied(ask(*args), folder))
    some = sorted((str(r["doc_id"]), r["n_known"], round(r["score"], 9)) for r in score_documents(docs, block_bytes=2000).collect())
    assert max(map(int, (tmp_path / "sizes").read_text().split())) < 6000
    monkeypatch.setattr(lm, "_ask", ask)
    assert some == sorted((str(r["doc_id"]), r["n_known"], round(r["score"], 9)) for r in score_documents(docs).collect())


def spied(ask, folder):
    """``ask`` that notes the bytes of each block."""

    def noted(group):
        with open(f"{folder}/sizes", "a") as out:
            out.write(f"{sum(len(t) for t in group.column('text').to_pylist())}\n")
        return ask(group)

    return noted
