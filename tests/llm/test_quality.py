"""Quality rules: the exact bound, the counts, and the guarantee."""

import random
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm.quality import (
    RULES, binomial_tail, features, log_factorial, path_of, quality_rules, risk_controlled_cutoffs,
)
from tests.llm.helpers import by_id, documents


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_log_factorial(spark):
    import math

    values = [0, 1, 2, 5, 15, 16, 17, 40, 1000, 10**7]
    rows = spark.createDataFrame([(v,) for v in values], "x long").select("x", log_factorial(F.col("x")).alias("y"))
    for r in rows.collect():
        assert r["y"] == pytest.approx(math.lgamma(r["x"] + 1), rel=1e-12, abs=1e-12)


def test_binomial_tail(spark):
    cases = [(n, k) for n in (1, 5, 30, 400, 3000) for k in (0, 1, 2, 7, 20, 60) if k <= n]
    p = 0.03
    rows = spark.createDataFrame(cases, "n long, k long").withColumn("tail", binomial_tail(F.col("n"), F.col("k"), p))
    for r in rows.collect():
        n, k = r["n"], r["k"]
        exact = sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)) if k < n * p else 1.0
        assert r["tail"] == pytest.approx(exact, rel=1e-9)


def brute_counts(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = [i for i, w in enumerate(windows) if windows.count(w) > 1]
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len({i + k for i in twice for k in range(5)}),
    )


TEXTS = [
    "", " \n\t", "one two three", "a b c d e a b c d e", "a a a a a a a a a a a a", "x\x0by\x0cz\x1cq\x85w   v",
    "l1 w\nl1 w\n\n \nl2\nl1 w", "é 🙂 日本 # $ % <a> | & *", "a b c d e f a b c d e g h i j k l m n o p q r s t u",
    "p q r s t u v p q r s t u v x y z p q r s t", "word " * 3000,
]


def test_counts_equal_brute_force(spark):
    found = by_id(features(documents(spark, TEXTS), "doc_id", "text", F.col("lang")))
    for i, text in enumerate(TEXTS):
        row = found[i]
        counts = tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert counts == brute_counts(text), text[:40]


GOOD = "these are plain words that nobody would call bad at all in any way number {}"


def test_cutoffs_need_enough_labels(spark):
    bad = " ".join(["##$$%% ab"] * 3 + [f"w{i}#" for i in range(20)])
    texts = [GOOD.format(i) for i in range(400)] + [bad]
    docs = documents(spark, texts, langs=["en"] * 401)
    few = by_id(quality_rules(docs, labels(spark, [(i, 1, 0) for i in range(50)])))
    assert few[400]["kept"] and few[0]["kept"]
    many = by_id(quality_rules(docs, labels(spark, [(i, 1, 0) for i in range(400)])))
    assert not many[400]["kept"] and many[400]["rejected_by"] == "symbol_share"
    assert sum(not r["kept"] for r in many.values()) == 1


def test_false_rejections_stay_under_the_bound(spark):
    # A tenth of the good documents have many symbols: no cutoff may pass that rejects them.
    texts = [(GOOD if i % 10 else "#a $b %c &d |e <f >g *h #i $j %k {}").format(i) for i in range(1000)]
    docs = documents(spark, texts, langs=["en"] * 1000)
    found = quality_rules(docs, labels(spark, [(i, 1, 0) for i in range(1000)])).collect()
    assert all(r["kept"] for r in found)


def test_rules_together_stay_under_the_bound(spark):
    """Four rules, each true for 1.9 % of the good documents, no two for one: their verdict must not add up to 7.6 %."""
    rng = random.Random(4)
    rows = []
    for i in range(20_000):
        odd = rng.choices(range(5), [0.019] * 4 + [0.924])[0]
        rows.append((i, "en", *(1.0 if odd == r else 0.0 for r in range(4)), 5.0))
    good = spark.createDataFrame(rows, "doc_id long, stratum string, " + ", ".join(f"{r} double" for r in RULES))
    found = risk_controlled_cutoffs(good, 0.025, 0.1).first().asDict()
    alone = risk_controlled_cutoffs(good.withColumns({r: F.lit(0.0) for r in list(RULES)[1:4]}), 0.025, 0.1).first()
    rejected = [any(found[f"cutoff_{r}"] is not None and x > found[f"cutoff_{r}"] for r, x in zip(RULES, row[2:])) for row in rows]
    assert found["n"] == 20_000 and sum(rejected) / 20_000 <= 0.025
    assert alone["cutoff_symbol_share"] == RULES["symbol_share"][-1]


def test_the_guarantee_holds_over_many_draws(spark):
    """Over many holdouts and strata the true share of rejected good documents exceeds alpha no oftener than delta."""
    rng = np.random.default_rng(12)
    seeds, strata, n, alpha, delta = 60, 3, 400, 0.05, 0.2
    # True shares rejected at each step of a path of one rule; the last ones are above alpha.
    levels = (9.0, 8.0, 7.0, 6.0, 5.0)
    shares = np.array([0.005, 0.02, 0.045, 0.07, 0.12])
    values = np.array([9.5, 8.5, 7.5, 6.5, 5.5, 0.0])
    bad = 0
    rows = []
    for seed in range(seeds):
        for stratum in range(strata):
            drawn = rng.choice(values, n, p=np.diff([0, *shares, 1]))
            rows += [(seed * n * strata + stratum * n + i, seed, str(stratum), float(v)) for i, v in enumerate(drawn)]
    good = spark.createDataFrame(rows, "doc_id long, seed int, stratum string, x double").repartition(8).cache()
    for seed in range(seeds):
        found = risk_controlled_cutoffs(good.filter(f"seed = {seed}"), alpha, delta, {"x": levels}).collect()
        bad += any(r["steps"] and shares[r["steps"] - 1] > alpha for r in found)
    good.unpersist()
    assert bad / seeds <= delta + 0.1


def test_repeated_rows_are_one_trial(spark):
    rows = [(i % 100, "en", 0.9 if i % 100 == 0 else 0.0, 0.0, 0.0, 0.0, 0.0) for i in range(5000)]
    good = spark.createDataFrame(rows, "doc_id long, stratum string, " + ", ".join(f"{r} double" for r in RULES))
    assert risk_controlled_cutoffs(good, 0.025, 0.1).first()["n"] == 100


def test_steps_go_round_the_rules():
    assert path_of({"a": (3.0, 2.0, 1.0), "b": (9.0,)}) == [("a", 3.0), ("b", 9.0), ("a", 2.0), ("a", 1.0)]


def test_odd_rows(spark):
    docs = documents(spark, [None, "", "x", (2, "x"), (None, GOOD), "long " * 100_000])
    docs = docs.withColumns({"stratum": F.lit(1), "n": F.lit(2), "kept": F.lit("q"), "cutoff_symbol_share": F.lit(0.0)})
    odd = labels(spark, [(2, 1, 0), (2, 0, 0), (2, None, 0), (None, 1, 0), (99, 1, 0)])
    found = quality_rules(docs, odd).collect()
    assert len(found) == 6
    assert {r["doc_id"]: r["kept"] for r in found} == {0: False, 1: False, 2: False, None: True, 5: False}
    assert quality_rules(docs, odd.limit(0)).count() == 6
    assert quality_rules(docs.limit(0), odd).count() == 0


def test_native_plan(spark):
    docs = documents(spark, [GOOD] * 3)
    plan = quality_rules(docs, labels(spark, [(0, 1, 0)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert len(RULES) == 5
