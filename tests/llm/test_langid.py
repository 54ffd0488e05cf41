"""Language identification: held-out accuracy, codes, and odd texts."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import langid
from tabwright.llm.langid import codewords, fit, identify_languages, language_of, learn, FEATURES
from tests.llm.helpers import documents


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == 1000 and 150 < len(held) < 250
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_source_and_id_are_no_inputs(spark):
    texts = ["the cat and the dog are here"] * 40 + ["der hund und die katze sind hier"] * 40
    docs = documents(spark, texts + [(5000, texts[0]), (5001, texts[0])], langs=["en"] * 40 + ["de"] * 40 + [None, "xx"])
    # doc 5001's label may be learned (its id decides); its text reads English all the same.
    found = {r["doc_id"]: r for r in identify_languages(docs).collect()}
    assert found[5000]["lang_pred"] == found[0]["lang_pred"] == "en" and found[45]["lang_pred"] == "de"


@pytest.mark.parametrize("classes", [1, 2, 3, 4, 6, 7, 20, 120])
def test_codewords(classes):
    code = codewords(classes)
    assert code.shape[0] == classes and set(np.unique(code)) <= {-1.0, 1.0}
    apart = (code[:, None, :] != code[None, :, :]).sum(axis=2) + np.eye(classes) * 999
    assert classes == 1 or apart.min() >= (1 if classes == 2 else 2)
    if classes > 1:
        # Every bit tells some classes from others.
        assert (np.abs(code.sum(axis=0)) < classes).all()


def test_every_language_is_a_class(spark):
    """More languages than 200, each of words of its own."""
    rng = np.random.default_rng(3)
    words = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(4)] for _ in range(260)]
    texts = [" ".join(rng.permutation(w * 3)) for w in words for _ in range(4)]
    langs = [f"l{i:03d}" for i in range(260) for _ in range(4)]
    docs = documents(spark, texts, langs=langs)
    model = learn(docs)
    assert model.languages == sorted(set(langs))
    found = docs.select("lang", language_of(model)(F.col("text")).alias("found")).select("lang", "found.*").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.97


def test_wrong_bit_is_corrected():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, FEATURES)).astype(np.float32)
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    labels = np.repeat(np.arange(6), 20)
    model = fit(centres[labels], labels, list("abcdef"), 0.02)
    assert (model.predict(centres)[0] == np.arange(6)).all()
    model.weights[:, 3] *= -1
    assert (model.predict(centres)[0] == np.arange(6)).all()
    # Half way between two languages is ambiguous, a plain text is not.
    assert not model.predict(centres)[2].any()
    assert model.predict(((centres[0] + centres[1]) / 2)[None])[1][0] < 0.9


def plain_vector(text):
    """Hashed n-gram frequencies, character by character."""
    whole = 2**64
    chars = [" "] + [c if c.isalpha() or ord(c) > 0xFFFF else " " for c in text.lower()] + [" "]
    chars = chars[:1] + [c for before, c in zip(chars, chars[1:]) if c != " " or before != " "]
    counts = [0] * FEATURES
    one = [ord(c) * 0x9E3779B97F4A7C15 % whole for c in chars]
    two = [((a >> 7) * 0xD6E8FEB86659FD93 + b) % whole for a, b in zip(one, one[1:])]
    three = [((a >> 9) * 0x9FB21C651E98DF25 + b) % whole for a, b in zip(two, one[2:])]
    for gram in [h for h, c in zip(one, chars) if c != " "] + two + three:
        counts[gram >> 52] += 1
    total = sum(counts)
    return {i: math.sqrt(n / total) for i, n in enumerate(counts) if n}


def plain_prediction(model, text):
    """The class whose codeword loses least, and its share of the evidence, bit by bit."""
    vector = plain_vector(text)
    losses = []
    for word in model.code:
        loss = 0.0
        for bit, sign in enumerate(word):
            margin = model.bias[bit] + sum(x * model.weights[i, bit] for i, x in vector.items())
            loss += model.reliability[bit] * math.log1p(math.exp(-sign * margin))
        losses.append(loss)
    least = min(losses)
    return model.languages[losses.index(least)], 1 / sum(math.exp(least - x) for x in losses)


def test_predictions_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.filter("crc32(cast(doc_id as string)) % 5 != 0"))
    found = {r["doc_id"]: r for r in identify_languages(docs).collect()}
    checked = 0
    for r in docs.collect():
        row = found[r["doc_id"]]
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (row["lang_pred"], row["score"]) == ("und", 0)
        elif len(r["text"]) < 20_000:
            lang, score = plain_prediction(model, r["text"])
            assert row["lang_pred"] == lang and row["score"] == pytest.approx(score, abs=1e-3)
            checked += 1
    assert checked > 150


def plain_fit(vectors, labels, code, steps, rate, penalty):
    """Gradient steps of one classifier per bit, example by example."""
    sizes = np.bincount(labels)
    weights, bias = np.zeros((vectors.shape[1], code.shape[1])), np.zeros(code.shape[1])
    for step in range(steps):
        for bit in range(code.shape[1]):
            slope, shift = np.zeros(vectors.shape[1]), 0.0
            for v, y in zip(vectors, labels):
                sign = code[y, bit]
                pull = sign / (1 + math.exp(sign * (v @ weights[:, bit] + bias[bit]))) / sizes[y] / len(sizes)
                slope, shift = slope + pull * v, shift + pull
            now = rate / (1 + step / steps)
            weights[:, bit], bias[bit] = weights[:, bit] + now * (slope - penalty * weights[:, bit]), bias[bit] + now * 0.1 * shift
    return weights, bias


def test_fit_equals_plain_steps(monkeypatch):
    monkeypatch.setattr(langid, "FEATURES", 12)
    monkeypatch.setattr(langid, "STEPS", 20)
    rng = np.random.default_rng(2)
    labels = np.array([0, 0, 0, 1, 1, 2, 2, 2, 2])
    vectors = rng.random((9, 12)).astype(np.float32)
    model = fit(vectors, labels, ["a", "b", "c"], 0.02)
    weights, bias = plain_fit(vectors.astype(float), labels, codewords(3), 20, langid.RATE, langid.PENALTY)
    assert np.allclose(model.weights, weights, atol=1e-3) and np.allclose(model.bias, bias, atol=1e-3)
    right = [[(v @ weights[:, b] + bias[b]) * model.code[y, b] > 0 for b in range(len(bias))] for v, y in zip(vectors, labels)]
    each = 1 / np.bincount(labels)[labels] / 3
    assert np.allclose(model.reliability, 2 * np.maximum((each[:, None] * np.array(right)).sum(axis=0) - 0.5, 0.01))


def test_odd_rows(spark):
    texts = [None, "", "12 34 !", "² ½ ٣", "the end of the day", "la fin du jour", "x", (6, "x"), (None, "the"), "the cat " * 40_000]
    langs = [None, "en", "en", "fr", "en", "fr", "en", None, "fr", "en"]
    docs = documents(spark, texts, langs=langs).withColumns({"found": F.lit(1), "score": F.lit("s"), "draw": F.lit(None)})
    found = identify_languages(docs).collect()
    assert len(found) == 10
    assert [r["lang_pred"] for r in found[:4]] == ["und"] * 4
    assert all(r["lang_pred"] in ("en", "fr") for r in found[4:])
    assert identify_languages(docs.limit(0)).count() == 0
    nothing = identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
