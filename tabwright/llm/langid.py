"""Language identification with error-correcting output codes.

Each language has a codeword of bits. A binary classifier on hashed character n-grams
predicts each bit; a text belongs to the language whose codeword has the least loss, with
each bit's loss weighted by how reliable that bit was on training texts. Two codewords at
nearly the same loss make the text ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.support import id_text, prepare, text_column, text_or_empty

FEATURES = 4096
# Bounds of the sample that the classifiers are fitted on: texts in all, and per language the
# most and, whatever the sum, the least. Every language is a class.
SAMPLE_TEXTS = 4000
SAMPLE_PER_LANGUAGE, LEAST_PER_LANGUAGE = 800, 5
# More classes than this get one draw of codewords, without comparing all pairs.
COMPARED_CLASSES = 1000
STEPS, RATE, PENALTY = 150, 30.0, 1e-5
UNKNOWN = "und"
SPACE = np.uint32(32)


def _letter_table() -> np.ndarray:
    """Which code points of the first plane are letters or marks on them."""
    return np.array([chr(c).isalpha() for c in range(0x10000)])


class Vectors:
    """Hashed n-gram frequencies (1 to 3 characters, words bounded by spaces) of whole texts."""

    def __init__(self) -> None:
        self.letters = _letter_table()

    def __call__(self, text: str) -> np.ndarray:
        codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le"), np.uint32)
        known = codes < 0x10000
        letter = np.where(known, self.letters[np.where(known, codes, 0)], True)
        codes = np.where(letter, codes, SPACE)
        # One space between words.
        codes = codes[np.concatenate([[True], letter[1:] | letter[:-1]])].astype(np.uint64)
        counts = np.zeros(FEATURES)
        with np.errstate(over="ignore"):
            one = codes * np.uint64(0x9E3779B97F4A7C15)
            two = (one[:-1] >> np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93) + one[1:] if len(codes) > 1 else one[:0]
            three = (two[:-1] >> np.uint64(9)) * np.uint64(0x9FB21C651E98DF25) + one[2:] if len(codes) > 2 else one[:0]
        for grams in (one[codes != SPACE], two, three):
            counts += np.bincount((grams >> np.uint64(52)).astype(np.int64), minlength=FEATURES)
        counts = np.sqrt(counts)
        return (counts / max(np.linalg.norm(counts), 1e-12)).astype(np.float32)


def codewords(classes: int) -> np.ndarray:
    """A row of +1 and -1 per class: all splits of few classes, else well-separated draws."""
    if classes == 1:
        return np.ones((1, 1))
    if classes <= 6:
        columns = [[1] + [1 if c >> k & 1 else -1 for k in range(classes - 1)] for c in range(2 ** (classes - 1) - 1)]
        return np.array(columns, float).T
    bits = int(np.ceil(10 * np.log2(classes)))
    rng, best, widest = np.random.default_rng(17), None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (classes, bits))
        if classes > COMPARED_CLASSES:
            if len(np.unique(code, axis=0)) == classes:
                return code
            continue
        apart = (bits - code @ code.T) / 2 + np.eye(classes) * bits
        mixed = np.abs(code.sum(axis=0)).max() < classes
        if mixed and apart.min() > widest:
            best, widest = code, apart.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    reliability: np.ndarray
    margin: float

    def predict(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, its share of the evidence (0 to 1), and whether another is nearly as near."""
        margins = vectors @ self.weights + self.bias
        # The loss of a bit depends on the class by its sign only.
        ups, downs = np.logaddexp(0, -margins) * self.reliability, np.logaddexp(0, margins) * self.reliability
        losses = ups @ (self.code > 0).T + downs @ (self.code < 0).T
        first = losses.argmin(axis=1)
        shares = np.exp(losses.min(axis=1, keepdims=True) - losses)
        score = 1 / shares.sum(axis=1)
        if len(self.languages) == 1:
            return first, score, np.zeros(len(vectors), bool)
        near = np.sort(losses, axis=1)
        return first, score, near[:, 1] - near[:, 0] < self.margin * self.reliability.sum()


def fit(vectors: np.ndarray, labels: np.ndarray, languages: list[str], margin: float) -> Model:
    """Logistic classifiers for all bits at once, by gradient steps on the whole sample."""
    code = codewords(len(languages))
    wanted = code[labels]
    # Every language weighs the same in each bit.
    sizes = np.bincount(labels, minlength=len(languages))
    each = (1 / sizes[labels] / len(languages))[:, None]
    weights, bias = np.zeros((FEATURES, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    for step in range(STEPS):
        pull = (each * wanted / (1 + np.exp(np.clip(wanted * (vectors @ weights + bias), -30, 30)))).astype(np.float32)
        rate = RATE / (1 + step / STEPS)
        weights += rate * (vectors.T @ pull - PENALTY * weights)
        bias += rate * 0.1 * pull.sum(axis=0)
    right = ((vectors @ weights + bias) * wanted > 0).astype(float)
    accuracy = (each * right).sum(axis=0)
    reliability = np.maximum(accuracy - 0.5, 0.01) * 2
    return Model(languages, code, weights, bias, reliability, margin)


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", margin: float = 0.02
) -> Model | None:
    """A model from a bounded sample of texts with a language and a letter, drawn by id.

    Every language is a class. At most ``SAMPLE_PER_LANGUAGE`` texts of each and
    ``SAMPLE_TEXTS`` in all, but ``LEAST_PER_LANGUAGE`` of each where there are; None without any.
    """
    spark = prepare(docs.sparkSession)
    labelled = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = labelled.groupBy("lang").count().collect()
    if not counts:
        return None
    languages = sorted(r["lang"] for r in counts)
    per_language = max(LEAST_PER_LANGUAGE, min(SAMPLE_PER_LANGUAGE, SAMPLE_TEXTS // len(languages)))
    # Twice the wanted share of each language and 20 by a draw from the id; of those, the first by draw.
    draw = F.pmod(F.xxhash64(id_text("id")), F.lit(1_000_000))
    shares = [(r["lang"], min(1.0, (2 * per_language + 20) / r["count"])) for r in counts]
    share = F.broadcast(spark.createDataFrame(shares, "lang string, share double"))
    order = Window.partitionBy("lang").orderBy("draw", "id", F.md5("text"))
    sample = (
        labelled.withColumn("draw", draw).join(share, "lang")
        .filter(F.col("draw") < F.col("share") * 1_000_000)
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= per_language)
    )

    def batch(texts: list[str]) -> list[dict]:
        vectors = Vectors()
        rows = []
        for text in texts:
            found = vectors(text)
            at = np.flatnonzero(found)
            rows.append({"at": at.astype(np.uint16).tobytes(), "value": found[at].tobytes()})
        return rows

    rows = sample.select("lang", text_column(batch, "at binary, value binary")(F.col("text")).alias("v")).collect()
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["v"]["at"]), bytes(r["v"]["value"])))
    dense = np.zeros((len(rows), FEATURES), np.float32)
    for i, row in enumerate(rows):
        dense[i, np.frombuffer(row["v"]["at"], np.uint16)] = np.frombuffer(row["v"]["value"], np.float32)
    place = {lang: i for i, lang in enumerate(languages)}
    return fit(dense, np.array([place[r["lang"]] for r in rows]), languages, margin)


def language_of(model: Model | None):
    """Column function: text to lang_pred, score and ambiguous."""
    kept: list[Vectors] = []

    def batch(texts: list[str]) -> list[dict]:
        if not kept:
            kept.append(Vectors())
        rows = [{"lang_pred": UNKNOWN, "score": 0.0, "ambiguous": False} for _ in texts]
        lettered = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
        if model is not None and lettered:
            first, score, ambiguous = model.predict(np.stack([kept[0](texts[i]) for i in lettered]))
            for i, f, s, a in zip(lettered, first, score, ambiguous, strict=True):
                rows[i] = {"lang_pred": model.languages[f], "score": float(s), "ambiguous": bool(a)}
        return rows

    return text_column(batch, "lang_pred string, score double, ambiguous boolean")


def held_out(id_col: str, folds: int = 5, fold: int = 0):
    return F.crc32(id_text(id_col).cast("binary")) % folds == fold


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 5,
    held_out_fold: int = 0,
    margin: float = 0.02,
) -> DataFrame:
    """The id, held_out, lang_pred, score and ambiguous of every row, from the whole text.

    Learned from rows whose crc32(id as text) mod ``folds`` is not ``held_out_fold``, with a
    language and a letter in the text. A text without letters (or null) is ``und`` with
    score 0, and so is every text where there is nothing to learn from. A null id counts as
    the empty text. Repeated rows repeat. Other columns are not read; an empty table gives
    no rows.
    """
    prepare(docs.sparkSession)
    model = learn(docs.filter(~held_out(id_col, folds, held_out_fold)), id_col, text_col, lang_col, margin)
    found = docs.select(
        F.col(id_col), held_out(id_col, folds, held_out_fold).alias("held_out"),
        language_of(model)(text_or_empty(text_col)).alias("found"),
    )
    return found.select(F.col(id_col), "held_out", "found.*")
