"""Personal data: base forms against the plain expressions, and the field on lines it has not seen."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tabwright.llm.pii import (
    KINDS, Field, Tokens, all_spans, base_spans, field_spans, find_personal_data, luhn, neighbourhoods, redacted, train, training_lines,
)
from tests.llm.helpers import by_id, documents

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    spans = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = [
                True,
                all(int(p or 0) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                14 <= len(digits) <= 19 and luhn(digits),
                10 <= len(digits) <= 15,
            ][kind]
            if ok:
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


def test_base_equals_plain_expressions():
    rng = random.Random(4)
    pieces = ["a", "b.c", "@", "@x", ".", "..", "1", "12", "255", "256", "0007", "+", "+1", " ", "-", "(", ")", "x@y.z",
              "1.2.3.4", "4111 1111 1111 1111", "378282246310005", "+1 (555) 123-4567", "\n", "é", "٣", "%", "_"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25)))
        assert base_spans(text) == plain_spans(text), text


def test_luhn():
    assert luhn("4111111111111111") and luhn("378282246310005") and not luhn("4111111111111112")


def test_field_finds_unseen_lines():
    field = Field(train())
    found = wanted = right = 0
    for text, spans in training_lines(seed=12345, n=300):
        got = set(field_spans(text, field))
        found, wanted, right = found + len(got), wanted + len(spans), right + len(got & set(spans))
    assert right / found > 0.97 and right / wanted > 0.95


def test_field_adds_to_base():
    field = Field(train())
    text = "call (415) 555-0134 or write to jane.doe (at) example (dot) org, not 4111111111111112 or v1.2.3 in 2024"
    base, more = all_spans(text, field)
    assert base == []
    assert [text[a:b] for a, _, b in more] == ["(415) 555-0134", "jane.doe (at) example (dot) org"]
    assert redacted(text, more).startswith("call [PHONE] or write to [EMAIL], not 4111111111111112")


def test_neighbourhoods_give_what_the_whole_text_gives():
    field = Field(train())
    for mail in (
        "jane [At] example.com", "jane [ at ] example.org", "Jane At Example Dot Com", "jane.doe at example.com",
        "jane {\t at  } example ( DOT ) org", "jane\u00a0at\u00a0example dot com",
    ):
        text = "word " * 60 + mail + " word" * 60
        assert [(s + a, k, e + a) for a, b in neighbourhoods(text) for s, e, k in tokens_at(text, a, b)] == [
            (s, k, e) for s, e, k in tokens_at(text, 0, len(text))
        ] != []
    rng = random.Random(6)
    pieces = ["jane", "Doe", " at ", " At ", "[at]", "( aT )", "{ AT}", ".", " dot ", "(DOT)", "[ dot ]", " . ", "example", "com",
              "12", "4111 1111 1111 1111", "(415) 555-0134", "1.2.3.4", "@", " ", "\n", "call ", "card: ", "email",
              "mail" + " " * 50, "x" * 130, " words" * 22, "\u0663", "\u00b2", "_", "-", "at at "]
    found = 0
    for _ in range(3000):
        text = "".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 40)))
        spans = field.best(Tokens(text))
        assert field_spans(text, field) == spans, text
        found += len(spans)
    assert found > 1000


def tokens_at(text, a, b):
    """Every segment of a stretch of text: start, end and kind."""
    tokens = Tokens(text[a:b])
    return [(tokens.starts[i], tokens.ends[j - 1], kind) for i, j, kind in tokens.segments()]


def test_written_addresses_away_from_digits():
    field = Field(train())
    for mail in ("jane [At] example.com", "jane [ at ] example.org", "Jane At Example Dot Com"):
        text = "word " * 60 + mail + " word" * 60
        assert [text[a:b] for a, _, b in field_spans(text, field)] == [mail]


def test_programme_is_the_best_labelling():
    """Against all sets of non-overlapping segments."""
    field = Field(train())
    lines = ["ab 4111 1111 1111 1111 cd", "tel (415) 555-0134 x", "1.2.3.4 5", "a at b dot com 12345"]
    for line in lines:
        tokens = Tokens(line)
        segments = tokens.segments()[:18]
        tokens.segments = lambda s=segments: s
        scores = [field.score(r) for r in Field.described(tokens, segments)]
        best = 0.0
        for size in range(1, 4):
            for some in itertools.combinations(range(len(segments)), size):
                parts = sorted(segments[i][:2] for i in some)
                if all(a[1] <= b[0] for a, b in zip(parts, parts[1:])):
                    best = max(best, sum(scores[i] for i in some))
        spans = field.best(tokens)
        index = {(tokens.starts[i], k, tokens.ends[j - 1]): s for (i, j, k), s in zip(segments, scores)}
        assert sum(index[s] for s in spans) == pytest.approx(best)
        # Probabilities of segments that share a token sum to at most 1.
        p = field.expected(tokens.n, segments, scores)
        for t in range(tokens.n):
            assert sum(q for (i, j, _), q in zip(segments, p) if i <= t < j) <= 1 + 1e-9


def test_long_texts_are_quick():
    field = Field(train())
    for text in ("9" * 200_000, "a" * 200_000, "1 " * 20_000, "a@" * 20_000, "+1" + " " * 100_000, "1.2.3.4." * 5000):
        assert base_spans(text) == plain_spans(text) if len(text) < 50_000 else base_spans(text) is not None
        field_spans(text, field)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = by_id(find_personal_data(docs, with_text=True))
    rows = docs.collect()
    assert len(found) == len(rows)
    for r in rows:
        spans, row = plain_spans(r["text"]), found[r["doc_id"]]
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert row["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [row[f"n_{n}"] for n in KINDS] == [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        assert set(filter(None, text.split(","))) <= set(row["spans"].split(","))
        if not row["spans"]:
            assert row["redacted"] == r["text"]


def test_odd_rows(spark):
    docs = documents(spark, [None, "", "x@y.zz", (2, "x@y.zz"), (None, "x@y.zz"), "é x@y.zz"])
    docs = docs.withColumns({"found": F.lit(1), "spans": F.lit(2), "redacted": F.lit(None)})
    rows = find_personal_data(docs).collect()
    assert sorted(r["spans"] for r in rows) == ["", "", "email:0:6", "email:0:6", "email:0:6", "email:2:8"]
    assert find_personal_data(docs.limit(0)).count() == 0
