"""Repaired conversations against every possible sequence of edits."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm.queries import op12_conversation_repair
from tabwright.llm.repair import START, Course, damaged, edits_of, last_edits, repair_conversations, repair_summary, step

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile("(s?(ua)+)?")


def faults(rows):
    """Fault of each (turn, role, text)."""
    out, seen = [], set()
    for _, role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else None
        out.append(fault or (None if stripped[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    return out


def every_way(rows):
    """The cheapest edits by trying all with at most two inserts at any place."""
    options = []
    for (_, role, text), fault in zip(rows, faults(rows), strict=True):
        ways = [("D", 4, [])]
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            ways += [("K", more, [(role, text)])] + [("R", 3 + more, [(r, text)]) for r in ("user", "assistant")]
        options.append(ways)
    gaps = [list(x) for n in range(3) for x in itertools.product(("user", "assistant"), repeat=n)]
    slots = []
    for ways in options:
        slots += [[("I" * len(g), 3 * len(g), [(r, "") for r in g]) for g in gaps], ways]
    slots.append([("I" * len(g), 3 * len(g), [(r, "") for r in g]) for g in gaps])
    best = None
    for chosen in itertools.product(*slots):
        turns = [t for c in chosen for t in c[2]]
        if GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in turns)):
            way = (sum(c[1] for c in chosen), "".join(c[0] for c in chosen), turns)
            best = min(best, way, key=lambda w: w[:2]) if best else way
    return best


def digest(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def summary(rows):
    """What the operator must give for (turn, role, text) rows in order."""
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, repaired = every_way(rows)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": found.count("blank"), "duplicate": found.count("duplicate"), "truncated": found.count("truncated"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        "cost": cost, "audit": audit, "repaired_sha256": digest(repaired),
    }


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


@pytest.fixture(scope="module")
def conversations():
    rng = np.random.default_rng(2)
    roles = ["user", "assistant", "system", "tool", "u", ""]
    texts = ["Yes.", "no", "", " \n", "Why?", "so"]
    out = {}
    for conv in range(150):
        n = int(rng.integers(1, 4))
        out[conv] = [
            (None if rng.random() < 0.1 else int(rng.integers(-2, 5)), roles[rng.integers(0, 6)], texts[rng.integers(0, 6)])
            for _ in range(n)
        ]
    return out


@pytest.mark.parametrize("giant_chars", [10**9, 150, 0])
def test_equals_every_way(spark, conversations, giant_chars):
    rows = [(c, *r) for c, rows in conversations.items() for r in rows]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = repair_summary(repair_conversations(table, giant_chars=giant_chars), clustered=True).collect()
    got = {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in found}
    assert got == {c: summary(in_order(rows)) for c, rows in conversations.items()}


def plain(rows):
    """Least cost and audit by a programme over whole strings."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    other = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserts(best):
        for _ in range(2):
            for state, (cost, audit) in list(best.items()):
                to, way = other[state], (cost + 3, audit + "I")
                if to not in best or way < best[to]:
                    best[to] = way
        return best

    best = {"": (0, "")}
    for (_, role, _), fault in zip(rows, faults(rows), strict=True):
        # Ways with and without an insert before the row stay apart until its edit is made.
        ways = [(s, c, a) for s, (c, a) in best.items()] + [(other[s], c + 3, a + "I") for s, (c, a) in best.items()]
        new = {}
        for state, cost, audit in ways:
            some = [(state, cost + 4, audit + "D")]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                some.append((other[state], cost + 3 + more, audit + "R"))
                if role[:1] in after[state]:
                    some.append((role[:1], cost + more, audit + "K"))
            for to, c, a in some:
                if to not in new or (c, a) < new[to]:
                    new[to] = (c, a)
        best = new
    ends = {"": "", "s": "II", "u": "I", "a": ""}
    return min((c + 3 * len(ends[s]), a + ends[s]) for s, (c, a) in best.items())


def test_long_conversations(spark):
    rng = np.random.default_rng(4)
    rows = []
    for conv in range(6):
        roles = [["user", "assistant", "system", "tool"][i] for i in rng.choice(4, 700, p=[0.4, 0.35, 0.05, 0.2])]
        rows += [(conv, t, r, f"{rng.integers(0, 500)}{rng.choice(['.', '', '?'])}") for t, r in enumerate(roles)]
    rows += [(6, t, "tool", f"{t}.") for t in range(1500)]
    table = spark.createDataFrame(rows, SCHEMA)
    wanted = {}
    for conv in range(7):
        own = [r[1:] for r in rows if r[0] == conv]
        wanted[conv] = plain(own)
    for giant_chars in (10**9, 0):
        found = repair_summary(repair_conversations(table, giant_chars=giant_chars), clustered=True)
        assert {r["conv_id"]: (r["cost"], r["audit"]) for r in found.collect()} == wanted


def test_edits_make_the_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "who"), (1, 1, "user", "who"), (1, 2, "tool", "Me."), (1, 3, "user", " ")]
    edits = repair_conversations(spark.createDataFrame(rows, SCHEMA))
    found = [(r["edit"], r["turn"], r["old_role"], r["role"], r["text"], r["fault"]) for r in edits.orderBy("place").collect()]
    assert found == [
        ("I", None, None, "user", "", None), ("K", 0, "assistant", "assistant", "Hello.", None),
        ("K", 1, "user", "user", "who", "truncated"), ("D", 1, "user", None, "who", "duplicate"),
        ("R", 2, "tool", "assistant", "Me.", None), ("D", 3, "user", None, " ", "blank"),
    ]
    again = repair_summary(edits.repartition(5)).first()
    assert again["audit"] == "IKKDRD" and again["cost"] == 3 + 3 + 4 + 3 + 4


def test_backpointers_fit_and_lead_back():
    course, backs = Course(), []
    kinds = [("tool", None), ("assistant", "truncated"), ("system", None), ("user", "blank"), ("user", None)] * 40
    for role, fault in kinds:
        backs.append(course.take(role, fault))
    assert max(backs) < 2**20
    state, edits = course.end(), last_edits((False, 1), len(kinds), course.end())
    for at in range(len(kinds) - 1, -1, -1):
        some, state = edits_of((False, 1), at, (False, at, kinds[at][0], "x", kinds[at][1]), backs[at], state)
        edits += some
    assert state == 0
    assert GRAMMAR.fullmatch("".join(e[7][:1] for e in reversed(edits) if e[3] != "D"))
    assert step(*START, "s", None)[0] == 0


def test_damage(spark):
    rows = [(c, t, "assistant", f"A. b! {c}?") for c in range(30) for t in range(10)] + [(None, None, None, None)]
    found = {}
    for r in damaged(spark.createDataFrame(rows, SCHEMA)).collect():
        found.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"]))
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(name.encode()) % 20
        role, text = role or " ", text or " "
        wanted = {0: None, 1: [(role, "")], 2: [(role, re.sub("[.!?]", "", text))], 3: [(role, text)] * 2, 4: [("user", text)]}
        assert found.get((conv, turn)) == wanted.get(draw, [(role, text)])


def test_query_returns_every_conversation(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = {r["conv_id"]: r for r in op12_conversation_repair(spark, sf_dir).collect()}
    assert set(found) == {r[0] for r in table.select("conv_id").distinct().collect()}
    kept = {}
    for r in damaged(table).collect():
        kept.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    for conv, row in found.items():
        rows = in_order(kept.get(conv, []))
        cost, audit = plain(rows)
        assert (row["cost"], row["audit"]) == (cost, audit)
        assert row["duplicate"] == faults(rows).count("duplicate")
        if len(rows) <= 3:
            assert {k: v for k, v in row.asDict().items() if k != "conv_id"} == summary(rows)


def test_odd_rows(spark, tmp_path):
    long = "word " * 200_000
    rows = [
        (None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", long), (1, 2**62, "assistant", "Ok."),
        (2, 0, "user", "Hi."), (2, 0, "user", "Hi."), (2, 0, "user", "Hi."), (2, 0, "assistant", "Hi."), (3, 5, "", ""),
    ]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({"conv": F.lit(3), "edit": F.lit("x"), "seen": F.lit(None)})
    for giant_chars in (10**9, 0):
        found = {r["conv_id"]: r for r in repair_summary(repair_conversations(odd, giant_chars=giant_chars)).collect()}
        assert (found[None]["audit"], found[None]["blank"]) == ("DKI", 1)
        assert (found[1]["audit"], found[1]["truncated"], found[1]["cost"]) == ("KK", 1, 3)
        # Turn 0 goes by role: the assistant first.
        assert (found[2]["audit"], found[2]["duplicate"], found[2]["gaps"]) == ("IKKDDI", 2, 0)
        assert (found[3]["audit"], found[3]["blank"], found[3]["repaired_sha256"]) == ("D", 1, hashlib.sha256().hexdigest())
    assert repair_summary(repair_conversations(odd.limit(0))).count() == 0
    spark.createDataFrame([(7, 0, "user", "Hi.")] * 0, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert op12_conversation_repair(spark, str(tmp_path)).count() == 0
