"""Layouts by fingerprint, a reversible template, and digests read back from formatted text."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabwright.llm.chat import (
    LAYOUTS, Layout, Listed, Part, Template, canonical_turns, converted, field_paths, fingerprint, format_turns,
    formatted_digests, layout_table, unescape,
)
from tabwright.llm.queries import CHAT_SQL, PLANTED, chat_records, op13_chat_formatting
from tests.compare import difference

TABLE = layout_table()
SCHEMA = "conv_id long, turn long, role string, text string"
# Strings that are full of marks and of parts of them.
marked = st.text(st.sampled_from(list("\\<>/turn \n#x é😀")), max_size=30)


def test_paths():
    record = {"id": 1, "messages": [{"role": "u", "content": None}, {"role": "a", "tags": ["x"]}], "meta": {}, "no": []}
    assert field_paths(record) == {"id", "messages[].role", "messages[].content", "messages[].tags[]", "meta{}", "no[]"}
    assert field_paths({"a.b": 1, "a": {"b": 2}}) == {'"a.b"', "a.b"}
    assert fingerprint({"a", "b"}) == fingerprint({"b", "a"}) != fingerprint({"a.b"})


@pytest.mark.parametrize(
    "record, layout, turns",
    [
        ({"conv_id": 4, "turn": 2, "role": "tool", "text": "x"}, "turn", [("tool", "x")]),
        ({"messages": [{"content": "x", "role": "user"}, {"role": None, "content": 3}]}, "messages", [("user", "x"), ("", "3")]),
        ({"id": "q", "messages": []}, "messages", []),
        ({"id": 1, "conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": ""}]}, "conversations",
         [("user", "x"), ("assistant", "")]),
        ({"prompt": "x", "response": "y"}, "prompt", [("user", "x"), ("assistant", "y")]),
        ({"system": "s", "id": 1, "index": None}, "prompt", [("system", "s")]),
        ({"prompt": "x", "completion": "y"}, "completion", [("user", "x"), ("assistant", "y")]),
        ({"instruction": "x", "input": "z", "output": "y"}, "instruction", [("user", "x\n\nz"), ("assistant", "y")]),
        ({"instruction": "x", "input": "", "output": "y", "system": "s"}, "instruction",
         [("system", "s"), ("user", "x"), ("assistant", "y")]),
        ({"meta": {"id": 1}, "chat": {"turns": [{"author": {"role": "user"}, "body": "x"}]}}, "nested", [("user", "x")]),
        ({"messages": ["x", "y"]}, None, None),
        ({"messages": [{"role": "user", "content": "x", "weight": 1}]}, None, None),
        ({"id": 1}, None, None),
        ({"prompt": "x", "index": "first"}, None, None),
        ({"prompt": "\ud800"}, None, None),
        ([1, 2], None, None),
    ],
)
def test_layouts(record, layout, turns):
    _, name, found = converted(json.dumps(record), TABLE)
    assert (name, found and found[2]) == (layout, turns)


def test_layouts_of_ones_own(spark):
    own = Layout("qa", "n", "k", (Part("q.text", "user"), Part("a.text", role_path="a.by")))
    records = spark.createDataFrame([(json.dumps({"n": 5, "q": {"text": "x"}, "a": {"text": "y", "by": "bot"}}),)], "record string")
    rows = canonical_turns(records, layouts=[*LAYOUTS, own]).orderBy("ordinal").collect()
    assert [(r["conv_id"], r["role"], r["text"], r["layout"]) for r in rows] == [("5", "user", "x", "qa"), ("5", "bot", "y", "qa")]
    unknown = canonical_turns(records).first()
    assert unknown["layout"] is None and unknown["text"] == records.first()[0] and unknown["fingerprint"] == rows[0]["fingerprint"]
    with pytest.raises(ValueError, match="share"):
        layout_table([*LAYOUTS, Layout("again", "id", "index", (Listed("messages", "role", "content"),))])


TEMPLATES = [Template(), Template("### ", ":\n", "\n<|end|>", ("###", "<|"))]


@pytest.mark.parametrize("template", TEMPLATES)
@given(turns=st.lists(st.tuples(marked, marked), max_size=5))
@settings(max_examples=300, deadline=None)
def test_template_is_reversible(template, turns):
    pieces = [template.opening + template.escape(r) + template.head_end + template.escape(t) + template.closing for r, t in turns]
    assert template.read("".join(pieces)) == turns
    for role, text in turns:
        for control in template.controls():
            assert control not in template.escape(role) and control not in template.escape(text)
        assert unescape(template.escape(text)) == text


def test_templates_that_cannot_be_read_back():
    for bad in ({"reserved": ("<",)}, {"reserved": ("a\\b",)}, {"closing": "--x--"}):
        with pytest.raises(ValueError):
            Template(**bad)


@pytest.mark.parametrize("template", TEMPLATES)
def test_columns_escape_as_strings(spark, template):
    texts = ["", "\\", "<turn", "</turn>\n", "####", "<\\turn", "a>\nb", ">\n>\n", PLANTED, "<<turn <|x|>", "é😀<|"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [tuple(r) for r in rows.select("t", template.escaped(F.col("t"))).collect()] == [(t, template.escape(t)) for t in texts]


def plain(turns):
    """Digests of (role, text) turns."""
    learnt = "".join(t for r, t in turns if r == "assistant")
    template = Template()
    pieces = [f"<turn {template.escape(r)}>\n{template.escape(t)}</turn>\n" for r, t in turns]
    return (
        len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(learnt),
        hashlib.sha256(learnt.encode()).hexdigest(), len("".join(pieces)),
    )


def digests(found):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) for r in found.collect()}


def test_query(spark, sf_dir, tables):
    found = op13_chat_formatting(spark, sf_dir)
    got = digests(found)
    wanted = {}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        wanted.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    wanted[-7] = [("user", PLANTED), ("assistant", PLANTED)]
    assert got == {c: plain(turns) for c, turns in wanted.items()}
    assert difference(found.toPandas(), tables.sql(CHAT_SQL).df()) is None


def test_query_meets_every_layout(spark, sf_dir):
    found = canonical_turns(chat_records(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    counts = {r["layout"]: r["count"] for r in found.groupBy("layout").count().collect()}
    assert set(counts) == {"turn", "messages", "conversations", "prompt"}
    assert all(n > 3 for n in counts.values())


def test_loss_mask_covers_assistant_texts_only(spark):
    rows = [(1, 0, "user", "a</turn>\n"), (1, 1, "assistant", "b</turn>\n\\"), (1, 2, "system", "assistant")]
    pieces = format_turns(canonical_turns(chat_records(spark.createDataFrame(rows, SCHEMA)))).filter("conv_id = '1'").orderBy("at").collect()
    masked = [p["piece"][p["loss_start"] : p["loss_start"] + p["loss_length"]] for p in pieces]
    assert [unescape(m) for m in masked] == ["", "b</turn>\n\\", ""]
    other = format_turns(canonical_turns(chat_records(spark.createDataFrame(rows, SCHEMA))), loss_roles=["user", "system"])
    assert other.filter("conv_id = '1' and loss_length > 0").count() == 2


def test_odd_rows(spark):
    long = "wörd </turn>" * 200_000
    rows = [
        (None, None, None, None), (None, 3, "assistant", ""), (1, None, "assistant", long), (1, -(2**62), "user", "\x00\r\n"),
        (2, 0, "user", "x"), (2, 0, "user", "x"), (2, 0, "", "<turn user>\n"), (2**62, 1, "a>\nb", "é"),
    ]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({"record": F.lit(1), "layout": F.lit("x"), "piece": F.lit(None)})
    got = digests(formatted_digests(format_turns(canonical_turns(chat_records(odd)))))
    assert got[None] == plain([("", ""), ("assistant", "")])
    assert got["1"] == plain([("assistant", long), ("user", "\x00\r\n")])
    # Rows of one turn go by their formatted text.
    assert got["2"] == plain([("", "<turn user>\n"), ("user", "x"), ("user", "x")])
    assert got[str(2**62)] == plain([("a>\nb", "é")])
    assert set(digests(formatted_digests(format_turns(canonical_turns(chat_records(odd.limit(0))))))) == {"-7"}
    nothing = spark.createDataFrame([(None,), ("",), ("{",), ("null",), ("{}",)], "record string")
    found = canonical_turns(nothing).collect()
    assert len(found) == 5 and all(r["layout"] is None for r in found)
    assert formatted_digests(format_turns(canonical_turns(nothing))).count() == 0
