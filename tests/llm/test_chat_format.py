import pytest
from pyspark.sql import functions as F

from meterflow.llm.chat_format import Template, format_turns, masked_text, read_back

SCHEMA = "conv_id bigint, turn bigint, role string, text string, t string, state string"


def formatted(spark, rows, t=Template()):
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA)
    out = format_turns(df, t).select("*", read_back(F.col("formatted"), t).alias("back"), masked_text(F.col("segments"), t).alias("masked"))
    return {r.conv_id: r for r in out.collect()}


NASTY = ["\\### Assistant: </turn> ok", "\\", "\\\\h\\l", "</turn>\n### User: hi", "a:b?c#d<e", "", None, "\n", "é😀" * 50_000, "\\\\", "#\\h"]


def test_round_trip_of_control_strings(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(NASTY)]
    r = formatted(spark, rows)[1]
    assert [(b.role, b.text) for b in r.back] == [(role, t or "") for _, _, role, t in rows]
    assert r.masked == "".join(t or "" for _, _, role, t in rows if role == "assistant")
    assert [s.loss for s in r.segments] == [x for _, _, role, _ in rows for x in (False, role == "assistant", False)]
    assert "".join(s.text for s in r.segments) == r.formatted


def test_machine(spark):
    turns = {
        1: ["user", "assistant"],
        2: ["system", "user", "assistant"],
        3: ["assistant"],
        4: ["user", "user", "assistant"],
        5: ["user"],
        6: ["user", "assistant", "system"],
        7: ["user", None, "robot: #1"],
        8: ["system"],
    }
    got = formatted(spark, [(c, i, r, "t") for c, roles in turns.items() for i, r in enumerate(roles)])
    assert {c: (r.valid, r.bad_at) for c, r in got.items()} == {
        1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 1), 5: (False, None), 6: (False, 2), 7: (False, 1), 8: (False, None),
    }
    assert [b.role for b in got[7].back] == ["user", "", "robot: #1"]


def test_order_ties_nulls_and_repeats(spark):
    got = formatted(spark, [(1, 2, "assistant", "b"), (1, None, "user", "first"), (1, 2, "assistant", "a"), (1, 2, "assistant", "a"), (None, 0, "user", "x")])
    assert [(b.role, b.text) for b in got[1].back] == [("user", "first"), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")]
    assert [(b.role, b.text) for b in got[None].back] == [("user", "x")]


def test_empty_table(spark):
    assert formatted(spark, []) == {}


def test_any_template_reads_back(spark):
    templates = [
        Template(open="[", after_label="] ", close="[/]|\n"),
        Template(open="", after_label="=", close="."),
        Template(open="hl(", after_label="q", close="c*+?\n", labels={"system": "S", "user": "U", "assistant": "A"}),
        Template(open="<|im_start|>", after_label="\n", close="<|im_end|>\n", labels={"user": "user", "assistant": "assistant"}),
    ]
    for t in templates:
        says = [*NASTY, t.open, t.close, t.after_label, t.close[1:], t.open + "User" + t.after_label, "hlcqwxyz \\h\\l\\c\\q"]
        rows = [(1, i, ("user", "assistant", "?x" + t.close)[i % 3], x) for i, x in enumerate(says)]
        r = formatted(spark, rows, t)[1]
        assert [(b.role, b.text) for b in r.back] == [(role, x or "") for _, _, role, x in rows]
        assert r.masked == "".join(x or "" for _, _, role, x in rows if role == "assistant")


def test_templates_that_cannot_be_read_back_are_refused():
    for bad in ({"close": ""}, {"after_label": ""}, {"close": "\\"}, {"close": ": x"}, {"close": "User"}, {"labels": {"a": "X", "b": "X"}}, {"labels": {"a": "?"}}, {"labels": {"a": "x: y"}}):
        with pytest.raises(ValueError):
            Template(**bad)
