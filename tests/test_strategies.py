"""Text strategies on handmade records."""

import json

import pytest
from pyspark.sql import functions as F

from textloom.functions.strategies import STRATEGIES, register_strategy
from textloom.functions.text import EDGE_SPACE, capitalise, spaced_json, strip
from textloom.operators.normalize import apply_steps, detect_text_column, normalize
from textloom.sources.landed import read_jsonl

TURNS = "array<struct<role string, content string, tool_calls array<struct<function struct<name string, arguments string>>>>>"


def texts(spark, rows, schema, strategy):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(STRATEGIES[strategy](df.schema)).collect()]


def turn(role, content, calls=None):
    return {"role": role, "content": content, "tool_calls": calls}


def call(name, arguments):
    return {"function": {"name": name, "arguments": arguments}}


def test_messages_list(spark):
    rows = [
        ([turn("user", "hi"), turn("ASSISTANT two WORDS", "yo")],),
        ([turn(None, None, [call("f", '{"a":1}'), call("g", None)])],),
        ([turn("tool", "out", [call("f", "x")])],),
        ([turn("user", "")],), ([],), (None,),
    ]
    assert texts(spark, rows, f"messages {TURNS}", "messages_list") == [
        "User: hi\nAssistant two words: yo",
        'Unknown: [tool_calls: f({"a":1}), g()]',
        "Tool: out\n[tool_calls: f(x)]",
        "User: ", None, None,
    ]


def test_nameless_call_is_written_whole(spark):
    rows = [([turn("user", None, [call(None, "x")])],)]
    assert texts(spark, rows, f"messages {TURNS}", "messages_list") == ['User: [tool_calls: {"name": null, "arguments": "x"}]']


def test_union_content_from_json_lines(spark, tmp_path):
    records = [
        {"messages": [{"role": "user", "content": "[not a list]"}]},
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, "b", {"type": "image"}]}]},
        {"messages": [{"role": "user", "content": None}]},
    ]
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in records) + "\n\n   \n{bad\n3\n")
    df = read_jsonl(spark, str(path))
    found = sorted(r[0] for r in df.select(STRATEGIES["messages_list"](df.schema)).collect())
    assert found == ["User: ", "User: [not a list]", 'User: a b {"type": "image"}']


SCHEMA_CONCAT = "input array<struct<role string, content string>>, output string, system_prompt string, text string"


def test_messages_concat(spark):
    def said(*pairs):
        return [{"role": r, "content": c} for r, c in pairs]

    rows = [
        (said(("system", " s "), ("user", "q")), "a", "s", None),
        (said(("system", "other"), ("user", "q")), "a", "s", None),
        (said(("user", "q")), None, None, None),
        ([], "a", "", None),
        (None, None, None, "  plain "),
    ]
    assert texts(spark, rows, SCHEMA_CONCAT, "messages_concat") == [
        "System:  s \nUser: q\nAssistant: a",
        "System: s\nSystem: other\nUser: q\nAssistant: a",
        "User: q", "Assistant: a", "plain",
    ]


def test_rl_blend(spark):
    params = "responses_create_params struct<input array<struct<role string, content string>>>"
    truth = "ground_truth array<struct<name string, arguments string>>"
    said = {"input": [{"role": "user", "content": "q"}]}
    rows = [(said, [{"name": "f", "arguments": "{}"}]), (said, []), (said, None)]
    assert texts(spark, rows, f"{params}, {truth}", "rl_blend") == [
        'User: q\nGround truth: [{"name": "f", "arguments": "{}"}]', "User: q", "User: q"]
    rows = [(json.dumps(said), "42", None), ("{bad", "42", [turn("user", "m")]), (None, None, None)]
    assert texts(spark, rows, f"responses_create_params string, ground_truth string, messages {TURNS}", "rl_blend") == [
        "User: q\nGround truth: 42", "User: m", None]


def test_agentic(spark):
    tools = "tools array<struct<function struct<name string, description string>>>"
    rows = [
        ([{"function": {"name": "t", "description": "d"}}, {"function": {"name": "u", "description": None}}], [turn("user", "q")]),
        ([{"function": {"name": None, "description": "d"}}], None), ([], [turn("user", "q")]), (None, None),
    ]
    assert texts(spark, rows, f"{tools}, messages {TURNS}", "agentic") == [
        "Tool: t - d\nTool: u\n\nUser: q", "Tool: unknown - d", "User: q", None]


def test_math(spark):
    schema = f"problem string, lean_header string, formal_statement string, messages {TURNS}"
    rows = [
        (" p ", "h", "f", None), ("p", None, None, None), (None, None, "f", None), (None, "h", None, [turn("user", "m")]),
    ]
    title = "Formal Statement (Lean 4):"
    assert texts(spark, rows, schema, "math_proof") == [
        f"Problem: p\n\n{title}\n\nh\n\nf", "Problem: p", f"{title}\n\nf", "User: m"]
    assert texts(spark, rows, schema, "math_v2") == ["p", "p", None, "User: m"]


@pytest.mark.parametrize("schema, row, expected", [
    ("text string", (" x ",), "x"),
    (f"messages {TURNS}, text string", ([turn("user", "m")], "x"), "User: m"),
    (f"messages {TURNS}, text string", (None, "x"), "x"),
    (f"messages {TURNS}, problem string", (None, "p"), "p"),
    ("lean_header string, problem string", ("h", "p"), "Problem: p\n\nFormal Statement (Lean 4):\n\nh"),
    (SCHEMA_CONCAT, ([{"role": "user", "content": "q"}], "a", None, "x"), "User: q\nAssistant: a"),
    ("other string", ("x",), None),
])
def test_smart(spark, schema, row, expected):
    assert texts(spark, [row], schema, "smart") == [expected]


def test_own_strategy(spark):
    register_strategy("title", lambda schema: F.upper("title"))
    df = spark.createDataFrame([("a",)], "title string")
    assert normalize(df, "s", "title").first()["text"] == "A"


def test_text_helpers(spark):
    df = spark.createDataFrame([(EDGE_SPACE + "a b" + EDGE_SPACE, "ÉTÉ été", '{"a":"x,\\"y:","b":[1,2]}')], "t string, r string, j string")
    row = df.select(strip(F.col("t")), capitalise(F.col("r")), spaced_json(F.col("j"))).first()
    assert tuple(row) == ("a b", "Été été", json.dumps({"a": 'x,"y:', "b": [1, 2]}))


def test_normalize(spark):
    df = spark.createDataFrame(
        [("7", " hello ", None), ("", "hello", 1), (None, "hello", 2), ("8", "\x1c\t", 3), ("9", None, 4)], "id string, content string, n int")
    rows = sorted(tuple(r) for r in normalize(df, "src").collect())
    key = "2cf24dba5fb0a30e"
    assert rows == [("hello", key, "src", '{"n": 1}'), ("hello", key, "src", '{"n": 2}'), ("hello", "7", "src", '{"n": null}')]
    steps = [lambda d: d.where("n > 1"), lambda d: d.limit(1)]
    assert apply_steps(df, steps).count() == 1


def test_detect_text_column(spark):
    assert detect_text_column(spark.createDataFrame([("x", "y")], "article string, body string")) == "body"
    assert detect_text_column(spark.createDataFrame([(1, "n" * 21)], "a int, note string")) == "note"
    assert detect_text_column(spark.createDataFrame([(1, "n" * 20)], "a int, note string")) is None
    assert detect_text_column(spark.createDataFrame([("x", "y")], "text string, mine string"), "mine") == "mine"
