"""Tool-call linking on hand-made conversations."""

import json

import pytest

from corvane.llm import chat

SCHEMAS = [("weather", "city", "string", True), ("weather", "days", "integer", False), ("sum", "values", "array", True), ("sum", "scale", "number", False)]


def call(i, name, arguments, **more):
    return {"id": i, "name": name, "arguments": arguments} | more


def says(*calls):
    return json.dumps({"tool_calls": list(calls)})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


@pytest.fixture(scope="module")
def out(spark):
    turns = [
        (1, 0, "user", 'Hi "you"\n'), (1, 1, "assistant", says(call("a", "weather", {"days": 2, "city": "Bonn"}), call("b", "sum", {"values": [1, {"z": 1, "y": 2}], "scale": 1.5}, depends_on=["a"]))),
        (1, 2, "tool", result("b", 3)), (1, 3, "tool", result("a", {"t": 20, "k": None})), (1, 4, "tool", result("zz", 1)),
        (2, 0, "assistant", says(call("a", "weather", {}), call("a", "weather", {"city": "x"}), call("u", "nobody", {}), call("v", "sum", {"values": "x"}), call("w", "sum", {"values": [], "other": 1}))),
        (2, 1, "tool", result("v", 0)),
        (3, 0, "assistant", says(call("p", "weather", {"city": "x"}, depends_on=["q"]), call("q", "weather", {"city": "y"}, depends_on=["p"]), call("r", "weather", {"city": "z"}))),
        (4, 0, "user", "{not json"), (4, 1, None, None), (None, 0, "user", "x"), (4, 2, "user", '{"other": 1}'), (4, 2, "user", '{"other": 1}'), (4, 3, "assistant", "[1, 2]"),
    ]
    df = spark.createDataFrame([(*t, "k") for t in turns], "conv_id long, turn long, role string, text string, status string")
    return chat.format_turns(df, spark.createDataFrame(SCHEMAS, chat.SCHEMA_DDL)).collect()


def of(out, conv, kind):
    return {(r["turn"], r["call_id"]): r for r in out if r["conv_id"] == conv and r["kind"] == kind}


def test_links_and_order(out):
    calls, results = of(out, 1, "call"), of(out, 1, "result")
    assert {k[1]: (r["linked_turn"], r["status"], r["level"]) for k, r in calls.items()} == {"a": (3, "ok", 0), "b": (2, "ok", 2)}
    assert {k: (r["linked_turn"], r["status"], r["order_turn"], r["level"]) for k, r in results.items()} == {(2, "b"): (1, "linked", 1, 3), (3, "a"): (1, "linked", 1, 1), (4, "zz"): (None, "orphan", 4, 0)}
    mine = sorted((r for r in out if r["conv_id"] == 1), key=lambda r: (r["order_turn"], r["level"], r["turn"]))
    assert [(r["kind"], r["call_id"]) for r in mine] == [("message", None), ("call", "a"), ("result", "a"), ("call", "b"), ("result", "b"), ("result", "zz")]


def test_arguments(out):
    status = sorted((r["call_id"], r["status"]) for r in out if r["conv_id"] == 2 and r["kind"] == "call")
    assert status == [("a", "duplicate_id"), ("a", "missing_argument"), ("u", "unknown_tool"), ("v", "wrong_type"), ("w", "unknown_argument")]


def test_cycles(out):
    assert {k[1]: (r["status"], r["level"]) for k, r in of(out, 3, "call").items()} == {"p": ("cyclic", -1), "q": ("cyclic", -1), "r": ("unanswered", 0)}


def test_canonical_json(out):
    text = of(out, 1, "call")[1, "b"]["message_json"]
    assert json.loads(text) == {"role": "assistant", "tool_call": call("b", "sum", {"values": [1, {"z": 1, "y": 2}], "scale": 1.5}, depends_on=["a"])}
    assert text == '{"role":"assistant","tool_call":' + json.dumps(json.loads(text)["tool_call"], sort_keys=True, separators=(",", ":")) + "}"
    assert of(out, 1, "message")[0, None]["message_json"] == '{"content":"Hi \\"you\\"\\n","role":"user"}'


def test_messages(out):
    rows = [r for r in out if r["conv_id"] == 4]
    assert len(rows) == 5 and {r["status"] for r in rows} == {"message"}
    assert {r["message_json"] for r in rows if r["turn"] == 1} == {'{"content":"","role":""}'}


def test_without_tools(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_turns(none).count() == 0
    some = spark.createDataFrame([(1, 0, "user", "hi")], none.schema)
    assert chat.format_turns(some).first()["message_json"] == '{"content":"hi","role":"user"}'
