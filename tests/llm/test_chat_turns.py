"""No turn and no text of a turn vanishes beside tool calls."""

import json

from corvane.llm import chat
from tests.llm.test_chat import SCHEMAS, call


def test_every_turn_is_in_the_output(spark):
    bodies = [
        {"tool_calls": []},
        {"tool_calls": [], "content": "no calls"},
        {"tool_calls": [call("a", "weather", {"city": "Bonn"})], "content": "I look"},
        {"tool_call_id": "a", "content": 3, "tool_calls": [call("b", "weather", {"city": "Kiel"})]},
        {"tool_call_id": "b", "content": 4, "tool_calls": []},
        {"tool_calls": [call("c", "weather", {"city": "Ulm"})]},
    ]
    turns = spark.createDataFrame([(1, i, "assistant", json.dumps(b)) for i, b in enumerate(bodies)], "conv_id long, turn long, role string, text string")
    out = chat.format_turns(turns, spark.createDataFrame(SCHEMAS, chat.SCHEMA_DDL)).collect()
    assert sorted((r["turn"], r["kind"], r["call_id"] or "", r["status"]) for r in out) == [
        (0, "message", "", "message"), (1, "message", "", "message"), (2, "call", "a", "ok"), (2, "message", "", "message"),
        (3, "call", "b", "ok"), (3, "result", "a", "linked"), (4, "result", "b", "linked"), (5, "call", "c", "unanswered"),
    ]
    assert {r["turn"]: json.loads(json.loads(r["message_json"])["content"]) for r in out if r["kind"] == "message"} == {i: bodies[i] for i in (0, 1, 2)}
