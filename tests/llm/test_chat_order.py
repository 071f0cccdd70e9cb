"""Dependencies of calls against a plain topological sort, faults of arguments, and results before their calls."""

import json
import random

import pytest

from corvane.llm import chat
from tests.llm.test_chat import SCHEMAS, call, result, says


def plain_levels(calls):
    """{id: (level, latest turn)} of {id: (turn, needs)}; None for whoever waits for a cycle."""
    out = {}
    while True:
        ready = {i: [n for n in needs if n in calls] for i, (_, needs) in calls.items() if i not in out}
        ready = {i: needs for i, needs in ready.items() if all(n in out for n in needs)}
        if not ready:
            return out | {i: None for i in calls if i not in out}
        out |= {i: (max([out[n][0] + 1 for n in needs], default=0), max([calls[i][0], *(out[n][1] for n in needs)])) for i, needs in ready.items()}


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    graphs, turns = {}, []
    for conv in range(25):
        n = rng.randint(1, 14)
        ids = [f"c{i}" for i in range(n)]
        graphs[conv] = {}
        for i in rng.sample(range(n), n):
            few = [x for x in ids if x != ids[i] or rng.random() < 0.1]
            back = [x for x in ids[:i]] if rng.random() < 0.85 else few
            needs = rng.sample(back, min(len(back), rng.choice([0, 1, 1, 2, 3]))) + ["gone"] * (rng.random() < 0.1)
            graphs[conv][ids[i]] = (rng.randint(0, 30), needs)
        for i, (turn, needs) in graphs[conv].items():
            turns.append((conv, turn, "assistant", says(call(i, "weather", {"city": "x"}, depends_on=needs))))
            turns.append((conv, turn + 40, "tool", result(i, 1)))
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat.format_turns(df, spark.createDataFrame(SCHEMAS, chat.SCHEMA_DDL)).collect()
    kinds = set()
    for conv, calls in graphs.items():
        want = plain_levels(calls)
        got = {r["call_id"]: r for r in out if r["conv_id"] == conv and r["kind"] == "call"}
        answers = {r["call_id"]: r for r in out if r["conv_id"] == conv and r["kind"] == "result"}
        assert got.keys() == answers.keys() == calls.keys()
        for i, (turn, needs) in calls.items():
            lost = any(n not in calls for n in needs)
            status = "cyclic" if want[i] is None else "unknown_dependency" if lost else "ok"
            level, top = want[i] or (-0.5, turn)
            assert (got[i]["status"], got[i]["level"], got[i]["order_turn"], got[i]["linked_turn"]) == (status, 2 * level, top, turn + 40)
            kinds.add(status)
            key = lambda r: (r["order_turn"], r["level"], r["turn"])
            assert key(got[i]) < key(answers[i])
            for n in needs:
                if want[i] and n in calls:
                    assert key(answers[n]) < key(got[i])
    assert kinds == {"ok", "cyclic", "unknown_dependency"}


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n, cuts = 700, []
    turns = [(1, i, "assistant", says(call(f"c{i}", "weather", {"city": "x"}, depends_on=[f"c{i - 1}"] if i else []))) for i in range(n)]
    real = chat.cut
    monkeypatch.setattr(chat, "cut", lambda df: cuts.append(1) or real(df))
    out = chat.format_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert {r["call_id"]: r["level"] for r in out} == {f"c{i}": 2 * i for i in range(n)} and len(cuts) < 30


def test_forward_references_arguments_and_early_results(spark):
    turns = [
        (1, 0, "assistant", says(call("a", "weather", {"city": "x"}, depends_on=["b"]))), (1, 5, "assistant", says(call("b", "weather", {"city": "x"}))), (1, 6, "tool", result("b", 1)),
        (2, 0, "assistant", says(call("p", "weather", "oops"), call("q", "weather", [1]), call("r", "weather", None), {"id": "s", "name": "sum"}, "text")),
        (3, 0, "tool", result("a", 1)), (3, 1, "assistant", says(call("a", "weather", {"city": "x"}))), (3, 1, "tool", result("a", 2)),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat.format_turns(df, spark.createDataFrame(SCHEMAS, chat.SCHEMA_DDL)).collect()
    first = sorted((r for r in out if r["conv_id"] == 1), key=lambda r: (r["order_turn"], r["level"], r["turn"]))
    assert [(r["kind"], r["call_id"]) for r in first] == [("call", "b"), ("result", "b"), ("call", "a")]
    assert {r["call_id"]: r["status"] for r in out if r["conv_id"] == 2} == {"p": "not_an_object", "q": "not_an_object", "r": "missing_argument", "s": "missing_argument", None: "unknown_tool"}
    assert sorted((r["kind"], r["status"]) for r in out if r["conv_id"] == 3) == [("call", "unanswered"), ("result", "early"), ("result", "early")]


def test_canonical_form_is_json(spark):
    df = spark.createDataFrame([(1, 0, "tool", json.dumps({"tool_call_id": "x", "b": {"z": 1, "a": [True, None]}}))], "conv_id long, turn long, role string, text string")
    assert chat.format_turns(df).first()["message_json"] == '{"role":"tool","tool_result":{"b":{"a":[true,null],"z":1},"tool_call_id":"x"}}'
