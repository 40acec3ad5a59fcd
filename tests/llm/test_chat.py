import json

import pytest

from ratinglens.llm.chat_format import format_chat

TOOLS = {"tools": [{"name": "weather", "parameters": {"type": "object", "required": ["city"], "properties": {
    "city": {"type": "string"}, "days": {"type": "integer"}, "limit": {"type": "number"}}}}]}
CALLS = {"content": None, "tool_calls": [
    {"id": "c2", "name": "weather", "arguments": {"days": 3, "city": "Å\"b"}, "depends_on": ["c1"]},
    {"id": "c1", "name": "weather", "arguments": "{\"city\": \"x\",  \"limit\": 2}"},
    {"id": "c3", "name": "weather", "arguments": {"days": "3", "city": "x"}},
    {"id": "c4", "name": "weather", "arguments": {"days": 3}},
    {"id": "c5", "name": "none", "arguments": {}},
    {"id": "c6", "name": "weather", "arguments": 5, "depends_on": ["c7"]},
    {"id": "c7", "name": "weather", "arguments": {"city": "y"}, "depends_on": ["c6"]}]}


@pytest.fixture(scope="module")
def found(spark):
    result = lambda name: json.dumps({"content": {"b": 1, "a": [1.5]}, "tool_call_id": name})
    rows = [
        (1, 0, "system", json.dumps(TOOLS)), (1, 1, "user", "Hi\n\"é\""), (1, 2, "tool", result("c1")), (1, 3, "assistant", json.dumps(CALLS)),
        (1, 4, "tool", result("c2")), (1, 5, "tool", result("zz")), (1, 6, "tool", result("c7")), (1, 7, "assistant", "{no json"),
        (2, 0, "tool", result("c1")), (None, 0, None, None), (2, 1, "user", "a"), (2, 1, "user", "a")]
    df = spark.createDataFrame([(*r, 9, 9) for r in rows], "conv_id bigint, turn bigint, role string, text string, conv int, call_id int")
    return [r.asDict() for r in format_chat(df).collect()]


def test_order_and_links(found):
    order = sorted((r for r in found if r["conv_id"] == 1), key=lambda r: (r["order_turn"], r["order_level"], r["order_slot"], r["turn"]))
    assert [(r["turn"], r["status"]) for r in order] == [
        (0, "message"), (1, "message"), (3, "call"), (2, "result"), (4, "result"), (6, "cycle"), (5, "orphan_result"), (7, "message")]
    assert [r["status"] for r in found if r["conv_id"] == 2 and r["role"] == "tool"] == ["orphan_result"]


def test_validation(found):
    call, = (r for r in found if r["status"] == "call")
    assert (call["n_calls"], call["n_bad_calls"]) == (7, 4)


def test_canonical_json(found):
    by_turn = {r["turn"]: r["json"] for r in found if r["conv_id"] == 1}
    for turn, text in by_turn.items():
        assert text == json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True, separators=(",", ":")), turn
    assert json.loads(by_turn[1]) == {"content": "Hi\n\"é\"", "role": "user"}
    assert json.loads(by_turn[3])["tool_calls"][1] == {"arguments": {"city": "x", "limit": 2}, "id": "c1", "name": "weather"}
    assert json.loads(by_turn[4]) == {"content": {"a": [1.5], "b": 1}, "role": "tool", "tool_call_id": "c2"}


def test_nulls_repeats_and_nothing(spark, found):
    assert [r["json"] for r in found if r["conv_id"] is None] == ['{"content":null,"role":null}']
    assert sum(r["conv_id"] == 2 and r["turn"] == 1 for r in found) == 2
    assert format_chat(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0
