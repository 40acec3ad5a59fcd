"""Random conversations against a linker, orderer and validator in plain Python."""

import hashlib
import json
from random import Random

from ratinglens.llm.chat_format import format_chat

KINDS = {"string": ["x", "é"], "integer": [1, -7], "number": [1.5], "boolean": [True], "null": [None], "array": [[1], ["a", 2], []],
         "object": [{"u": 1}, {"v": "x"}, {}]}


def kind_of(value):
    for kind, types in (("boolean", bool), ("integer", int), ("number", float), ("string", str), ("array", list), ("object", dict)):
        if isinstance(value, types):
            return kind
    return "null"


def type_fits(value, schema):
    types = schema.get("type", [])
    types = [types] if isinstance(types, str) else types
    return not types or kind_of(value) in types or (kind_of(value) == "integer" and "number" in types)


def choice_fits(value, schema):
    text = lambda v: json.dumps(v, sort_keys=True, separators=(",", ":"))
    return "enum" not in schema or text(value) in [text(v) for v in schema["enum"]]


def parts(arguments, properties):
    for key, schema in properties.items():
        if key in arguments:
            value = arguments[key]
            yield value, schema
            if isinstance(value, list):
                yield from ((v, schema.get("items", {})) for v in value)
            if isinstance(value, dict):
                yield from ((value[k], s) for k, s in schema.get("properties", {}).items() if k in value)


def valid(call, tools):
    if call.get("name") not in tools:
        return False
    arguments, schema = call.get("arguments"), tools[call["name"]]
    if isinstance(arguments, str):
        try:
            arguments = json.loads(arguments)
        except ValueError:
            return False
    if not isinstance(arguments, dict) or any(k not in arguments for k in schema.get("required", [])):
        return False
    properties = schema.get("properties", {})
    if any(k not in arguments[p] for p, s in properties.items() if isinstance(arguments.get(p), dict) for k in s.get("required", [])):
        return False
    return all(type_fits(v, s) and choice_fits(v, s) for v, s in parts(arguments, properties))


def conversation(random):
    value = lambda: random.choice(KINDS[random.choice(list(KINDS))])
    def schema(depth):
        made = {}
        if random.random() < 0.8:
            made["type"] = random.choice([random.choice(list(KINDS)), random.sample(list(KINDS), 4)])
        if random.random() < 0.2:
            made["enum"] = [value() for _ in range(4)]
        if depth and random.random() < 0.5:
            made["items"] = schema(0)
        if depth and random.random() < 0.5:
            made |= {"properties": {k: schema(0) for k in "uv"}, "required": random.sample("uv", random.randint(0, 1))}
        return made
    tools = [{"name": n, "parameters": {"properties": {k: schema(1) for k in "abc"}, "required": random.sample("abc", random.randint(0, 1))}} for n in "fg"]
    rows, n = [(0, "system", json.dumps({"tools": tools}))], random.randint(1, 12)
    names = [f"c{i}" for i in range(n)]
    for name in names:
        arguments = {k: value() for k in random.sample("abc", random.randint(0, 3))}
        call = {"id": random.choice([name, name, name, random.choice(names)]), "name": random.choice("ffgh"),
                "arguments": random.choice([arguments, arguments, json.dumps(arguments), 3, None]),
                "depends_on": random.sample(names, random.choice([0, 0, 1, 2]) if n > 1 else 0)}
        if random.random() < 0.1:
            del call["id"]
        blank = random.choice(["", " ", "\n\t"])
        rows.append((random.randint(1, 4), "assistant", blank + json.dumps({"content": None, "tool_calls": [call]})))
        rows += [(random.randint(1, 9), "tool", blank + json.dumps({"tool_call_id": call.get("id", "zz"), "content": 1}))] * random.choice([0, 1, 1, 2])
    chain = [{"id": f"k{i}", "name": "f", "arguments": {}, "depends_on": [f"k{i - 1}"] if i else []} for i in range(6)]
    rows.append((5, "assistant", json.dumps({"tool_calls": random.sample(chain, 6)})))
    rows += [(6, "tool", json.dumps({"tool_call_id": f"k{i}"})) for i in range(6)]
    return rows


def expected(rows):
    tools, calls = {}, []
    for turn, role, text in rows:
        body = json.loads(text)
        if role == "system":
            tools = {t["name"]: t["parameters"] for t in body["tools"]}
        for slot, call in enumerate(body.get("tool_calls", [])):
            calls.append((turn, hashlib.md5(text.encode()).hexdigest(), slot, call))
    first = {}
    for turn, digest, slot, call in sorted(calls, key=lambda c: c[:3]):
        if "id" in call:
            first.setdefault(call["id"], (turn, digest, slot, call))
    level = {}
    while True:
        ready = {k: 1 + max([level[d] for d in c[3].get("depends_on", []) if d in first], default=-1) for k, c in first.items()
                 if k not in level and all(d in level for d in c[3].get("depends_on", []) if d in first)}
        if not ready:
            break
        level |= ready
    found = []
    for turn, role, text in rows:
        body, digest = json.loads(text), hashlib.md5(text.encode()).hexdigest()
        listed = body.get("tool_calls", [])
        good = sum("id" in c and first[c["id"]][:3] == (turn, digest, s) and valid(c, tools) for s, c in enumerate(listed))
        known = first.get(body.get("tool_call_id")) if role == "tool" else None
        at = (known[0], level.get(body["tool_call_id"], 2**31 - 1), known[2]) if known else (turn, -1, -1)
        status = ("message" if role == "system" else "call" if role == "assistant" else "orphan_result" if not known
                  else "result" if body["tool_call_id"] in level else "cycle")
        found.append((turn, role, *at, len(listed), len(listed) - good, status))
    return sorted(found)


def test_random_conversations(spark):
    random = Random(11)
    made = {conv: conversation(random) for conv in range(60)}
    rows = [(conv, *row) for conv, listed in made.items() for row in listed]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    found = {}
    for r in format_chat(df).collect():
        found.setdefault(r.conv_id, []).append((r.turn, r.role, r.order_turn, r.order_level, r.order_slot, r.n_calls, r.n_bad_calls, r.status))
    assert {k: sorted(v) for k, v in found.items()} == {k: expected(v) for k, v in made.items()}
    bad = sum(r[6] for v in found.values() for r in v)
    assert 100 < bad < sum(r[5] for v in found.values() for r in v) - 100
    assert {r[7] for v in found.values() for r in v} == {"message", "call", "result", "orphan_result", "cycle"}
    levels = sorted(r[3] for r in found[0] if r[7] == "result" and r[2] == 5)
    assert levels == list(range(6))


def test_two_messages_of_one_turn_are_counted_apart(spark):
    tools = {"tools": [{"name": "f", "parameters": {"required": ["a"], "properties": {"a": {"type": ["string", "null"], "enum": ["x", None]}}}}]}
    call = lambda name, arguments: json.dumps({"tool_calls": [{"id": name, "name": "f", "arguments": arguments}]})
    texts = [call("1", {"a": "x"}), call("2", {}), "\n" + call("3", {"a": None}), call("4", {"a": "y"}), call("5", {"a": 1})]
    rows = [(1, 0, "system", json.dumps(tools))] + [(1, 1, "assistant", t) for t in texts]
    long = json.dumps({"content": "w " * 500_000, "tool_call_id": "1"})
    df = spark.createDataFrame([*rows, (1, 2, "tool", long)], "conv_id bigint, turn bigint, role string, text string")
    found = format_chat(df).collect()
    assert sorted(r.n_bad_calls for r in found if r.role == "assistant") == [0, 0, 1, 1, 1]
    result, = (r for r in found if r.role == "tool")
    assert (result.status, result.order_turn) == ("result", 1) and json.loads(result.json)["content"] == "w " * 500_000
