"""Operator 6: chat messages as canonical JSON, with tool calls linked to their results and checked against schemas.

What is read from the text of a message, if it is a JSON object:

* role ``system``: ``{"tools": [{"name", "parameters": {"properties": {key: schema}, "required": [key]}}]}``; of a
  schema the keys ``type`` (a name or a list of names), ``enum`` (compared as canonical JSON), ``items`` (``type`` and
  ``enum`` of the elements), ``properties`` (``type`` and ``enum`` of the values) and ``required`` are checked, other
  keys and deeper levels are not
* role ``assistant``: ``{"content", "tool_calls": [{"id", "name", "arguments", "depends_on": [id]}]}``; arguments are
  an object or its JSON text
* role ``tool``: ``{"tool_call_id", "content"}``

Any other text is plain content. Canonical JSON has sorted keys and no white space.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import checkpointed

_KEY = ["conv", "call_id"]


def _at(value, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, path, kind)


def _arguments(call) -> Column:
    """Arguments as canonical JSON; JSON text inside a string is taken out of it."""
    given = _at(call, "$.arguments")
    text = F.when(F.schema_of_variant(given) == "STRING", F.to_json(F.try_parse_json(_at(call, "$.arguments", "string"))))
    return F.coalesce(text, F.to_json(given))


def _json_type(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return (F.when(kind == "BIGINT", "integer").when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number").when(kind == "STRING", "string")
            .when(kind == "BOOLEAN", "boolean").when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object").otherwise("null"))


def _text_json(value: Column) -> Column:
    return F.coalesce(F.to_json(value.cast("variant")), F.lit("null"))


def _texts(value, path: str) -> Column:
    return F.coalesce(_at(value, path, "array<string>"), F.array().cast("array<string>"))


def _named_entries(value, path: str) -> Column:
    entries = F.map_entries(F.coalesce(_at(value, path, "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    return F.filter(entries, lambda e: e["value"].isNotNull())


def _types(schema) -> Column:
    """The names of the permitted types, none if any type is; a single name is a list of one."""
    name = F.when(F.schema_of_variant(_at(schema, "$.type")) == "STRING", F.array(_at(schema, "$.type", "string")))
    return F.coalesce(name, _texts(schema, "$.type"))


def _choices(schema) -> Column:
    """The permitted values as canonical JSON, null if any value is."""
    return F.transform(_at(schema, "$.enum", "array<variant>"), lambda v: F.coalesce(F.to_json(v), F.lit("null")))


def _flat(schema) -> list[Column]:
    return [_types(schema).alias("types"), _choices(schema).alias("choices")]


def _rule(entry) -> Column:
    """What is checked of one property, as plain columns, so that it can be joined and compared."""
    schema = entry["value"]
    inner = F.array_sort(F.transform(_named_entries(schema, "$.properties"), lambda e: F.struct(e["key"].alias("key"), *_flat(e["value"]))))
    return F.struct(entry["key"].alias("key"), *_flat(schema), F.struct(*_flat(_at(schema, "$.items"))).alias("items"),
                    inner.alias("inner"), _texts(schema, "$.required").alias("required"))


def _type_fits(value: Column, types: Column) -> Column:
    kind = _json_type(value)
    return (F.size(types) == 0) | F.array_contains(types, kind) | ((kind == "integer") & F.array_contains(types, "number"))


def _choice_fits(value: Column, choices: Column) -> Column:
    return choices.isNull() | F.array_contains(choices, F.coalesce(F.to_json(value), F.lit("null")))


def parsed_messages(conversations: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """Messages with ``parsed``, null for plain content, and the text's digest, which tells the messages of a turn apart."""
    may_be_json = F.col(role).isin("system", "assistant", "tool") & F.col(text).rlike(r"^[\x20\t\r\n]*\{")
    return conversations.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"),
                                F.when(may_be_json, F.try_parse_json(text)).alias("parsed"), F.when(may_be_json, F.md5(text)).alias("digest"))


def tool_schemas(messages: DataFrame) -> DataFrame:
    """(conv, name, required, rules): the tools that system messages declare; of a repeated name the first one counts."""
    tool = messages.where("role = 'system' and parsed is not null").select(
        "conv", "turn", F.explode(_at("parsed", "$.tools", "array<variant>")).alias("tool"))
    rules = F.array_sort(F.transform(_named_entries("tool", "$.parameters.properties"), _rule))
    one = F.struct("turn", _texts("tool", "$.parameters.required").alias("required"), rules.alias("rules"))
    named = tool.select("conv", _at("tool", "$.name", "string").alias("name"), one.alias("one")).where("name is not null")
    return named.groupBy("conv", "name").agg(F.min("one").alias("one")).select("conv", "name", "one.required", "one.rules")


def tool_calls(messages: DataFrame) -> DataFrame:
    """(conv, call_id, turn, digest, slot, name, arguments, depends_on) of each identified call.

    Of a repeated id the first counts: by turn, in a turn by the digest of the message, in a message by its place.
    """
    call = messages.where("role = 'assistant' and parsed is not null").select(
        "conv", "turn", "digest", F.posexplode(_at("parsed", "$.tool_calls", "array<variant>")).alias("slot", "call"))
    one = F.struct("turn", "digest", "slot", _at("call", "$.name", "string").alias("name"), _arguments("call").alias("arguments"),
                   _texts("call", "$.depends_on").alias("depends_on"))
    return call.select("conv", _at("call", "$.id", "string").alias("call_id"), one.alias("one")).where("call_id is not null").groupBy(
        *_KEY).agg(F.min("one").alias("one")).select(*_KEY, "one.*")


def _same(a: DataFrame, b: DataFrame, keys) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Calls with ``verdict``: the first that applies of unknown_tool, malformed (arguments are no object),
    missing_argument, wrong_type, wrong_value (not in an enum), valid; the last three speak of elements and inner
    properties, too."""
    joined = calls.join(schemas.withColumnRenamed("conv", "of_conv").withColumnRenamed("name", "of_name"),
                        F.col("conv").eqNullSafe(F.col("of_conv")) & (F.col("name") == F.col("of_name")), "left").withColumn(
                            "actual", F.from_json("arguments", "map<string,variant>"))
    inside = lambda value: _at(value, "$", "map<string,variant>")
    has = lambda entries, key: F.coalesce(F.map_contains_key(entries, key), F.lit(False))

    def everywhere(test):
        """``test`` (value, types and choices) of each given argument, its elements and its inner properties."""
        def rule_holds(rule):
            value = F.element_at("actual", rule["key"])
            elements = F.coalesce(_at(value, "$", "array<variant>"), F.array().cast("array<variant>"))
            inner = F.forall(rule["inner"], lambda r: ~has(inside(value), r["key"]) | test(F.element_at(inside(value), r["key"]), r))
            return ~has(F.col("actual"), rule["key"]) | (
                test(value, rule) & F.forall(elements, lambda v: test(v, rule["items"])) & inner)
        return F.forall("rules", rule_holds)

    def complete_inside(rule):
        entries = inside(F.element_at("actual", rule["key"]))
        return entries.isNull() | F.forall(rule["required"], lambda key: has(entries, key))

    complete = F.forall("required", lambda key: has(F.col("actual"), key)) & F.forall("rules", complete_inside)
    verdict = (F.when(F.col("of_name").isNull(), "unknown_tool").when(F.col("actual").isNull(), "malformed")
               .when(~complete, "missing_argument")
               .when(~everywhere(lambda v, r: _type_fits(v, r["types"])), "wrong_type")
               .when(~everywhere(lambda v, r: _choice_fits(v, r["choices"])), "wrong_value").otherwise("valid"))
    return joined.withColumn("verdict", verdict).select(*calls.columns, "verdict")


def with_levels(calls: DataFrame) -> DataFrame:
    """Calls with ``level``: 0 without a known call to wait for, else one more than the highest that it depends on.

    Each round settles the calls of which all requirements are settled, so there are as many rounds as levels.
    Calls on a cycle, and those that wait for them, get level null.
    """
    calls = checkpointed(calls)
    needs = calls.select(*_KEY, F.explode("depends_on").alias("needed")).distinct()
    known = calls.select(F.col("conv").alias("of_conv"), F.col("call_id").alias("of_id"))
    waiting = checkpointed(needs.join(known, F.col("conv").eqNullSafe(F.col("of_conv")) & (F.col("needed") == F.col("of_id"))).select(*_KEY, "needed"))
    held = waiting.select(*_KEY).distinct()
    settled = calls.join(held, _same(calls, held, _KEY), "left_anti").select(*_KEY, F.lit(0).alias("level"))
    level = 0
    while not waiting.isEmpty():
        level += 1
        done = settled.select(F.col("conv").alias("of_conv"), F.col("call_id").alias("of_id"), F.lit(True).alias("met"))
        state = waiting.join(done, F.col("conv").eqNullSafe(F.col("of_conv")) & (F.col("needed") == F.col("of_id")), "left")
        ready = checkpointed(state.groupBy(*_KEY).agg(F.count("*").alias("n"), F.count("met").alias("m")).where("n = m").select(*_KEY))
        if ready.isEmpty():
            break
        settled = checkpointed(settled.unionByName(ready.withColumn("level", F.lit(level))))
        waiting = checkpointed(waiting.join(ready, _same(waiting, ready, _KEY), "left_anti"))
    placed = settled.select(F.col("conv").alias("of_conv"), F.col("call_id").alias("of_id"), "level")
    return calls.join(placed, F.col("conv").eqNullSafe(F.col("of_conv")) & (F.col("call_id") == F.col("of_id")), "left").drop("of_conv", "of_id")


def format_chat(conversations: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """(conv_id, turn, role, order_turn, order_level, order_slot, n_calls, n_bad_calls, status, json) of each message.

    Calls and results are joined by (conversation, identifier). Within a conversation, (order_turn, order_level,
    order_slot, turn) is a topological order: a result stands behind the message with its call, after the results
    of the calls that its call depends on, wherever it was recorded. No conversation is gathered, so its length does not matter.

    status: ``message``, ``call``, ``result``; ``orphan_result`` without a call; ``cycle`` for the result of a call that
    waits for itself, put behind all others of its message. n_bad_calls counts the calls of a message that are not
    valid, have no id or repeat one; messages of one turn are counted apart unless their texts are equal.

    A null conversation is one conversation; null texts give null content, null roles null; repeated rows are
    returned each and link alike. Other columns are ignored.
    """
    messages = parsed_messages(conversations, conv_id, turn, role, text)
    calls = checkpointed(with_levels(validated(tool_calls(messages), tool_schemas(messages))))
    good = calls.groupBy("conv", "turn", "digest").agg(F.count_if(F.col("verdict") == "valid").alias("n_valid")).select(
        F.col("conv").alias("good_conv"), F.col("turn").alias("good_turn"), F.col("digest").alias("good_digest"), "n_valid")
    links = calls.select(F.col("conv").alias("call_conv"), "call_id", F.col("turn").alias("call_turn"), "slot", "level")
    listed = F.when(F.col("role") == "assistant", _at("parsed", "$.tool_calls", "array<variant>"))
    answers = F.when(F.col("role") == "tool", _at("parsed", "$.tool_call_id", "string"))
    linked = (messages.withColumn("calls", listed).withColumn("answers", answers)
              .join(good, F.col("conv").eqNullSafe(F.col("good_conv")) & F.col("turn").eqNullSafe(F.col("good_turn"))
                    & (F.col("digest") == F.col("good_digest")) & F.col("calls").isNotNull(), "left")
              .join(links, F.col("conv").eqNullSafe(F.col("call_conv")) & (F.col("answers") == F.col("call_id")), "left"))
    found, is_result = F.col("call_id").isNotNull(), F.col("answers").isNotNull()
    call_json = lambda c: F.concat(
        F.lit('{"arguments":'), F.coalesce(_arguments(c), F.lit("null")), F.lit(',"id":'), _text_json(_at(c, "$.id", "string")),
        F.lit(',"name":'), _text_json(_at(c, "$.name", "string")), F.lit("}"))
    structured = F.col("calls").isNotNull() | is_result
    content = F.when(structured, F.coalesce(F.to_json(_at("parsed", "$.content")), F.lit("null"))).otherwise(_text_json(F.col("text")))
    json = F.concat(
        F.lit('{"content":'), content, F.lit(',"role":'), _text_json(F.col("role")),
        F.when(is_result, F.concat(F.lit(',"tool_call_id":'), _text_json(F.col("answers")))).otherwise(""),
        F.when(F.col("calls").isNotNull(), F.concat(F.lit(',"tool_calls":['), F.array_join(F.transform("calls", call_json), ","), F.lit("]"))).otherwise(""),
        F.lit("}"))
    n_calls = F.coalesce(F.size("calls"), F.lit(0)).cast("bigint")
    status = (F.when(found & F.col("level").isNull(), "cycle").when(found, "result").when(is_result, "orphan_result")
              .when(F.col("calls").isNotNull(), "call").otherwise("message"))
    return linked.select(
        F.col("conv").alias("conv_id"), "turn", "role",
        F.when(found, F.col("call_turn")).otherwise(F.col("turn")).alias("order_turn"),
        F.when(found, F.coalesce("level", F.lit(2**31 - 1))).otherwise(-1).alias("order_level"),
        F.when(found, F.col("slot")).otherwise(-1).alias("order_slot"),
        n_calls.alias("n_calls"), F.greatest(F.lit(0).cast("bigint"), n_calls - F.coalesce("n_valid", F.lit(0))).alias("n_bad_calls"),
        status.alias("status"), json.alias("json"))
