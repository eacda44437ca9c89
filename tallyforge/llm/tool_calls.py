"""Chat formatting: tool calls linked with their results.

An assistant message whose text is a JSON object with ``tool_calls`` makes calls, each with ``id``, ``name``,
``arguments`` (an object, or its JSON as a string) and, if it needs earlier calls of the conversation,
their ids in ``after``.  A message of the role ``tool`` is a JSON object with ``tool_call_id`` and
``content``.  Calls and results are joined by conversation and identifier, calls get the level of a
topological order, arguments are validated against the tool's schema, and each call is written with its
result as canonical JSON: keys sorted, no spaces, characters as they are.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, as_text, numbered, same, stage

EVENT_TYPE = (
    "conv_id string, turn string, pos int, kind string, call_id string, name string, body string, "
    "after array<string>, problem string"
)
LINK_COLUMNS = (
    "conv_id", "call_id", "nth", "name", "call_turn", "result_turn", "level", "status", "valid", "problem", "json",
)

_KINDS = {
    "object": dict,
    "array": list,
    "string": str,
    "boolean": bool,
    "null": type(None),
}


def encodable(text: str) -> str:
    """``text`` with halves of a surrogate pair, which UTF-8 does not have, as their JSON escapes."""
    return re.sub("[\ud800-\udfff]", lambda half: f"\\u{ord(half[0]):04x}", text)


def canonical(value: Any) -> str:
    return encodable(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False))


def _finite(number: str) -> float:
    """A number with a fraction or exponent; JSON has no names for those beyond all bounds."""
    value = float(number)
    if not math.isfinite(value):
        raise ValueError(f"{number} is out of range")
    return value


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def _is(value: Any, kind: str) -> bool:
    if kind in ("integer", "number"):
        whole = isinstance(value, int) or (isinstance(value, float) and value.is_integer())
        return not isinstance(value, bool) and (whole if kind == "integer" else isinstance(value, (int, float)))
    return isinstance(value, _KINDS[kind])


def violation(value: Any, schema: dict[str, Any], path: str = "") -> str | None:
    """The first way in which ``value`` breaks the schema, in a fixed order; None if it holds.

    Known words: type, enum, minimum, maximum, minLength, maxLength, required, properties,
    additionalProperties (false) and items.
    """
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    where = path or "arguments"
    if kinds and not any(_is(value, k) for k in kinds):
        return f"{where}: not {' or '.join(kinds)}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{where}: not in enum"
    if _is(value, "number"):
        if "minimum" in schema and value < schema["minimum"]:
            return f"{where}: below minimum"
        if "maximum" in schema and value > schema["maximum"]:
            return f"{where}: above maximum"
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            return f"{where}: too short"
        if len(value) > schema.get("maxLength", len(value)):
            return f"{where}: too long"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in sorted(schema.get("required", [])):
            if name not in value:
                return f"{where}.{name}: missing"
        for name in sorted(value):
            if name in known:
                if found := violation(value[name], known[name], f"{where}.{name}"):
                    return found
            elif schema.get("additionalProperties", True) is False:
                return f"{where}.{name}: unknown"
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            if found := violation(item, schema["items"], f"{where}[{i}]"):
                return found
    return None


def _object(text: Any) -> dict[str, Any] | None:
    """The JSON object in a text; None for all else, also for nesting too deep to parse, and for numbers
    that are none: NaN, Infinity and those that no double holds."""
    if not isinstance(text, str) or not text.lstrip().startswith("{"):
        return None
    try:
        value = json.loads(text, parse_constant=_no_constant, parse_float=_finite)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _spelled(value: Any) -> str | None:
    return value if value is None or isinstance(value, str) else canonical(value)


def _text(value: Any) -> str | None:
    """What a column can hold of an identifier or name."""
    return None if value is None else encodable(_spelled(value))


def message_events(role: Any, text: Any, schemas: dict[str, Any]) -> list[tuple]:
    """(pos, kind, call_id, name, body, after, problem) of the calls and results in one message."""
    if role == "tool":
        value = _object(text)
        if value is None:
            return [(0, "result", None, None, "null", [], "result is not an object")]
        identifier = _text(value.get("tool_call_id"))
        problem = None if identifier is not None else "result has no id"
        return [(0, "result", identifier, None, canonical(value.get("content")), [], problem)]
    calls = (_object(text) or {}).get("tool_calls") if role == "assistant" else None
    if not isinstance(calls, list):
        return []
    out = []
    for pos, call in enumerate(calls):
        call = call if isinstance(call, dict) else {}
        identifier, name = _text(call.get("id")), _text(call.get("name"))
        arguments = call.get("arguments")
        if isinstance(arguments, str):
            arguments = _object(arguments)
        after = call.get("after")
        after = sorted({_text(x) for x in after if x is not None}) if isinstance(after, list) else []
        if identifier is None:
            problem = "call has no id"
        elif name not in schemas:
            problem = "unknown tool"
        else:
            problem = _text(violation(arguments, schemas[name]))
        body = canonical({"arguments": arguments, "id": _spelled(call.get("id")), "name": _spelled(call.get("name"))})
        out.append((pos, "call", identifier, name, body, after, problem))
    return out


def events(messages: DataFrame, schemas: dict[str, Any]) -> DataFrame:
    """The calls and results in all messages, one row each."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (conv, turn, *event)
                for conv, turn, role, text in zip(batch["conv_id"], batch["turn"], batch["role"], batch["text"])
                for event in message_events(role, text, schemas)
            ]
            frame = pd.DataFrame(
                rows,
                columns=["conv_id", "turn", "pos", "kind", "call_id", "name", "body", "after", "problem"],
            )
            yield frame.astype({"pos": "int32"})

    read = as_text(messages.select("conv_id", "turn", "role", "text"), "conv_id", "turn")
    return as_long(read.mapInPandas(parse, EVENT_TYPE), "conv_id", "turn")


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, nth and level of the calls whose order is settled.

    Level 0 needs nothing; a call is one level above the highest it needs.  An id names the
    conversation's first call of it; ids that no call has are passed over.  Each round settles one
    level by joins on the whole table, so there are as many rounds as levels; calls in a cycle, or
    that need one, are in no row.
    """
    keys = ["conv_id", "call_id", "nth"]
    nodes = calls.select(*keys)
    heads = calls.filter("nth = 0").select("conv_id", F.col("call_id").alias("need"))
    asked = calls.select(*keys, F.explode("after").alias("need"))
    needs = stage(
        asked.join(heads, same(asked, heads, ["conv_id", "need"])).select(*(asked[c] for c in asked.columns)),
        "needs",
    )
    settled = stage(
        nodes.join(needs, same(nodes, needs, keys), "left_anti").withColumn("level", F.lit(0)), "settled"
    )
    last, level, done = settled, 0, settled
    while not needs.isEmpty() and not last.isEmpty():
        free = last.filter("nth = 0").select("conv_id", F.col("call_id").alias("need"))
        left = stage(needs.join(free, same(needs, free, ["conv_id", "need"]), "left_anti"), "needs")
        level += 1
        waited = needs.select(keys).distinct()
        last = stage(
            waited.join(left, same(waited, left, keys), "left_anti").withColumn("level", F.lit(level)),
            "settled",
        )
        done, needs = done.union(last), left
    return done


def linked_calls(messages: DataFrame, schemas: dict[str, Any]) -> DataFrame:
    """One row for each call, with its result if there is one, and for each result without a call.

    The nth use of an identifier in a conversation is linked with its nth result.  ``status``:
    linked, early (the result's turn is not after the call's), no_result, no_call, or no_id.
    ``valid``: the arguments hold the schema; null without a call.  ``level`` is null in cycles, ``json`` is
    null without a call.  A null conversation counts as one of its own; repeated messages are
    calls of their own; messages that are no JSON objects of the two forms make no rows.  Texts of any
    length are parsed whole; half a surrogate pair, which JSON can spell and UTF-8 cannot, stays as its
    escape; columns other than the four of a message are not looked at.
    """
    found = stage(events(messages, schemas), "events")
    keys = ["conv_id", "call_id"]
    calls = found.filter("kind = 'call' and call_id is not null").select(
        *keys, "name", F.col("turn").alias("call_turn"), "pos", F.col("body").alias("call"), "after", "problem"
    )
    results = found.filter("kind = 'result' and call_id is not null").select(
        *keys, F.col("turn").alias("result_turn"), F.col("body").alias("result")
    )
    calls = stage(numbered(calls, keys, ["call_turn", "pos", "call"], "nth"), "calls")
    results = stage(numbered(results, keys, ["result_turn", "result"], "nth"), "results")
    order = levels(calls)
    named = [*keys, "nth"]
    ranked = calls.join(order, same(calls, order, named), "left").select(
        *(calls[c] for c in calls.columns), "level"
    )
    # one hash join for both kinds: null conversations are told apart by a key that cannot be null
    key = F.struct(F.col("conv_id").isNull(), F.coalesce("conv_id", F.lit(0)), "call_id", "nth").alias("key")
    left = ranked.select("*", key)
    right = results.select(
        key, "result_turn", "result", *(F.col(c).alias(f"r_{c}") for c in named)
    )
    joined = left.join(right, "key", "full")
    status = (
        F.when(F.col("call").isNull(), "no_call")
        .when(F.col("result").isNull(), "no_result")
        .when(F.col("result_turn") <= F.col("call_turn"), "early")
        .otherwise("linked")
    )
    text = F.concat(
        F.lit('{"call":'), "call", F.lit(',"result":'), F.coalesce("result", F.lit("null")), F.lit("}")
    )
    paired = joined.select(
        *(F.when(F.col("call").isNull(), F.col(f"r_{c}")).otherwise(F.col(c)).alias(c) for c in named),
        "name",
        "call_turn",
        "result_turn",
        "level",
        status.alias("status"),
        F.when(F.col("call").isNotNull(), F.col("problem").isNull()).alias("valid"),
        "problem",
        text.alias("json"),
    )
    is_call = F.col("kind") == "call"
    unnamed = found.filter("call_id is null").select(
        "conv_id",
        "call_id",
        F.lit(None).cast("long").alias("nth"),
        "name",
        F.when(is_call, F.col("turn")).alias("call_turn"),
        F.when(~is_call, F.col("turn")).alias("result_turn"),
        F.lit(None).cast("int").alias("level"),
        F.lit("no_id").alias("status"),
        F.when(is_call, F.lit(False)).alias("valid"),
        "problem",
        F.when(is_call, F.concat(F.lit('{"call":'), "body", F.lit(',"result":null}'))).alias("json"),
    )
    return paired.select(*LINK_COLUMNS).union(unnamed.select(*LINK_COLUMNS))


#: The tool of the query below.
SCHEMAS = {
    "reply": {
        "type": "object",
        "required": ["prompt", "turn"],
        "properties": {
            "prompt": {"type": "string", "minLength": 20},
            "turn": {"type": "integer", "minimum": 0},
        },
        "additionalProperties": False,
    }
}


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as calls of one tool: a user's turn asks it, the assistant's next turn is the result.

    A call after the first user's turn needs the first; system turns stay as they are.
    """
    user = conversations.filter("role = 'user'").groupBy("conv_id").agg(F.min("turn").alias("opening"))
    marked = conversations.join(user, "conv_id", "left")
    identifier = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    after = F.when(F.col("turn") > F.col("opening"), F.array(identifier(F.col("opening"))))
    call = F.struct(
        identifier(F.col("turn")).alias("id"),
        F.lit("reply").alias("name"),
        F.struct(F.col("text").alias("prompt"), "turn").alias("arguments"),
        after.alias("after"),
    )
    result = F.struct(identifier(F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content"))
    text = (
        F.when(F.col("role") == "user", F.to_json(F.struct(F.array(call).alias("tool_calls"))))
        .when(F.col("role") == "assistant", F.to_json(result))
        .otherwise(F.col("text"))
    )
    role = (
        F.when(F.col("role") == "user", "assistant")
        .when(F.col("role") == "assistant", "tool")
        .otherwise(F.col("role"))
    )
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def op7_tool_calls(spark, sf_dir: str) -> DataFrame:
    """All conversations as linked calls."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return linked_calls(as_tool_messages(conversations), SCHEMAS)


SQL = r"""
WITH opening AS (SELECT conv_id, min(turn) AS opening FROM conversations WHERE role = 'user' GROUP BY conv_id),
calls AS (
  SELECT c.conv_id, c.conv_id || ':' || turn AS call_id, turn AS call_turn, text, opening,
    row_number() OVER (PARTITION BY c.conv_id, turn ORDER BY text) - 1 AS nth
  FROM conversations c JOIN opening o USING (conv_id) WHERE role = 'user'
),
results AS (
  SELECT conv_id, conv_id || ':' || (turn - 1) AS call_id, turn AS result_turn, text AS result,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) - 1 AS nth
  FROM conversations WHERE role = 'assistant'
),
paired AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
    coalesce(c.nth, r.nth) AS nth, call_turn, result_turn, text, result, opening,
    c.call_id IS NOT NULL AS called
  FROM calls c FULL JOIN results r ON c.call_id = r.call_id AND c.conv_id = r.conv_id AND c.nth = r.nth
)
SELECT conv_id, call_id, nth, CASE WHEN called THEN 'reply' END AS name, call_turn, result_turn,
  CASE WHEN called THEN (call_turn > opening)::INT END AS level,
  CASE WHEN NOT called THEN 'no_call' WHEN result_turn IS NULL THEN 'no_result' ELSE 'linked' END AS status,
  CASE WHEN called THEN length(text) >= 20 END AS valid,
  CASE WHEN called AND length(text) < 20 THEN 'arguments.prompt: too short' END AS problem,
  CASE WHEN called THEN '{"call":{"arguments":{"prompt":' || to_json(text)::VARCHAR || ',"turn":' || call_turn
    || '},"id":"' || call_id || '","name":"reply"},"result":' || coalesce(to_json(result)::VARCHAR, 'null') || '}'
  END AS json
FROM paired
"""
