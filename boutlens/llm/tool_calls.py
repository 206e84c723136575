"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

Calls and results are hash-joined by (conversation, identifier), each side aggregated by it before. Within a
conversation calls come in topological order: a call's level is one more than the highest level of those it depends on,
found by peeling the levels off with joins; by level, then turn, then identifier. Arguments are validated against the
schema of the tool (a subset of JSON Schema: see ``problems``). Canonical JSON has sorted keys, no blanks and no
escapes that JSON does not need.

Defined results: rows without a conversation or an identifier are not calls and go. Of rows that repeat an identifier,
the first (by turn, then content) stands, and ``repeats`` counts all. A result without a call is returned with status
``orphan``, a call without a result ``unanswered``. A call whose dependency is missing ignores it; calls on a cycle
have no level, come last and are marked. Arguments that are no JSON object, tools without a schema, and schemas that are
no JSON or use a known word with a value of the wrong kind are problems, not errors. Halves of surrogate pairs, which JSON
can escape and UTF-8 cannot hold, stay escaped. Other columns of the three tables are not read.
"""

from __future__ import annotations

import json
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small
from .mixing import running

#: Rows of a conversation's order that one window partition spans, by turn.
SPAN = 256
SURROGATE = re.compile("[\ud800-\udfff]")
TYPES = {
    "string": lambda x: isinstance(x, str), "boolean": lambda x: isinstance(x, bool), "null": lambda x: x is None,
    "integer": lambda x: isinstance(x, int) and not isinstance(x, bool) or isinstance(x, float) and x.is_integer(),
    "number": lambda x: isinstance(x, (int, float)) and not isinstance(x, bool), "array": lambda x: isinstance(x, list),
    "object": lambda x: isinstance(x, dict),
}


def usable(schema) -> bool:
    """Whether the words that :func:`problems` reads have values of their kind, at every depth."""
    if not isinstance(schema, dict):
        return False
    kinds = schema.get("type", [])
    kinds = kinds if isinstance(kinds, list) else [kinds]
    inner = schema.get("properties", {})
    return (
        all(isinstance(k, str) and k in TYPES for k in kinds) and isinstance(schema.get("enum", []), list)
        and isinstance(schema.get("required", []), list) and all(isinstance(k, str) for k in schema.get("required", []))
        and all(TYPES["number"](schema.get(k, 0)) for k in ("minLength", "maxLength", "minimum", "maximum"))
        and isinstance(inner, dict) and all(map(usable, inner.values())) and ("items" not in schema or usable(schema["items"]))
    )


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with ``value``: type, enum, required, properties, additionalProperties, items and bounds are known."""
    found: list[str] = []
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(TYPES[k](value) for k in kinds):
            return [f"{at}: not of type {'|'.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not one of the values allowed")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                found += problems(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}.{k}: not allowed")
    elif isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += problems(x, schema["items"], f"{at}[{i}]")
    elif isinstance(value, str):
        found += [f"{at}: too short"] if len(value) < schema.get("minLength", 0) else []
        found += [f"{at}: too long"] if len(value) > schema.get("maxLength", len(value)) else []
    elif TYPES["number"](value):
        found += [f"{at}: too small"] if value < schema.get("minimum", value) else []
        found += [f"{at}: too large"] if value > schema.get("maximum", value) else []
    return found


def canonical(value) -> str:
    return written(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def written(text: str) -> str:
    """``text`` with halves of surrogate pairs escaped."""
    return SURROGATE.sub(lambda half: f"\\u{ord(half[0]):04x}", text)


def rule_of(text: str | None) -> tuple[dict | None, str | None]:
    """(schema, problem) of a schema's text."""
    if text is None:
        return None, "no schema"
    try:
        rule = json.loads(text)
        return (rule, None) if usable(rule) else (None, "schema: not usable")
    except (ValueError, RecursionError):
        return None, "schema: not usable"


def checked(call_id: Column, name: Column, arguments: Column, schema: Column, result: Column) -> Column:
    """struct(json, problems): the canonical call with its result, and what is wrong with its arguments."""

    @F.pandas_udf("json string, problems array<string>")
    def check(ids: pd.Series, names: pd.Series, args: pd.Series, schemas: pd.Series, results: pd.Series) -> pd.DataFrame:
        rows, rules = [], {text: rule_of(text) for text in set(schemas)}
        for call, tool, text, rule_text, answer in zip(ids, names, args, schemas, results):
            try:
                value = json.loads(text or "")
                wrong = [] if isinstance(value, dict) else ["$: not an object"]
            except (ValueError, RecursionError):
                value, wrong = text, ["$: not JSON"]
            rule, problem = rules[rule_text]
            if problem is not None:
                wrong.append(problem)
            elif not wrong:
                wrong = problems(value, rule)
            whole = {"arguments": value, "id": call, "name": tool, "result": answer}
            try:
                rows.append((canonical(whole), list(map(written, wrong))))
            except (ValueError, RecursionError):  # NaN, or nested too deep
                rows.append((canonical(whole | {"arguments": text}), list(map(written, wrong)) or ["$: not canonical"]))
        return pd.DataFrame(rows, columns=["json", "problems"])

    return check(call_id, name, arguments, schema, result)


def levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of ``calls``; ``needs`` has (conv_id, call_id, needed). One round for each level."""
    keys = ["conv_id", "call_id"]
    every = calls.select(*keys)
    known = every.withColumnRenamed("call_id", "needed")
    needs = cut(needs.filter("needed IS NOT NULL AND needed != call_id").distinct().join(known, ["conv_id", "needed"], "left_semi"))
    placed = cut(every.join(needs, keys, "left_anti").withColumn("level", F.lit(0)))
    parts, level, last, open_ = [placed], 0, placed, needs
    while open_.limit(1).count():
        level += 1
        # what was placed last is needed no more; calls with nothing left to wait for have this level
        done = last.select("conv_id", F.col("call_id").alias("needed"))
        left = cut(open_.join(done, ["conv_id", "needed"], "left_anti"))
        waiting = open_.select(*keys).distinct().join(left.select(*keys).distinct(), keys, "left_anti")
        last = cut(waiting.withColumn("level", F.lit(level)))
        if not last.limit(1).count():
            break  # only cycles are left
        parts.append(last)
        open_ = left
    return reduce(DataFrame.unionByName, parts)


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls``: conv_id, turn, call_id, name, arguments (JSON), needs (array of ids, or null). ``results``: conv_id, turn,
    call_id, content. ``schemas``: name, schema (JSON), a row for each tool.

    Returns conv_id, call_id, status (linked, unanswered, orphan), repeats, level, position (from 0 in the conversation;
    null for orphans), cyclic, problems and json.
    """
    keys = ["conv_id", "call_id"]
    whole = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = F.min(F.struct("turn", "name", "arguments", "needs"))
    called = calls.filter(whole).groupBy(*keys).agg(first.alias("call"), F.count("*").alias("repeats"))
    called = cut(called.select(*keys, "call.*", "repeats"))
    answered = results.filter(whole).groupBy(*keys).agg(F.min(F.struct("turn", "content")).alias("answer"))
    answered = answered.select(*keys, F.col("answer.content").alias("content"), F.lit(True).alias("answered"))
    needs = called.select(*keys, F.explode("needs").alias("needed"))
    ranked = called.join(levels(called, needs), keys, "left")
    # cycles come last; the running count goes by stretches of turns, so a hot conversation is split
    run = F.coalesce(F.col("level"), F.lit(1 << 20)).cast("long") * (1 << 40) + F.floor(F.coalesce("turn", F.lit(0)) / SPAN)
    ranked = running(ranked.withColumn("one", F.lit(1)), ["conv_id"], ["level", "turn", "call_id"], "one", "position", run)
    joined = ranked.join(answered, keys, "full")
    rules = schemas.groupBy("name").agg(F.min("schema").alias("schema"))
    joined = joined.join(small(rules), "name", "left")
    status = F.when(F.col("repeats").isNull(), "orphan").when(F.col("answered"), "linked").otherwise("unanswered")
    judged = checked(F.col("call_id"), F.col("name"), F.col("arguments"), F.col("schema"), F.col("content"))
    orphan = F.col("repeats").isNull()
    done = joined.select("*", status.alias("status"), judged.alias("judged"))
    return done.select(
        *keys, "status", F.coalesce("repeats", F.lit(0)).alias("repeats"), "level", F.col("position").cast("long").alias("position"),
        (~orphan & F.col("level").isNull()).alias("cyclic"), F.when(~orphan, F.col("judged.problems")).alias("problems"),
        F.col("judged.json").alias("json"),
    )
