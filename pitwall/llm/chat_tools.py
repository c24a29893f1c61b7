"""Chat formatting: tool calls linked to their results, put in dependency order, checked against schemas, and written as canonical JSON."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pitwall.sources.scratch import remove_path, scratch_path, staged

_TYPES = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list), "string": lambda v: isinstance(v, str), "boolean": lambda v: isinstance(v, bool), "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(), "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
}
#: Words of a schema by what their value holds: one schema, a list of schemas, schemas by name, or anything else that is checked here.
_ONE, _LIST, _NAMED = {"not", "if", "then", "else", "items", "contains", "additionalProperties", "propertyNames"}, {"anyOf", "oneOf", "allOf", "prefixItems"}, {"properties", "patternProperties", "$defs", "definitions"}
_PLAIN = set("type enum const required minLength maxLength pattern minimum maximum exclusiveMinimum exclusiveMaximum multipleOf minItems maxItems uniqueItems minProperties maxProperties minContains maxContains dependentRequired $ref".split())
#: Words that say nothing about what is valid.
_NOTES = set("title description default examples deprecated readOnly writeOnly format $schema $id $comment $anchor".split())


def check_schema(schema, root=None, at: str = "#") -> None:
    """ValueError for a schema with a word or type that `schema_errors` doesn't know, a pattern that is none, or a `$ref` that leads nowhere in it."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: a schema is an object, true or false")
    for word, value in schema.items():
        if word in _ONE:
            check_schema(value, root, f"{at}/{word}")
        elif word in _LIST or word in _NAMED:
            for k, v in value.items() if word in _NAMED else enumerate(value):
                check_schema(v, root, f"{at}/{word}/{k}")
                if word == "patternProperties":
                    _pattern(k, at)
        elif word not in _PLAIN and word not in _NOTES:
            raise ValueError(f"{at}: unknown word {word}")
    kinds = schema.get("type", [])
    unknown = [k for k in ([kinds] if isinstance(kinds, str) else kinds) if k not in _TYPES]
    if unknown:
        raise ValueError(f"{at}: unknown type {unknown[0]}")
    if "pattern" in schema:
        _pattern(schema["pattern"], at)
    seen = [schema]
    while isinstance(seen[-1], dict) and "$ref" in seen[-1]:
        seen.append(_referred(root, seen[-1]["$ref"], at))
        if any(s is seen[-1] for s in seen[:-1]):
            raise ValueError(f"{at}: $ref leads back to itself")


def _pattern(text: str, at: str) -> None:
    try:
        re.compile(text)
    except re.error as e:
        raise ValueError(f"{at}: pattern {text}") from e


def _referred(root: dict, ref: str, at: str = ""):
    """The schema that a `$ref` inside the same document names."""
    found = root
    if not ref.startswith("#"):
        raise ValueError(f"{at}: $ref {ref} is outside the schema")
    for step in ref[1:].split("/")[1:]:
        step = step.replace("~1", "/").replace("~0", "~")
        try:
            found = found[int(step)] if isinstance(found, list) else found[step]
        except (KeyError, IndexError, ValueError, TypeError):
            raise ValueError(f"{at}: $ref {ref} leads nowhere") from None
    return found


def schema_errors(value, schema: dict, at: str = "", root: dict | None = None) -> list[str]:
    """Where a JSON value breaks a schema: type, enum, const, bounds on numbers, lengths, items and properties, what objects and arrays hold, patterns,
    anyOf, oneOf, allOf, not, if, and `$ref` within the schema. Values are compared as JSON: 1 is 1.0 and isn't true."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return [] if schema else [f"{at or '.'}: not allowed"]
    out, here = [], at or "."
    if "$ref" in schema:
        out += schema_errors(value, _referred(root, schema["$ref"]), at, root)
    kinds = schema.get("type")
    if kinds is not None and not any(_TYPES[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return out + [f"{here}: not {kinds if isinstance(kinds, str) else ' or '.join(kinds)}"]
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]) or "const" in schema and canonical(value) != canonical(schema["const"]):
        out.append(f"{here}: not allowed")
    if isinstance(value, dict):
        out += _object_errors(value, schema, at, root)
    elif isinstance(value, list):
        out += _array_errors(value, schema, at, root)
    elif isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            out.append(f"{here}: length {len(value)}")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{here}: pattern")
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        low, high = schema.get("exclusiveMinimum"), schema.get("exclusiveMaximum")
        if not schema.get("minimum", value) <= value <= schema.get("maximum", value) or low is not None and value <= low or high is not None and value >= high:
            out.append(f"{here}: out of range")
        if "multipleOf" in schema and Fraction(str(value)) % Fraction(str(schema["multipleOf"])):
            out.append(f"{here}: no multiple of {canonical(schema['multipleOf'])}")

    def fits(s) -> bool:
        return not schema_errors(value, s, at, root)

    for s in schema.get("allOf", []):
        out += schema_errors(value, s, at, root)
    if "anyOf" in schema and not any(map(fits, schema["anyOf"])):
        out.append(f"{here}: none of anyOf")
    if "oneOf" in schema and (n := sum(map(fits, schema["oneOf"]))) != 1:
        out.append(f"{here}: {n} of oneOf")
    if "not" in schema and fits(schema["not"]):
        out.append(f"{here}: not allowed")
    if "if" in schema and (branch := schema.get("then" if fits(schema["if"]) else "else")) is not None:
        out += schema_errors(value, branch, at, root)
    return out


def _object_errors(value: dict, schema: dict, at: str, root: dict) -> list[str]:
    known, patterns, rest = schema.get("properties", {}), schema.get("patternProperties", {}), schema.get("additionalProperties", True)
    out = [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
    out += [f"{at}.{k}: missing" for has, more in schema.get("dependentRequired", {}).items() if has in value for k in more if k not in value]
    if not schema.get("minProperties", 0) <= len(value) <= schema.get("maxProperties", len(value)):
        out.append(f"{at or '.'}: {len(value)} properties")
    for k in sorted(value):
        held = ([known[k]] if k in known else []) + [s for p, s in patterns.items() if re.search(p, k)]
        for s in held:
            out += schema_errors(value[k], s, f"{at}.{k}", root)
        if not held and rest is not True:
            out += [f"{at}.{k}: unknown"] if rest is False else schema_errors(value[k], rest, f"{at}.{k}", root)
        if "propertyNames" in schema and schema_errors(k, schema["propertyNames"], "", root):
            out.append(f"{at}.{k}: name")
    return out


def _array_errors(value: list, schema: dict, at: str, root: dict) -> list[str]:
    out, first = [], schema.get("prefixItems", [])
    for i, v in enumerate(value):
        out += schema_errors(v, first[i] if i < len(first) else schema.get("items", True), f"{at}[{i}]", root)
    if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
        out.append(f"{at or '.'}: {len(value)} items")
    if schema.get("uniqueItems") and len(set(map(canonical, value))) < len(value):
        out.append(f"{at or '.'}: repeated items")
    if "contains" in schema:
        n = sum(not schema_errors(v, schema["contains"], at, root) for v in value)
        if not schema.get("minContains", 1) <= n <= schema.get("maxContains", n):
            out.append(f"{at or '.'}: contains {n}")
    return out


def _number(v: int | float) -> str:
    """A number as JavaScript writes it: plain digits from 1e-6 up to 1e21, else an exponent with its sign; whole numbers of any size keep all digits."""
    if isinstance(v, int):
        return str(v)
    if not math.isfinite(v):
        raise ValueError("not a number")
    if v.is_integer() and abs(v) < 1e21:
        return str(int(v))
    digits, _, exponent = repr(v).partition("e")
    if 1e-6 <= abs(v) < 1e21:
        return format(Decimal(repr(v)), "f")
    power = int(exponent)
    return f"{digits.removesuffix('.0')}e{'+' if power > 0 else '-'}{abs(power)}"


def canonical(value) -> str:
    """JSON in the published canonical form (RFC 8785): no blanks, keys by UTF-16 code units, only the needed escapes, numbers as JavaScript writes them.
    Whole numbers beyond 2^53 keep their digits. ValueError for what has no such form: infinite numbers and lone surrogates."""
    if value is None or isinstance(value, bool):
        return {None: "null", True: "true", False: "false"}[value]
    if isinstance(value, str):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, (int, float)):
        return _number(value)
    if isinstance(value, list):
        return f"[{','.join(map(canonical, value))}]"
    return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in sorted(value, key=lambda k: k.encode("utf-16-be"))) + "}"


def _parsed(text: str | None):
    """A JSON text's value; ValueError for null, broken JSON, not-a-number constants, numbers beyond a double, lone surrogates and repeated keys."""

    def once(pairs):
        out = dict(pairs)
        if len(out) < len(pairs):
            raise ValueError("repeated key")
        return out

    def refuse(name):
        raise ValueError(name)

    if text is None:
        raise ValueError("null")
    value = json.loads(text, object_pairs_hook=once, parse_constant=refuse)
    canonical(value).encode()
    return value


def _kept(rows: DataFrame, columns: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows, written aside with a number each and a digest of all columns, and the same without their texts."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    held = staged(rows.select(*columns, F.md5(F.concat_ws("\u001f", *parts).cast("binary")).alias("digest"), F.monotonically_increasing_id().alias("row")), name)
    return held, held.select(*[c for c in held.columns if c not in ("arguments", "content", "name")])


def _firsts(rows: DataFrame, *more: str) -> DataFrame:
    """The first row of each conversation and call id, by turn and then digest: columns c, i and first, a struct (turn, digest, row, more).  Ids are grouped by minima, not lists."""
    given = rows.filter("conv_id is not null and call_id is not null")
    return given.groupBy(F.col("conv_id").alias("c"), F.col("call_id").alias("i")).agg(F.min(F.struct("turn", "digest", "row", *more)).alias("first"))


def _parents(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, up): a call's known parents, each once. `after` is a call id or an array of them."""
    after = F.col("after") if isinstance(calls.schema["after"].dataType, T.ArrayType) else F.array("after")
    asked = calls.select("conv_id", "call_id", F.explode(after).alias("up")).filter("up is not null").distinct()
    known = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
    return asked.join(known, (F.col("conv_id") == F.col("c")) & (F.col("up") == F.col("i"))).select("conv_id", "call_id", "up")


def _anchored(calls: DataFrame, parents: DataFrame) -> DataFrame:
    """(conv_id, call_id, anchor, depth, parents): the call with no parent or several that a call leads back to over single parents, and the calls on the way; a null
    anchor for one that leads into a cycle of single parents.

    Pointers are doubled, so a chain of n calls takes about log2 n joins; each round is written to the shared folder. Pointers that outlast twice the longest
    possible chain never end.
    """
    spark = calls.sparkSession
    of = parents.groupBy("conv_id", "call_id").agg(F.count("*").alias("parents"), F.min("up").alias("up"))
    single = F.coalesce(F.col("parents") == 1, F.lit(False))
    state = calls.select("conv_id", "call_id").join(of, ["conv_id", "call_id"], "left").select(
        "conv_id", "call_id", F.when(single, F.col("up")).alias("up"), F.when(~single, F.col("call_id")).alias("anchor"), single.cast("long").alias("depth"), F.coalesce("parents", F.lit(0)).alias("parents"))
    path, span = None, 1
    longest = calls.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    while True:
        new_path = scratch_path(spark, "levels")
        state.write.parquet(new_path)
        state = spark.read.schema(state.schema).parquet(new_path)
        if path:
            remove_path(spark, path)
        path = new_path
        if span > 2 * longest or state.filter("up is not null").isEmpty():
            return state.select("conv_id", "call_id", "anchor", "depth", "parents")
        ended, going = state.filter("up is null"), state.filter("up is not null").alias("s")
        above = state.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("up").alias("up2"), F.col("anchor").alias("anchor2"), F.col("depth").alias("depth2"))
        moved = going.join(above, (F.col("s.conv_id") == F.col("c")) & (F.col("s.up") == F.col("i")))
        state = ended.union(moved.select("conv_id", "call_id", F.col("up2").alias("up"), F.col("anchor2").alias("anchor"), (F.col("depth") + F.col("depth2")).alias("depth"), "parents"))
        span *= 2


def dependency_levels(calls: DataFrame) -> DataFrame:
    """For different calls (conv_id, call_id, after): (conv_id, call_id, depth), the most calls one after the other that must come before it; null for a call on or
    behind a cycle. `after` is the id of a call or an array of such ids, in which nulls and repeats count for nothing.

    A call without a known parent has depth 0. Chains of single parents are followed by doubled pointers to where they begin; what is left is a graph of calls
    with several parents and weighted ways between them, whose depths are maxima over their parents', taken in rounds as soon as all parents have theirs. So
    rounds are as many as calls with several parents come after each other, and each is a join and a maximum, written to the shared folder.
    """
    parents = staged(_parents(calls), "parents")
    anchors = _anchored(calls, parents)
    at = anchors.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), "anchor", "depth")
    several = anchors.filter("parents > 1").select("conv_id", "call_id")
    ways = staged(parents.join(several, ["conv_id", "call_id"], "left_semi").join(at, (F.col("conv_id") == F.col("c")) & (F.col("up") == F.col("i"))).select(
        "conv_id", "call_id", "anchor", (F.col("depth") + 1).alias("way")), "ways")
    found = staged(anchors.filter("parents = 0").select(F.col("conv_id").alias("fc"), F.col("call_id").alias("fi"), F.lit(0).cast("long").alias("base")), "found")
    while not ways.isEmpty():
        met = ways.join(found, (F.col("conv_id") == F.col("fc")) & (F.col("anchor") == F.col("fi")), "left")
        done = staged(met.groupBy("conv_id", "call_id").agg(F.count_if(F.col("base").isNull()).alias("open"), F.max(F.col("way") + F.col("base")).alias("base")).filter("open = 0").select(
            F.col("conv_id").alias("fc"), F.col("call_id").alias("fi"), "base"), "done")
        if done.isEmpty():
            break
        found = staged(found.union(done), "found")
        ways = staged(ways.join(done, (F.col("conv_id") == F.col("fc")) & (F.col("call_id") == F.col("fi")), "left_anti"), "ways")
    told = anchors.join(found, (F.col("conv_id") == F.col("fc")) & (F.col("anchor") == F.col("fi")), "left")
    return told.select("conv_id", "call_id", (F.col("base") + F.col("depth")).alias("depth"))


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], messages: DataFrame | None = None) -> DataFrame:
    """One row per row of `calls` (conv_id, call_id, turn, name, arguments, after), `results` (conv_id, call_id, turn, content) and `messages`
    (conv_id, turn, role, content): conv_id, turn, kind ('call', 'result' or 'message'), call_id, level, problems (sorted texts), json.

    Calls and results are joined by conversation and call id; `after` is a call id or an array of call ids. By (level, turn) a conversation's rows are in topological order: a call's level is twice the
    most calls one after the other that it comes after along `after`, a result's one more than its call's; null where there is none. Problems of a call: `no id` (null
    conversation or call id), `repeated id` (all but the first by turn, then by a digest of the row), `unknown after` (one at least), `cycle` (on one or behind it), `no result`, `unknown tool`, `bad arguments` (no
    JSON object, a repeated key, a number beyond a double, a lone surrogate, or nested too deep; the text is kept as it came), and what breaks the tool's schema. Problems of a result: `no id`, `no call`, `repeated result`, `before its call`.
    Rows alike in all columns count as repeated, except one. Messages have no call id, level or problems. json is canonical and never null.
    """
    calls, call_keys = _kept(calls, ["conv_id", "call_id", "turn", "name", "arguments", "after"], "calls")
    results, result_keys = _kept(results, ["conv_id", "call_id", "turn", "content"], "results")
    first_calls = staged(_firsts(call_keys, "after"), "first_calls")
    depths = dependency_levels(first_calls.select(F.col("c").alias("conv_id"), F.col("i").alias("call_id"), F.col("first.after").alias("after")))
    levels = first_calls.join(depths, (F.col("c") == F.col("conv_id")) & (F.col("i") == F.col("call_id"))).select("c", "i", F.col("first.row").alias("first_row"), F.col("first.turn").alias("call_turn"), "depth")
    levels = staged(levels, "call_levels")
    answers = staged(_firsts(result_keys).select(F.col("c").alias("rc"), F.col("i").alias("ri"), F.col("first.row").alias("answer_row")), "answers")
    # calls that name an unknown one
    after = F.col("after") if isinstance(call_keys.schema["after"].dataType, T.ArrayType) else F.array("after")
    named = call_keys.select("conv_id", F.col("row").alias("unknown_row"), F.explode(after).alias("named")).filter("named is not null")
    lost = named.join(levels.select("c", "i"), (F.col("conv_id") == F.col("c")) & (F.col("named") == F.col("i")), "left_anti").select("unknown_row").distinct()
    no_id = F.col("conv_id").isNull() | F.col("call_id").isNull()
    own, answered = (F.col("conv_id") == F.col("c")) & (F.col("call_id") == F.col("i")), (F.col("conv_id") == F.col("rc")) & (F.col("call_id") == F.col("ri"))

    def problems(*found: tuple[Column, str]) -> Column:
        return F.array_compact(F.array(*(F.when(c, F.lit(p)) for c, p in found))).alias("problems")

    # what is known of a row is found by its keys alone; texts move once, to meet it
    call_first, result_first = F.coalesce(F.col("row") == F.col("first_row"), F.lit(False)), F.coalesce(F.col("row") == F.col("answer_row"), F.lit(False))
    told = call_keys.join(levels, own, "left").join(answers, answered, "left").join(lost, F.col("row") == F.col("unknown_row"), "left")
    told = told.select("row", F.when(call_first, F.col("depth") * 2).alias("level"), problems(
        (no_id, "no id"), (~no_id & ~call_first, "repeated id"), (F.col("unknown_row").isNotNull(), "unknown after"),
        (call_first & F.col("depth").isNull(), "cycle"), (F.col("ri").isNull(), "no result"),
    ))
    heard = result_keys.join(levels, own, "left").join(answers, answered, "left")
    heard = heard.select("row", F.when(result_first, F.col("depth") * 2 + 1).alias("level"), problems(
        (no_id, "no id"), (~no_id & F.col("i").isNull(), "no call"), (~no_id & ~result_first, "repeated result"), (F.col("turn") < F.col("call_turn"), "before its call"),
    ))
    said = calls.join(told, "row").select("conv_id", "turn", F.lit("call").alias("kind"), "call_id", "level", "problems", "name", F.col("arguments").alias("body"))
    got = results.join(heard, "row").select("conv_id", "turn", F.lit("result").alias("kind"), "call_id", "level", "problems", F.lit(None).cast("string").alias("name"), F.col("content").alias("body"))
    rows = said.union(got)
    if messages is not None:
        plain = F.lit(None).cast("string")
        rows = rows.union(messages.select("conv_id", "turn", F.lit("message").alias("kind"), plain.alias("call_id"), F.lit(None).cast("long").alias("level"), F.array().cast("array<string>").alias("problems"), F.col("role").alias("name"), F.col("content").alias("body")))
    return _written(rows, schemas)


def _written(rows: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Checks arguments and writes each row as canonical JSON. A schema that can't be checked is refused before the job."""
    for schema in schemas.values():
        check_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, texts = [], []
            for kind, call_id, problems, name, body in zip(*(b.column(c).to_pylist() for c in ("kind", "call_id", "problems", "name", "body"))):
                if kind == "result":
                    texts.append(canonical({"content": body, "role": "tool", "tool_call_id": call_id}))
                elif kind == "message":
                    texts.append(canonical({"content": body, "role": name}))
                else:
                    try:
                        arguments = _parsed(body)
                        if not isinstance(arguments, dict):
                            raise ValueError("no object")
                        broken = schema_errors(arguments, schemas[name]) if name in schemas else ["unknown tool"]
                        text = canonical({"arguments": arguments, "id": call_id, "name": name, "role": "assistant"})
                    except (ValueError, RecursionError):
                        # the raw text is kept as it came
                        broken = ["bad arguments"] + ["unknown tool"] * (name not in schemas)
                        text = canonical({"arguments": body, "id": call_id, "name": name, "role": "assistant"})
                    problems = problems + broken
                    texts.append(text)
                found.append(sorted(problems))
            keep = [b.column(i) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(found, pa.list_(pa.string())), pa.array(texts, pa.string())], names=["conv_id", "turn", "kind", "call_id", "level", "problems", "json"])

    rows = rows.select("conv_id", "turn", "kind", "call_id", "level", "problems", "name", "body")
    return rows.mapInArrow(run, rows.drop("problems", "name", "body").withColumns({"problems": F.array(F.lit("")), "json": F.lit("")}).schema)


#: Tools of the query.
SCHEMAS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1, "maxLength": 80}, "limit": {"type": "integer", "minimum": 1, "maximum": 150}}},
    "translate": {"type": "object", "required": ["text", "target"], "properties": {"text": {"type": "string"}, "target": {"type": "string", "enum": ["de", "en", "es", "fr"]}}},
}


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and messages made of conversation turns: every turn of an assistant is a call after that of two turns before, every user's turn but a first
    one answers the turn before it, and all else is a message. Odd calls search for the text's first words, with its number of words as the limit; even ones translate the text."""
    text, n = F.coalesce("text", F.lit("")), F.col("turn")
    words = F.split(F.trim(text), r"\s+")
    search = F.to_json(F.struct(F.size(words).alias("limit"), F.array_join(F.slice(words, 1, 6), " ").alias("query")))
    target = F.element_at(F.array(*map(F.lit, ("de", "en", "es", "fr", "xx"))), F.pmod(F.length(text), F.lit(5)) + 1)
    translate = F.to_json(F.struct(text.alias("text"), target.alias("target")))
    odd = F.pmod(F.size(words), F.lit(2)) == 1

    def identifier(turn: Column) -> Column:
        return F.concat(F.lit("call_"), turn)

    calls = turns.filter("role = 'assistant'").select("conv_id", identifier(n).alias("call_id"), n.alias("turn"), F.when(odd, F.lit("search")).otherwise(F.lit("translate")).alias("name"),
                                                      F.when(odd, search).otherwise(translate).alias("arguments"), F.when(n >= 2, identifier(n - 2)).alias("after"))
    answers = F.coalesce((F.col("role") == "user") & (n >= 1), F.lit(False))
    messages = turns.filter(~answers & ~F.coalesce(F.col("role") == "assistant", F.lit(False))).select("conv_id", "turn", "role", F.col("text").alias("content"))
    results = turns.filter(answers).select("conv_id", identifier(n - 1).alias("call_id"), n.alias("turn"), F.col("text").alias("content"))
    return calls, results, messages


def digest(turns: DataFrame) -> DataFrame:
    """conv_id, turn, kind, call_id, level, problems, json."""
    calls, results, messages = from_conversations(turns)
    rows = linked(calls, results, SCHEMAS, messages)
    return rows.withColumn("problems", F.array_join("problems", "|"))
