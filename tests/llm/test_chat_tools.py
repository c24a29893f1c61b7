import hashlib
import json
import random

import pytest

from pitwall.llm.chat_tools import SCHEMAS, _parsed, canonical, dependency_levels, digest, from_conversations, linked, schema_errors

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, after string, c string, i string"
RESULTS = "conv_id long, call_id string, turn long, content string, least int"


def test_canonical_json():
    assert canonical({"b": 1.0, "a": [True, None, "é\n\"/"], "Z": {"y": 0.1, "x": -2}}) == '{"Z":{"x":-2,"y":0.1},"a":[true,null,"é\\n\\"/"],"b":1}'
    for bad in (None, "", "{", '{"a":1,"a":2}', '{"a":NaN}', "[1,]"):
        with pytest.raises(ValueError):
            _parsed(bad)


def test_schema_errors():
    s = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": ["integer", "null"], "minimum": 1}, "b": {"type": "array", "items": {"enum": ["x"]}}, "c": {"type": "string", "pattern": "^q", "maxLength": 2}}}
    assert schema_errors({"a": 1, "b": ["x"], "c": "q"}, s) == [] == schema_errors({"a": None}, s)
    assert schema_errors({"a": True}, s) == [".a: not integer or null"] and schema_errors([], s) == [".: not object"]
    assert schema_errors({"a": 0, "b": ["x", "y"], "c": "zzz", "d": 1}, s) == [".a: out of range", ".b[1]: not allowed", ".c: length 3", ".c: pattern", ".d: unknown"]
    assert schema_errors({}, s) == [".a: missing"] and schema_errors({"a": 2.0}, s) == []


def brute(calls, results):
    """By hand: (conv, turn, kind, call_id, level, problems) of each row."""
    def key(row):
        digest = hashlib.md5("\x1f".join("\x00" if v is None else str(v) for v in row).encode()).hexdigest()
        return row[2] is not None, row[2], digest

    first, answer = {}, {}
    for rows, n, found in ((calls, 6, first), (results, 4, answer)):
        for i, r in enumerate(rows):
            if r[0] is not None and r[1] is not None and (r[:2] not in found or key(r[:n]) < key(rows[found[r[:2]]][:n])):
                found[r[:2]] = i

    def depth(k):
        n, seen = 0, set()
        while True:
            if k in seen:
                return None
            seen.add(k)
            up = (k[0], calls[first[k]][5])
            if up[1] is None or up not in first:
                return n
            k, n = up, n + 1

    out = []
    for i, c in enumerate(calls):
        conv, cid, turn, name, args, after = c[:6]
        no_id, mine = conv is None or cid is None, first.get((conv, cid)) == i
        level = depth((conv, cid)) if mine else None
        p = ["no id"] * no_id + ["repeated id"] * (not no_id and not mine) + ["unknown after"] * (after is not None and (conv, after) not in first) + ["cycle"] * (mine and level is None) + ["no result"] * ((conv, cid) not in answer)
        try:
            value = _parsed(args)
            p += ["bad arguments"] * (not isinstance(value, dict))
            p += ["unknown tool"] if name not in SCHEMAS else schema_errors(value, SCHEMAS[name]) if isinstance(value, dict) else []
        except ValueError:
            value = args
            p += ["bad arguments"] + ["unknown tool"] * (name not in SCHEMAS)
        value = value if isinstance(value, dict) else args
        out.append((conv, turn, "call", cid, None if level is None else 2 * level, sorted(p), canonical({"arguments": value, "id": cid, "name": name, "role": "assistant"})))
    for i, (conv, cid, turn, content, *_) in enumerate(results):
        no_id, mine, call = conv is None or cid is None, answer.get((conv, cid)) == i, first.get((conv, cid))
        level = depth((conv, cid)) if mine and call is not None else None
        p = ["no id"] * no_id + ["no call"] * (not no_id and call is None) + ["repeated result"] * (not no_id and not mine)
        p += ["before its call"] * (call is not None and turn is not None and calls[call][2] is not None and turn < calls[call][2])
        out.append((conv, turn, "result", cid, None if level is None else 2 * level + 1, sorted(p), canonical({"content": content, "role": "tool", "tool_call_id": cid})))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rng, calls, results = random.Random(4), [], []
    args = ['{"query":"a","limit":3}', '{ "limit": 900, "query": "" }', '{"text":"é","target":"fr","more":[1.0,{"b":1,"a":2}]}', "{broken", None, "[]", '{"limit":1,"limit":2,"query":"x"}']
    for conv in [*range(12), None]:
        n = rng.choice([1, 4, 9])
        for t in range(n):
            after = None if rng.random() < 0.3 else f"k{rng.randrange(n + 1)}"
            calls.append((conv, rng.choice([f"k{t}", f"k{t}", "k0", None]) if rng.random() < 0.4 else f"k{t}", rng.choice([t * 3, None]) if rng.random() < 0.1 else t * 3, rng.choice(["search", "translate", "none", None]), rng.choice(args), after, "x", "y"))
            for _ in range(rng.choice([0, 1, 1, 1, 2])):
                results.append((conv, rng.choice([f"k{t}", f"k{t}", f"k{t}", "lost", None]), rng.randint(0, 3 * n), rng.choice([None, "", "done", "größe\n"]), 1))
    calls += [calls[3], calls[3]]
    results += [results[0], results[0], (5, "lost", 1, "long " * 40_000, 1)]
    got = linked(spark.createDataFrame(calls, CALLS).repartition(3), spark.createDataFrame(results, RESULTS), SCHEMAS)
    assert got.columns == ["conv_id", "turn", "kind", "call_id", "level", "problems", "json"]
    assert sorted(((*tuple(r)[:5], list(r.problems), r.json) for r in got.collect()), key=repr) == brute(calls, results)


def test_long_chains_and_cycles(spark):
    rows = [(1, f"c{i}", f"c{i - 1}" if i else None) for i in range(500)] + [(2, "a", "b"), (2, "b", "a"), (2, "c", "a"), (2, "d", "zzz"), (2, "e", "e"), (3, "a", None)]
    got = {(r.conv_id, r.call_id): r.depth for r in dependency_levels(spark.createDataFrame(rows, "conv_id long, call_id string, after string")).collect()}
    assert got == {**{(1, f"c{i}"): i for i in range(500)}, (2, "a"): None, (2, "b"): None, (2, "c"): None, (2, "d"): 0, (2, "e"): None, (3, "a"): 0}


def test_conversations(spark, data):
    turns = spark.read.parquet(f"{data}/conversations.parquet")
    calls, results, messages = (df.collect() for df in from_conversations(turns))
    want = brute([tuple(r) for r in calls], [tuple(r) for r in results])
    want += [(r.conv_id, r.turn, "message", None, None, [], canonical({"content": r.content, "role": r.role})) for r in messages]
    got = digest(turns).collect()
    assert len(got) == turns.count()
    assert sorted(((*tuple(r)[:5], r.problems, r.json) for r in got), key=repr) == sorted(((*w[:5], "|".join(w[5]), w[6]) for w in want), key=repr)
    assert all(canonical(json.loads(r.json)) == r.json for r in got)
    assert any(not r.problems for r in got if r.kind == "call")


def test_empty_and_null_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert digest(spark.createDataFrame([], schema)).count() == 0
    got = digest(spark.createDataFrame([(None, 1, "assistant", "x"), (1, None, "assistant", None), (1, 1, None, "x"), (1, 2, "user", None)], schema)).collect()
    assert sorted((r.kind, r.problems) for r in got) == [("call", ".query: length 0|no id|no result"), ("call", "no id|no result"), ("message", ""), ("result", "no call")]
