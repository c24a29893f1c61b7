"""Tool calls with several parents, schemas in full, and arguments that must not end the job."""

import json
import random

import pytest

from pitwall.llm.chat_tools import SCHEMAS, canonical, check_schema, dependency_levels, linked, schema_errors

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, after array<string>"
RESULTS = "conv_id long, call_id string, turn long, content string"


def depths(rows):
    """By recursion over all parents; None on or behind a cycle."""
    known = {(c, i) for c, i, _ in rows}
    up = {(c, i): {(c, a) for a in after or [] if a is not None and (c, a) in known} for c, i, after in rows}
    found = {}
    while True:
        ready = [k for k in up if k not in found and all(p in found for p in up[k])]
        if not ready:
            return {k: found.get(k) for k in up}
        for k in ready:
            found[k] = max((found[p] + 1 for p in up[k]), default=0)


@pytest.mark.parametrize("seed", range(3))
def test_levels_are_longest_paths(spark, seed):
    rng, rows = random.Random(seed), []
    for conv in range(6):
        n = rng.choice([1, 5, 12])
        for i in range(n):
            back = [f"c{rng.randrange(n) if rng.random() < 0.08 else rng.randrange(i + 1)}" for _ in range(rng.choice([0, 1, 1, 2, 3]))] if i else []
            rows.append((conv, f"c{i}", [*back, *rng.choice([[], [None], ["zzz"], back[:1]])] if rng.random() < 0.9 else None))
    rows += [(90, f"c{i}", [f"c{i - 1}"] if i else []) for i in range(60)] + [(90, "end", ["c59", "c7", "side"]), (90, "side", ["c20"]), (90, "after", ["end"])]
    got = {(r.conv_id, r.call_id): r.depth for r in dependency_levels(spark.createDataFrame(rows, "conv_id long, call_id string, after array<string>")).collect()}
    assert got == depths(rows)
    assert (got[90, "end"], got[90, "after"]) == (60, 61)


def test_calls_after_several_calls(spark):
    args = '{"query":"a","limit":3}'
    calls = [(1, "a", 0, "search", args, None), (1, "b", 1, "search", args, []), (1, "c", 2, "search", args, ["a", "b"]), (1, "d", 3, "search", args, ["c", "a", "x"]), (1, "e", 4, "search", args, ["e", "a"])]
    got = linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame([(1, i, 9, "r") for i in "abcde"], RESULTS), SCHEMAS).collect()
    assert {r.call_id: (r.level, list(r.problems)) for r in got if r.kind == "call"} == {"a": (0, []), "b": (0, []), "c": (2, []), "d": (4, ["unknown after"]), "e": (None, ["cycle"])}
    assert {r.call_id: r.level for r in got if r.kind == "result"} == {"a": 1, "b": 1, "c": 3, "d": 5, "e": None}


ODD = ['{"query":"q","limit":1e400}', '{"query":"\\ud800","limit":1}', '{"\\udfff":1}', "[" * 2000 + "]" * 2000, '{"query":' + "[" * 2000 + "]" * 2000 + "}", '{"limit":-Infinity}', '{"limit":' + "9" * 5000 + "}", "\u0000", "{}x", '{"a":1}'[:3]]


def test_odd_arguments_are_told_and_kept(spark):
    calls = [(1, f"c{i}", i, "search", a, None) for i, a in enumerate(ODD)]
    got = {r.call_id: r for r in linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), SCHEMAS).collect()}
    for i, a in enumerate(ODD):
        assert "bad arguments" in got[f"c{i}"].problems
        assert json.loads(got[f"c{i}"].json)["arguments"] == a


@pytest.mark.parametrize("schema, good, bad", [
    ({"anyOf": [{"type": "string"}, {"minimum": 3, "type": "number"}]}, ["x", 3], [2, None]),
    ({"oneOf": [{"multipleOf": 2}, {"multipleOf": 3}]}, [4, 9], [6, 7]),
    ({"allOf": [{"minimum": 1}, {"maximum": 2}]}, [1, 2], [0, 3]),
    ({"not": {"type": "null"}}, [0], [None]),
    ({"if": {"type": "string"}, "then": {"minLength": 2}, "else": {"const": 1}}, ["ab", 1, 1.0], ["a", 2, True]),
    ({"enum": [1, "a", [1, {"b": 2}]]}, [1, 1.0, [1.0, {"b": 2}]], [True, "1", [1]]),
    ({"exclusiveMinimum": 1, "exclusiveMaximum": 2}, [1.5], [1, 2]),
    ({"multipleOf": 0.1}, [0.3, 1], [0.25]),
    ({"minItems": 1, "maxItems": 2, "uniqueItems": True}, [[1], [1, "1"], [1, True]], [[], [1, 1.0], [1, 2, 3]]),
    ({"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, [["a", 1], []], [[1], ["a", "b"]]),
    ({"contains": {"const": 1}, "maxContains": 2}, [[0, 1], [1, 1]], [[0], [1, 1, 1]]),
    ({"properties": {"a": {}}, "additionalProperties": {"type": "string"}}, [{"a": 1, "b": "x"}], [{"b": 1}]),
    ({"patternProperties": {"^x": {"type": "null"}}, "additionalProperties": False}, [{"xy": None}], [{"xy": 1}, {"y": None}]),
    ({"propertyNames": {"maxLength": 2}, "minProperties": 1, "maxProperties": 2}, [{"ab": 1}], [{}, {"abc": 1}, {"a": 1, "b": 1, "c": 1}]),
    ({"dependentRequired": {"a": ["b"]}}, [{"a": 1, "b": 1}, {"b": 1}], [{"a": 1}]),
    ({"$ref": "#/$defs/tree", "$defs": {"tree": {"type": "object", "properties": {"kids": {"type": "array", "items": {"$ref": "#/$defs/tree"}}}}}}, [{"kids": [{"kids": []}]}], [{"kids": [{"kids": [1]}]}]),
    (True, [1], []), (False, [], [1]),
])
def test_schema_words(schema, good, bad):
    check_schema(schema)
    assert [v for v in good if schema_errors(v, schema)] == []
    assert [v for v in bad if not schema_errors(v, schema)] == []


@pytest.mark.parametrize("schema", [{"type": "text"}, {"properties": {"a": {"typ": "string"}}}, {"pattern": "("}, {"$ref": "other.json"}, {"$ref": "#/$defs/x"}, {"$ref": "#"}, {"items": 3}, {"anyOf": [{"minimumm": 1}]}])
def test_schemas_that_cannot_be_checked_are_refused_before_the_job(spark, schema):
    with pytest.raises(ValueError):
        linked(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), {"search": schema})


def test_numbers_as_published():
    for value, text in ((1e-7, "1e-7"), (1.5e-10, "1.5e-10"), (1e21, "1e+21"), (1e20, "100000000000000000000"), (0.000001, "0.000001"), (333333333.33333329, "333333333.3333333"), (-0.0, "0"), (4.5, "4.5"), (2e-3, "0.002"), (1 << 60, str(1 << 60))):
        assert canonical(value) == text
    # keys by UTF-16: a character beyond the first plane before U+FB33
    assert canonical({"\ufb33": 1, "\U0001f600": 2, "é": 3, "\n": 4}) == '{"\\n":4,"é":3,"\U0001f600":2,"\ufb33":1}'
