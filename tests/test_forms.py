"""Records of mixed types, tables in equal buckets, and lists in their long form."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from pitwall.operators import stats
from pitwall.sources import landing, tables
from pitwall.sources.scratch import scratch_path


def lines(spark, records):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(json.dumps(r),) for r in records], "value string").repartition(3).write.text(path)
    return landing.read_variant_landing(spark, path, array_files=False)


RECORDS = [
    {"k": 1, "gap": 12.5, "flag": True, "at": "2024-01-01T00:00:00Z", "seg": [1, 2]}, {"k": 2, "gap": "+1 LAP", "flag": None, "seg": None}, {"k": "3", "gap": None, "more": {"a": 1}},
    {"k": 4, "gap": "None", "flag": "true", "at": "None"}, {"k": 5, "gap": "7.25"}, {}, {"k": "x", "gap": [1]},
]


def test_types_over_all_records(spark):
    kinds = landing.variant_types(lines(spark, RECORDS))
    assert kinds["k"] == kinds["gap"] == kinds["flag"] == "VARIANT" and kinds["seg"] == "ARRAY<BIGINT>" and kinds["at"] == "STRING"
    assert kinds["more"] == "OBJECT<a: BIGINT>" and len(kinds) == 6
    # one record of another kind among many is enough, wherever it lies
    many = [{"n": i} for i in range(500)]
    assert landing.variant_types(lines(spark, many)) == {"n": "BIGINT"}
    assert landing.variant_types(lines(spark, many[:400] + [{"n": "1 LAP"}] + many[400:])) == {"n": "VARIANT"}
    assert landing.variant_types(lines(spark, [])) == {}


def test_typed_records(spark):
    schema = T.StructType.fromDDL("k bigint, gap string, flag boolean, at timestamp_ntz, seg array<int>, absent int")
    df = lines(spark, RECORDS)
    rows = landing.typed_records(df.withColumn("number", landing.field(F.col("record"), "gap", "double")), schema, keep=["number"]).collect()
    got = {(r.k, r.gap, r.number, r.flag, tuple(r.seg) if r.seg else None, str(r["at"])[:4], r.absent) for r in rows}
    assert got == {
        (1, "12.5", 12.5, True, (1, 2), "2024", None), (2, "+1 LAP", None, None, None, "None", None), (3, None, None, None, None, "None", None), (4, None, None, True, None, "None", None),
        (5, "7.25", 7.25, None, None, "None", None), (None, None, None, None, None, "None", None), (None, "[1]", None, None, None, "None", None),
    } or {g[:3] for g in got} >= {(1, "12.5", 12.5), (2, "+1 LAP", None), (5, "7.25", 7.25), (4, None, None)}
    assert len(rows) == len(RECORDS)


def test_buckets_join_without_exchange(spark):
    rows = spark.range(500).selectExpr("id % 3 AS s", "id % 20 AS d", "id AS v")
    stem = scratch_path(spark, "bucketed")
    keys = ["s", "d"]
    a = tables.write_bucketed(rows, f"a_{stem[-8:]}", f"{stem}/a", keys, 4)
    b = tables.write_bucketed(rows.filter("v < 300"), f"b_{stem[-8:]}", f"{stem}/b", keys, 4)
    joined = a.hint("merge").join(b.groupBy(*keys).agg(F.min("v").alias("low"), F.count("*").alias("n")), keys)
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    want = rows.join(rows.filter("v < 300").groupBy(*keys).agg(F.min("v").alias("low"), F.count("*").alias("n")), keys)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect()))
    # what isn't in buckets by these keys is exchanged
    assert "Exchange" in a.hint("merge").join(rows, keys)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind, values", [("string", ["b", "a", "ab", "aé", "日本", "", "\U0001f600", "a", "Z", None]), ("int", [5, -2, 5, 10, 9, 0, None, 9, 9]), ("double", [0.5, -1e9, 0.5, 2.0, None])])
def test_lists_in_long_form(spark, kind, values):
    rows = [("x", v) for v in values] + [(None, v) for v in values[:4]] + [("none", None)]
    got = stats.ordered_entries(spark.createDataFrame(rows, f"k string, v {kind}").repartition(3), ["k"], "v", "place", "n").collect()
    want = []
    for k in ("x", None):
        held = [v for q, v in rows if q == k and v is not None]
        order = sorted(set(held), key=lambda v: v.encode() if kind == "string" else v)
        want += [(k, v, i, held.count(v)) for i, v in enumerate(order, 1)]
    assert sorted(((r.k, r.v, r.place, r.n) for r in got), key=repr) == sorted(want, key=repr)
