import random

import pytest
from pyspark.sql import functions as F

from pitwall.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, position string, t int"


def rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = rng.choice(["hot"] * 4 + ["a", "b", "c", "d", None, "É"])
        out.append((i, rng.choice([" ", "\n", "\x0b"]).join(["w"] * rng.choice([0, 1, 5, 60])), None, source, None, "clash", 1))
    return [*out, (n, None, None, "a", None, None, None), (n + 1, "one", None, "tiny", None, None, None), (n + 2, "", None, "empty", None, None, None)]


def water_fill(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        share = {s: 2 * sizes[s] if s in full else weight[s] * rest / sum(weight[x] for x in sizes if x not in full) for s in sizes}
        above = {s for s in sizes if share[s] > 2 * sizes[s]}
        if not above:
            return share
        full |= above


def test_targets_and_copies(spark):
    data = rows(1500)
    got = mixing.mixed(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)
    sizes = {}
    for r in data:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want = water_fill(sizes)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(want[s]) for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= max(r.size for r in mine) / 2 + 1e-6
    assert all(r.taken == r.size * r.copies and r.copies <= 2 and (r.position is None) == (r.copies == 0) for r in got)
    assert all(0 <= r.position <= 1 for r in got if r.copies)


def test_reruns_agree_whatever_the_partitioning_and_buckets(spark, monkeypatch):
    df = spark.createDataFrame(rows(600), SCHEMA)
    first = sorted(map(tuple, mixing.mixed(df).collect()), key=repr)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    assert sorted(map(tuple, mixing.mixed(df.repartition(7)).collect()), key=repr) == first


def test_schedule_inverse(spark):
    s = mixing.Schedule(((0.0, 0.0), (0.25, 4.0), (0.5, 0.0), (1.0, 1.0)))
    got = spark.range(101).select((F.col("id") / 100).alias("x"), s.time_of(F.col("id") / 100).alias("t")).collect()
    for r in got:
        area, done = 0.0, 0.0
        for (t0, w0), (t1, w1) in zip(s.knots, s.knots[1:]):
            x = min(max(r.t - t0, 0), t1 - t0)
            area += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        assert area == pytest.approx(r.x * s.total(), abs=1e-9)


def test_training_order(spark):
    data = rows(400)
    data += [data[5], data[5], (None, "a b c", "l", "a", 1, "x", 2), (None, "a b c", "m", "a", 1, "x", 2)]
    for part in (data[:400], data):
        df = spark.createDataFrame(part, SCHEMA)
        plan = mixing.mixed(df).collect()
        got = mixing.in_training_order(df)
        assert got.columns == df.columns
        out = got.collect()
        assert len(out) == sum(r.copies for r in plan)
        assert {tuple(r) for r in out} <= set(part)
        count = {}
        for r in out:
            count[(r.doc_id, r.source)] = count.get((r.doc_id, r.source), 0) + 1
        want = {}
        for r in plan:
            if r.copies:
                want[(r.doc_id, r.source)] = want.get((r.doc_id, r.source), 0) + r.copies
        assert count == want
    at = {r.doc_id: r.position for r in mixing.mixed(spark.createDataFrame(data[:400], SCHEMA)).collect()}
    seen, firsts = set(), []
    for r in mixing.in_training_order(spark.createDataFrame(data[:400], SCHEMA)).collect():
        if r.doc_id not in seen:
            seen.add(r.doc_id)
            firsts.append(at[r.doc_id])
    assert firsts == sorted(firsts)


def test_query_reads_the_mix_in_training_order(spark, monkeypatch):
    """What the query tells of a row is what the sorted mix holds of it, rows with repeated or null ids too."""
    data = rows(300)
    for part in (data, [*data, data[5], data[5], (None, "a b c", "l", "a", 1, "x", 2), (None, "a b c", "m", "a", 1, "x", 2), (7, "other text", "m", "b", 1, "x", 2)]):
        df = spark.createDataFrame(part, SCHEMA)
        plan = mixing.mixed(df).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long"), "copies", F.round("position", 9)).collect()
        assert sorted(map(tuple, mixing.digest(df).collect()), key=repr) == sorted(map(tuple, plan), key=repr)
    ordered = mixing._ordered

    def without_one(*args):
        plan, mix, of, at = ordered(*args)
        return plan, mix.filter("doc_id <> 5"), of, at

    assert [r.copies for r in plan if r.doc_id == 5] != [0]
    monkeypatch.setattr(mixing, "_ordered", without_one)
    got = mixing.digest(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data) and [(r.taken, r.copies, r.position) for r in got if r.doc_id == 5] == [(0, 0, None)]


def test_falling_weight_comes_early(spark):
    df = spark.createDataFrame([(i, "w w w", None, "abc"[i % 3], None, None, None) for i in range(900)], SCHEMA)
    mean = {r.source: r.m for r in mixing.mixed(df).filter("copies > 0").groupBy("source").agg(F.avg("position").alias("m")).collect()}
    assert mean["a"] < mean["c"]


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed(df).count() == 0 and mixing.in_training_order(df).count() == 0
    blank = spark.createDataFrame([(1, "", None, "a", 0, None, None), (2, None, None, None, 0, None, None)], SCHEMA)
    assert [(r.size, r.target, r.copies) for r in mixing.mixed(blank).collect()] == [(0, 0.0, 0)] * 2
