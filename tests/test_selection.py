"""Selection, distinct counts and rank buckets against brute force, with groups that hold most rows."""

import datetime as dt
import math
import random
import statistics
from pathlib import Path

import pytest
from pyspark.sql import Window, functions as F

from pitwall.operators import ordered, stats

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def numbers(spark):
    """Groups of one row, of equal rows, of negative, tiny and huge values, and a NULL group with two thirds of all rows."""
    rng, rows = random.Random(5), []
    for _ in range(900):
        k = rng.choice([None, None, "a", "b"])
        v = rng.choice([None, 0.0, rng.uniform(-5, 5), rng.uniform(60, 62), 1e-300, -1e12, 1e12 * rng.random(), rng.choice([1.5, 2.5])])
        rows.append((k, v))
    rows += [("one", 7.0), ("same", 3.0), ("same", 3.0), ("none", None)]
    return rows, spark.createDataFrame(rows, "k string, v double").repartition(5).cache()


def groups(rows):
    out = {}
    for k, v in rows:
        if v is not None:
            out.setdefault(k, []).append(v)
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("rounds, cells", [(1, 4), (2, 3), (2, 1024), (3, 8)])
def test_values_at_places(numbers, monkeypatch, rounds, cells):
    monkeypatch.setattr(stats, "CELLS", cells)
    rows, df = numbers
    ranks = {"first": lambda n: n * 0, "third": lambda n: F.floor(n / 3), "last": lambda n: n - 1}
    got = {r.k: (r.first, r.third, r.last) for r in stats.values_at(df, ["k"], "v", ranks, rounds).collect()}
    assert got == {k: (v[0], v[len(v) // 3], v[-1]) for k, v in groups(rows).items()}


def test_values_that_are_not_finite(spark):
    values = [math.nan, math.inf, -math.inf, -math.inf, 1.0, 2.0, math.nan, 3.0]
    df = spark.createDataFrame([(1, v) for v in values] + [(2, math.nan), (3, math.inf), (3, -math.inf)], "k int, v double")
    order = [-math.inf, -math.inf, 1.0, 2.0, 3.0, math.inf, math.nan, math.nan]
    for i, want in enumerate(order):
        got = {r.k: r.x for r in stats.values_at(df.filter("k = 1"), ["k"], "v", {"x": lambda n, i=i: n * 0 + i}).collect()}
        assert repr(got[1]) == repr(want)
    ends = {r.k: (repr(r.a), repr(r.b)) for r in stats.values_at(df, ["k"], "v", {"a": lambda n: n * 0, "b": lambda n: n - 1}).collect()}
    assert ends == {1: ("-inf", "nan"), 2: ("nan", "nan"), 3: ("-inf", "inf")}


def test_medians_and_quantiles(numbers):
    rows, df = numbers
    want = groups(rows)
    got = {r.k: r.m for r in stats.exact_median(df, ["k"], "v", "m").collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(statistics.median(v), rel=1e-12) for k, v in want.items())
    shares = {"p10": 0.1, "p50": 0.5, "p100": 1.0, "p0": 0.0}
    told = {r.k: r for r in stats.exact_quantiles(df, ["k"], "v", shares).collect()}
    expected = {r.k: r for r in df.groupBy("k").agg(*[F.expr(f"percentile(v, {s})").alias(n) for n, s in shares.items()]).collect() if r.p50 is not None}
    assert set(told) == set(expected)
    for k, r in told.items():
        assert [r[n] for n in shares] == pytest.approx([expected[k][n] for n in shares], rel=1e-12)


def test_no_group_of_values_in_one_value():
    plans = Path(ordered.__file__).parent.parent / "plans"
    assert not any("F.median(" in f.read_text() or "percentile(" in f.read_text() for f in plans.glob("*.py"))


def test_distinct_counts(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2]), rng.choice([None, rng.randrange(-50, 50), rng.randrange(10**6)]), rng.randrange(5), None if i % 3 else 9) for i in range(800)]
    rows += [(7, None, 1, None), (8, 0, 0, 0), (8, -1, 0, 1), (8, 1, 0, 32768), (8, -32768, 0, 32769), (8, 1 << 40, 0, -32769)]
    df = spark.createDataFrame(rows, "k int, a long, b int, c int").repartition(4)
    counted = stats.distinct_counts(df, ["k"], {"na": "a", "nb": "b", "nc": "c"})
    got = {r.k: (r.na, r.nb, r.nc) for r in counted.collect()}
    want = {k: tuple(len({r[i] for r in rows if r[0] == k and r[i] is not None}) for i in (1, 2, 3)) for k in {r[0] for r in rows}}
    assert got == want
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_distinct_counts_hold_no_combinations(spark):
    """Three columns of unrelated values: a task keeps words of each, not bitmaps of every combination that its rows touch."""
    columns = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1 << 20)).alias(c) for i, c in enumerate("abc")]
    df = spark.range(0, 4000, 1, 4).select(F.lit(1).alias("k"), *columns)
    counted = stats.distinct_counts(df, ["k"], {"na": "a", "nb": "b", "nc": "c"})
    rows = df.collect()
    assert [tuple(r) for r in counted.collect()] == [(1, *(len({r[c] for r in rows}) for c in "abc"))]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    # longs in a hash map; no bitmaps of kilobytes, sorted
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "partial_bit_or" in plan


@pytest.fixture(scope="module")
def crowd(spark):
    """One session has nearly all events, all of them within an hour; another has a few days of them."""
    rng = random.Random(9)
    rows = [(i, 1, START + dt.timedelta(microseconds=rng.randrange(3_600_000_000)), rng.choice([None, float(i)])) for i in range(3000)]
    rows += [(5000 + i, 2, START + dt.timedelta(hours=i), float(i)) for i in range(60)] + [(6000, 3, START, 1.0), (6001, 1, None, 2.0)]
    # many events at one time
    rows += [(7000 + i, 1, START + dt.timedelta(minutes=30), float(i)) for i in range(40)]
    return spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz, v double").repartition(6).cache()


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_buckets_hold_equal_rows(crowd):
    got = ordered.ranked(crowd, ["k"], "ts", rows=100)
    sizes = sorted(r["count"] for r in got.filter("k = 1").groupBy(ordered.RANK).count().collect())
    assert len(sizes) > 25 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    assert got.filter("k <> 1").select(ordered.RANK).distinct().collect()[0][0] == 0 and got.count() == crowd.count()
    # hour spans would have put all of it in one
    assert crowd.filter("k = 1").select(ordered.time_bucket(F.col("ts"))).distinct().count() == 2


@pytest.mark.parametrize("rows", [7, 100, 10**6])
def test_scans_over_rank_buckets(crowd, rows):
    w = Window.partitionBy("k").orderBy("ts", "id")
    by = F.col(ordered.RANK)
    cut = ordered.ranked(crowd, ["k"], "ts", rows=rows)
    got = ordered.neighbours(cut, ["k"], ["ts", "id"], by, prev={"p": F.col("v")}, next={"n": F.col("id")}).drop(ordered.RANK)
    same(got, crowd.select("*", F.lag("v").over(w), F.lead("id").over(w)))
    edges = ordered.rank_edges(crowd, ["k"], "ts", rows)
    again = [ordered.ranked(crowd, ["k"], "ts", edges) for _ in range(2)]
    for source in (None, again[1]):
        got = ordered.carry_forward(again[0], ["k"], ["ts", "id"], {"f": F.col("v")}, by, source=source).drop(ordered.RANK)
        same(got, crowd.select("*", F.last("v", ignorenulls=True).over(w)))
    got = ordered.split_row_number(cut, ["k"], [F.col("ts"), F.col("id")], by, "n").drop(ordered.RANK)
    same(got, crowd.select("*", F.row_number().over(w)))
    plain = Window.orderBy("ts", "id")
    got = ordered.neighbours(ordered.ranked(crowd, [], "ts", rows=rows), [], ["ts", "id"], by, prev={"p": F.col("id")}).drop(ordered.RANK)
    same(got, crowd.select("*", F.lag("id").over(plain)))


def test_running_totals_are_handed_on(numbers):
    rows, df = numbers
    counted = df.filter("v is not null").groupBy("k", "v").agg(F.count("*").alias("n"))
    for width in (0.5, 1e13):
        got = ordered.split_running_total(counted, ["k"], [F.col("v")], ordered.number_bucket(F.col("v"), width), "n", "before", "total")
        for r in got.collect():
            values = groups(rows)[r.k]
            assert (r.before, r.total) == (sum(v < r.v for v in values), len(values))


def test_median_of_places(numbers):
    rows, df = numbers
    placed = stats.with_places(df.filter("v is not null"), ["k"], "v")
    got = {r.k: (r.m, r.n) for r in placed.groupBy("k").agg(stats.median_of_places("v").alias("m"), F.count("*").alias("n")).collect()}
    want = groups(rows)
    assert set(got) == set(want) and all(got[k] == (pytest.approx(statistics.median(v), rel=1e-12), len(v)) for k, v in want.items())
