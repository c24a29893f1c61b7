"""Operators against brute force, with one key that holds most rows."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import Window, functions as F

from pitwall.operators import checks, intervals, ordered, rows, stats

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    """900 events; one key holds two thirds of them, spread over two days; every third value is NULL."""
    r = random.Random(7)
    seconds = r.sample(range(2 * 86400), 900)
    out = [(i, "hot" if i % 3 else f"k{i % 11}", START + dt.timedelta(seconds=s), None if i % 3 == 1 else r.random()) for i, s in enumerate(seconds)]
    return spark.createDataFrame(out, "id int, key string, ts timestamp_ntz, v double").cache()


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def by_key():
    return Window.partitionBy("key").orderBy("ts")



@pytest.mark.parametrize("seconds", [60, 3600, 10**7])
def test_neighbours(events, seconds):
    got = ordered.neighbours(events, ["key"], ["ts"], ordered.time_bucket(F.col("ts"), seconds), prev={"p": F.col("v")}, next={"n": F.col("v"), "t": F.col("ts")})
    same(got, events.select("*", F.lag("v").over(by_key()), F.lead("v").over(by_key()), F.lead("ts").over(by_key())))


@pytest.mark.parametrize("seconds", [60, 3600, 10**7])
@pytest.mark.parametrize("rescan", [True, False])
def test_carry_forward(events, seconds, rescan):
    got = ordered.carry_forward(events, ["key"], ["ts"], {"f": F.col("v")}, ordered.time_bucket(F.col("ts"), seconds), source=events if rescan else None)
    same(got, events.select("*", F.last("v", ignorenulls=True).over(by_key())))


@pytest.mark.parametrize("rescan", [True, False])
def test_split_row_number(events, rescan):
    got = ordered.split_row_number(events, ["key"], [F.col("ts")], ordered.time_bucket(F.col("ts")), "n", source=events if rescan else None)
    same(got, events.select("*", F.row_number().over(by_key())))


def test_split_dense_rank(events):
    coarse = events.select("id", "key", F.floor(F.col("v") * 20).cast("int").alias("g"))
    coarse = coarse.filter("g is not null")
    got = ordered.split_dense_rank(coarse, ["key"], "g", ordered.number_bucket(F.col("g"), 4), "n")
    same(got, coarse.select("*", F.dense_rank().over(Window.partitionBy("key").orderBy("g"))))


def test_global_neighbours(events):
    got = ordered.neighbours(events.select("id", "ts"), [], ["ts"], ordered.time_bucket(F.col("ts")), prev={"p": F.col("id")})
    same(got, events.select("id", "ts", F.lag("id").over(Window.orderBy("ts"))))


def test_exact_median(events):
    got = {r["key"]: r["m"] for r in stats.exact_median(events, ["key"], "v", "m").collect()}
    want: dict = {}
    for r in events.collect():
        if r["v"] is not None:
            want.setdefault(r["key"], []).append(r["v"])
    assert got == {k: pytest.approx(statistics.median(v)) for k, v in want.items()}


def test_median_of_null_group_and_repeats(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 2.0), (1, 5.0), (2, None)], "k int, v double")
    groups = df.select("k").distinct()
    assert {r["k"]: r["m"] for r in stats.with_median(groups, df, ["k"], "v", "m").collect()} == {None: 2.0, 1: 5.0, 2: None}


@pytest.fixture(scope="module")
def spans(spark, events):
    r = random.Random(3)
    out = []
    for i in range(120):
        a = START + dt.timedelta(seconds=r.randrange(2 * 86400))
        out.append((i, "hot" if i % 3 else f"k{i % 11}", a, a + dt.timedelta(seconds=r.choice([0, 30, 4000, 90000]))))
    out += [(120, "hot", None, START), (121, "hot", START, None), (122, "hot", START + dt.timedelta(hours=2), START)]
    return spark.createDataFrame(out, "sid int, key string, a timestamp_ntz, b timestamp_ntz")


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("width", [10**7, 10**10, 10**12])
def test_range_join(events, spans, closed, width):
    got = intervals.range_join(spans, events, ["key"], "a", "b", "ts", width, closed=closed).select("sid", "id")
    inside = (F.col("ts") >= F.col("a")) & ((F.col("ts") <= F.col("b")) if closed else (F.col("ts") < F.col("b")))
    same(got, spans.join(events, "key").filter(inside).select("sid", "id"))


def test_range_join_boundaries(spark):
    lap = spark.createDataFrame([(1, "x", START, START + dt.timedelta(minutes=1))], "sid int, key string, a timestamp_ntz, b timestamp_ntz")
    at = spark.createDataFrame([("x", START), ("x", START + dt.timedelta(minutes=1))], "key string, ts timestamp_ntz")
    assert intervals.range_join(lap, at, ["key"], "a", "b", "ts", 60_000_000).count() == 1
    assert intervals.range_join(lap, at, ["key"], "a", "b", "ts", 60_000_000, closed=True).count() == 2


def test_range_join_with_a_width_per_key(events, spans):
    """A busy key gets narrow bins, a sparse one wide ones, and no pair is lost."""
    widths = intervals.spacing(events, ["key"], "ts")
    by = {r["key"]: r["_width"] for r in widths.collect()}
    assert by["hot"] < min(w for k, w in by.items() if k != "hot") / 10
    got = intervals.range_join(spans, events, ["key"], "a", "b", "ts", widths).select("sid", "id")
    same(got, spans.join(events, "key").filter("ts >= a and ts < b").select("sid", "id"))


@pytest.mark.parametrize("seconds", [60, 3600, 10**7])
def test_running_totals(events, seconds):
    df = events.select("id", "key", "ts", "v", F.col("id").cast("double").alias("n"))
    got = ordered.running_totals(df, ["key"], ["ts"], ["v", "n"], ordered.time_bucket(F.col("ts"), seconds))
    want = df.select("id", "key", "ts", F.coalesce(F.sum("v").over(by_key()), F.lit(0.0)).alias("v"), F.sum("n").over(by_key()).alias("n"))
    rounded = [d.select("id", "key", "ts", *[F.round(c, 6) for c in d.columns[3:]]) for d in (got, want)]
    same(*rounded)


def test_last_in_interval_of_two_feeds(events, spans):
    feeds = {"x": events.select("key", F.col("ts").alias("x_at"), F.col("id").alias("x_id")), "y": events.filter("id % 2 = 0").select("key", F.col("ts").alias("y_at"), F.col("v").alias("y_v"))}
    got = intervals.last_in_interval(spans, feeds, ["key"], ["sid"], "a", "b", 10**10)
    pairs = spans.join(events, "key").filter("ts >= a and ts < b")
    even = F.col("id") % 2 == 0
    want = pairs.groupBy("sid").agg(
        F.max("ts"), F.max_by("id", "ts"), F.max(F.when(even, F.col("ts"))), F.max_by("v", F.when(even, F.col("ts")))
    )
    same(got, want)


def test_asof(spark, events):
    probes = events.filter("id % 2 = 0").select("id", "key", "ts").unionByName(spark.createDataFrame([(-1, "hot", None), (-2, "none", START)], "id int, key string, ts timestamp_ntz"))
    right = events.filter("id % 5 = 0").select("key", F.col("ts").alias("at"), F.col("v").alias("rv"))
    for readings in (right, right.filter("minute(at) < 9"), right.filter("key = 'hot' AND hour(at) = 3"), right.filter("false")):
        got = intervals.asof_join(probes, readings, ["key"], "ts", "at", ["rv"]).select("id", "at", "rv")
        want = probes.join(readings, (probes["key"] == readings["key"]) & (readings["at"] <= probes["ts"]), "left")
        want = want.groupBy("id").agg(F.max("at"), F.max_by("rv", "at"))
        same(got, want)


def test_asof_tie_and_null_field(spark):
    right = spark.createDataFrame([("x", START, 1), ("x", START + dt.timedelta(seconds=5), None)], "key string, at timestamp_ntz, rv int")
    left = spark.createDataFrame([(1, "x", START), (2, "x", START + dt.timedelta(hours=30)), (3, "x", START - dt.timedelta(1))], "id int, key string, ts timestamp_ntz")
    got = {r["id"]: (r["at"], r["rv"]) for r in intervals.asof_join(left, right, ["key"], "ts", "at", ["rv"]).collect()}
    # the latest row counts even though its field is NULL
    assert got == {1: (START, 1), 2: (START + dt.timedelta(seconds=5), None), 3: (None, None)}


def test_safe_corr(spark):
    df = spark.createDataFrame([("one", 1.0, 2.0), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0), ("gap", 1.0, 1.0), ("gap", None, 9.0), ("gap", 2.0, 3.0)], "k string, x double, y double")
    got = {r["k"]: r["c"] for r in df.groupBy("k").agg(stats.safe_corr(F.col("x"), F.col("y")).alias("c")).collect()}
    assert got == {"one": None, "flat": None, "gap": pytest.approx(1.0)}


def test_ordered_list(spark):
    df = spark.createDataFrame([("a", 10), ("a", 2), ("a", 10), ("b", None)], "k string, v int")
    assert [tuple(r) for r in stats.ordered_list_text(df, ["k"], "v", "t").collect()] == [("a", "2, 10, 10")]
    assert [tuple(r) for r in stats.ordered_list_text(df, ["k"], "v", "t", distinct=True).collect()] == [("a", "2, 10")]


def test_dedupe_is_limited_before_the_exchange(events):
    plan = rows.latest(events, ["key"], "ts", [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    # once below and once above the exchange
    assert plan.count("WindowGroupLimit") >= 2


def test_sustained_pedals(spark):
    at = [0, 499, 999, 1600]
    df = spark.createDataFrame([(START + dt.timedelta(milliseconds=m), 110, 110, 80, 6000) for m in at], "date timestamp_ntz, brake int, throttle int, speed int, rpm int")
    assert sorted(r["date"].microsecond // 1000 + r["date"].second * 1000 for r in checks.pedal_faults(df, "date").collect()) == [0, 499]
    assert checks.pedal_faults(df.limit(1), "date").count() == 0


def test_two_sided_range_fires_on_either_side(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "v int")
    assert sorted(r["v"] for r in checks.violations(df, checks.accepted_range("v", 2, 8)).collect()) == [1, 9]
    assert [tuple(r) for r in checks.summary(df, [checks.accepted_range("v", 2, 8), checks.not_null("v", severity="warn")]).collect()] == [
        ("accepted_range_v", "error", 2, False), ("not_null_v", "warn", 1, False)
    ]


def test_median_of_narrow_and_outlying_values(spark):
    """Many values close together, a few far away; odd and even groups."""
    r = random.Random(12)
    data = {"narrow": [1e6 + r.random() * 1e-3 for _ in range(20_001)], "wide": [r.choice([0.0, 1e12, r.random()]) for _ in range(10_000)], "one": [7.0], "two": [1.0, 2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v double")
    got = {row["k"]: row["m"] for row in stats.exact_median(df, ["k"], "v", "m").collect()}
    assert got == {k: pytest.approx(statistics.median(v), rel=1e-15) for k, v in data.items()}


def test_explode_numbers(spark):
    """One wrong number of another car and one wrong end don't blow up a row."""
    spans = spark.createDataFrame([("a", 1, 3), ("a", 2, 2_000_000_000), ("a", 5, 4), ("b", 1, 2), ("c", 1, 9), ("a", None, 2)], "k string, lo int, hi int")
    numbered = spark.createDataFrame([("a", 1), ("a", 4), ("b", 2_000_000_000), ("b", None)], "k string, n int")
    got = intervals.explode_numbers(spans, ["k"], "lo", "hi", numbered, "n", outer=True)
    want = [("a", 1, 3, n) for n in (1, 2, 3)] + [("a", 2, 2_000_000_000, n) for n in (2, 3, 4)] + [("a", 5, 4, None), ("b", 1, 2, None), ("c", 1, 9, None), ("a", None, 2, None)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert intervals.explode_numbers(spans, ["k"], "lo", "hi", numbered, "n").count() == 6
