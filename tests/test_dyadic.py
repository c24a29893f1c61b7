"""Spans as nodes of a tree: joins and aggregates of long, wrong and crowded intervals against brute force."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from pitwall.operators import intervals
from pitwall.operators.dyadic import cover, level_of, nodes_of
from pitwall.operators.intervals import BIN, asof_join, range_join, range_left_join, span_aggregates, spacing
from pitwall.plans import production as p
from test_plans import CAR, at, feed

START = dt.datetime(2024, 1, 1)
END_OF_TIME = dt.datetime(9999, 12, 31, 23, 59, 59, 999999)


def spans():
    rng = random.Random(1)
    out = [(5, 4), (None, 3), (3, None), (0, 253402300799999999), (-9, -1), (-64, 63)]
    for _ in range(1500):
        low = rng.choice([rng.randrange(-100, 100), rng.randrange(-(10**6), 10**6), rng.randrange(10**15, 10**17)])
        out.append((low, low + rng.choice([0, 1, 6, 7, 8, 9, 63, 64, 65, rng.randrange(5000), 10 ** rng.randrange(1, 17)])))
    return out


def test_cover_is_exact_and_short(spark):
    got = spark.createDataFrame(spans(), "low long, high long").withColumn("nodes", cover(F.col("low"), F.col("high"))).collect()
    for r in got:
        if r.low is None or r.high is None or r.low > r.high:
            assert r.nodes == []
            continue
        held = sorted((n >> 5 << 3 * (n % 32), (n >> 5) + 1 << 3 * (n % 32)) for n in r.nodes)
        assert held[0][0] == r.low and held[-1][1] == r.high + 1
        assert all(a[1] == b[0] for a, b in zip(held, held[1:]))
        assert len(held) <= 14 * (1 + max(n % 32 for n in r.nodes))


def test_a_number_is_in_one_node_of_each_level(spark):
    df = spark.createDataFrame([(-17,), (0,), (8**5 + 3,)], "x long").select("x", F.explode(nodes_of(F.col("x"), F.sequence(F.lit(0), F.lit(6)))).alias("n"))
    assert sorted((r.x, r.l, r.n >> 5) for r in df.withColumn("l", level_of(F.col("n"))).collect()) == sorted((x, l, x >> 3 * l) for x in (-17, 0, 8**5 + 3) for l in range(7))


@pytest.fixture(scope="module")
def crowd():
    """Intervals of two keys: short ones, one without end, one of a hundred years, ends before starts, NULLs; points at the edges, and a burst within a second."""
    rng = random.Random(3)
    ivs = []
    for i in range(200):
        s = START + dt.timedelta(seconds=rng.randrange(4 * 3600))
        ivs.append((i, "a" if i % 3 else "b", s, s + dt.timedelta(seconds=rng.choice([-5, 0, 1, 60, 90, 3600]))))
    ivs += [(900, "a", START, END_OF_TIME), (901, "b", START - dt.timedelta(days=36500), START + dt.timedelta(hours=1)), (902, "a", None, START), (903, "a", START, None), (904, None, START, END_OF_TIME)]
    pts = [(i, rng.choice("ab"), START + dt.timedelta(seconds=rng.randrange(5 * 3600))) for i in range(300)]
    pts += [(1000 + i, "a", START + dt.timedelta(hours=2, microseconds=rng.randrange(10**6))) for i in range(200)]
    pts += [(2000 + i, k, t) for i, (_, k, s, e) in enumerate(ivs[:60]) for t in (s, e)] + [(5000, "a", None), (5001, None, START), (5002, "b", END_OF_TIME)]
    return ivs, pts


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("width", ["own", 1_000_000, 10**12])
def test_range_join_with_endless_intervals(spark, crowd, closed, width):
    ivs, pts = crowd
    left, right = spark.createDataFrame(ivs, "i int, k string, s timestamp_ntz, e timestamp_ntz"), spark.createDataFrame(pts, "j int, k string, t timestamp_ntz")
    got = range_join(left, right, ["k"], "s", "e", "t", spacing(left, ["k"], "s") if width == "own" else width, closed=closed)
    want = [(i, j) for i, k, s, e in ivs for j, q, t in pts if k == q and None not in (k, s, e, t) and s <= t and (t <= e if closed else t < e)]
    assert sorted((r.i, r.j) for r in got.collect()) == sorted(want)


def test_an_endless_interval_makes_few_nodes_and_even_tasks(spark):
    """One key has all rows and one interval without end. No node holds much more than its level's share of the points."""
    points = spark.range(40_000).select(F.lit(1).alias("k"), F.timestamp_add("SECOND", F.col("id") * 9, F.lit(START)).alias("t"))
    laps = spark.range(4_000).select(F.lit(1).alias("k"), F.col("id").alias("i"), F.timestamp_add("SECOND", F.col("id") * 90, F.lit(START)).alias("s"))
    laps = laps.withColumn("e", F.when(F.col("i") == 7, F.lit(END_OF_TIME)).otherwise(F.timestamp_add("SECOND", F.lit(90), F.col("s"))))
    pairs = range_join(laps, points, ["k"], "s", "e", "t", spacing(laps, ["k"], "s"), keep_bin=True).cache()
    assert pairs.filter("i <> 7").count() == 3_999 * 10 and pairs.filter("i = 7").count() == 40_000 - 70
    # pairs and points are as many as without the endless one, times the levels
    nodes = pairs.groupBy(BIN).count()
    assert nodes.filter("count > 8 * 8 * 8 * 8 * 10").count() == 0
    assert pairs.filter("i = 7").select(BIN).distinct().count() < 14 * 12


def test_asof_over_a_long_silence(spark):
    """One reading decades before the rest: it stays valid over thousands of cells."""
    late = [(1, START + dt.timedelta(seconds=i), i) for i in range(500)]
    right = spark.createDataFrame([(1, dt.datetime(1970, 1, 1), -1), *late, (2, START, 5)], "k int, t timestamp_ntz, v int")
    asks = [(1, dt.datetime(1969, 1, 1)), (1, dt.datetime(1990, 1, 1)), (1, START), (1, START + dt.timedelta(seconds=7.5)), (1, END_OF_TIME), (2, START - dt.timedelta(1)), (2, START), (3, START), (1, None), (None, START)]
    got = asof_join(spark.createDataFrame(asks, "k int, a timestamp_ntz"), right, ["k"], "a", "t", ["v"])
    want = [None, -1, 0, 7, 499, None, 5, None, None, None]
    assert sorted((tuple(r)[:2], r.v) for r in got.collect() if r.k and r.a) == sorted((a, v) for a, v in zip(asks, want) if a[0] and a[1])
    assert [r.v for r in got.collect() if not (r.k and r.a)] == [None, None]


def test_span_aggregates(spark, crowd):
    ivs, pts = crowd
    left = spark.createDataFrame(ivs, "i int, k string, s timestamp_ntz, e timestamp_ntz")
    right = spark.createDataFrame([(*x, float(x[0])) for x in pts], "j int, k string, t timestamp_ntz, v double")
    v = F.col("v")
    got = span_aggregates(left, right, ["k"], "s", "e", "t", {"total": ("sum", v), "low": ("min", v), "high": ("max", v), "n": ("count", v)})
    held = {i: [float(j) for j, q, t in pts if k == q and None not in (k, s, e, t) and s <= t <= e] for i, k, s, e in ivs}
    for r in got.collect():
        h = held.pop(r.i)
        assert (r.n, r.low, r.high) == (len(h), min(h, default=None), max(h, default=None)) and (r.total == pytest.approx(sum(h)) if h else r.total is None)
    assert not held


def test_span_aggregates_deal_points_out_by_their_number(spark, crowd, monkeypatch):
    """Tasks that spread points over the levels are as many as the points ask for, not as the files or keys give."""
    ivs, pts = crowd
    left = spark.createDataFrame(ivs, "i int, k string, s timestamp_ntz, e timestamp_ntz")
    right = spark.createDataFrame(pts, "j int, k string, t timestamp_ntz").coalesce(1)
    monkeypatch.setattr(intervals, "PART_POINTS", 20)
    got = span_aggregates(left, right, ["k"], "s", "e", "t", {"n": ("count", F.col("j"))})
    parts = 1 + sum(t is not None for _, _, t in pts) // 20
    assert f", {parts})" in [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "REPARTITION_BY_NUM" in line][0].replace("), REP", ") REP")
    for r in got.collect():
        assert r.n == sum(q == r.k and None not in (r.k, r.s, r.e, t) and r.s <= t <= r.e for _, q, t in pts)


def test_range_left_join_deals_no_pair_again(spark, crowd):
    """Every interval keeps its own pairs, repeated ones and those with a NULL too, and the many pairs are in no exchange."""
    ivs, pts = crowd
    ivs = [*ivs, ivs[0], (1000, "nowhere", START, END_OF_TIME), (1001, None, START, END_OF_TIME), (1001, None, START, END_OF_TIME)]
    left = spark.createDataFrame(ivs, "i int, k string, s timestamp_ntz, e timestamp_ntz")
    right = spark.createDataFrame(pts, "j int, k string, t timestamp_ntz").select("k", "t", "j")
    got = range_left_join(left, right, ["k"], "s", "e", "t")
    want = []
    for iv in ivs:
        _, k, s, e = iv
        hits = [(t, j) for j, q, t in pts if k == q and None not in (k, s, e, t) and s <= t <= e]
        want += [(*iv, *h) for h in hits or [(None, None)]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    # from the pairs up: joins, filters and projections, then the union; rows that met are not dealt out again
    top = got._jdf.queryExecution().sparkPlan()
    while top.children().size() == 1:
        top = top.children().head()
    assert top.nodeName() == "Union"
    pairs = top.children().head()
    while pairs.children().size() == 1:
        assert "Exchange" not in pairs.nodeName() and "Aggregate" not in pairs.nodeName()
        pairs = pairs.children().head()
    assert "Join" in pairs.nodeName() and "_bin" in pairs.verboseStringWithOperatorId()


def test_bad_readings_spoil_only_their_stints(spark):
    def weather(second, **v):
        return {"meeting_key": 1, "session_key": 10, "date": at(second), "air_temperature": 20.0, "track_temperature": 30.0, "humidity": 50.0, "wind_speed": 1.0, "rainfall": False, **v}

    rows = {
        "laps": [{**CAR, "lap_number": n, "date_start": at(100 * n), "lap_duration": 100.0} for n in range(1, 10)],
        "stints": [{**CAR, "stint_number": n, "lap_start": 3 * n - 2, "lap_end": 3 * n, "compound": "SOFT"} for n in (1, 2, 3)],
        "weather": [weather(150, air_temperature=math.nan), weather(180, humidity=math.inf), weather(450, air_temperature=1e17), weather(460), weather(750, rainfall=True), weather(760, air_temperature=10.0)],
    }
    tables = {n: feed(spark, n, rows.get(n, [])) for n in ("laps", "stints", "weather")}
    got = {r.stint_number: r for r in p.stint_weather(tables).collect()}
    assert math.isnan(got[1].avg_air_temp) and got[1].avg_humidity == math.inf
    assert got[2].avg_humidity == 50.0 and got[2].avg_air_temp == (1e17 + 20) / 2
    # nothing of the large numbers before is left over here
    assert (got[3].avg_air_temp, got[3].had_rainfall, got[3].weather_condition) == (15.0, True, "Wet")
