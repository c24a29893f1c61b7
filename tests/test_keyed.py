"""Keyed stream state: late records come out as late, and state stays small."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from pitwall.sources.scratch import scratch_path
from pitwall.streaming import keyed, sinks

START = dt.datetime(2024, 1, 1)
SCHEMA = "k int, at timestamp_ntz, v int, w string"


def files(spark, batches):
    """One file for each micro-batch, read in the order of writing."""
    path = scratch_path(spark, "source")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02 * (i + 1 < len(batches)))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def by_hand(batches, width, delay, last=True):
    """The same rule over plain lists: windows, and late records."""
    high, windows, late = {}, {}, []
    for rows in batches:
        for k, at, v, w in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[1]):
            start = at - (at - dt.datetime(1970, 1, 1)) % width
            if k in high and start + width + delay <= high[k]:
                late.append((k, start, at, v, w))
                continue
            high[k] = max(high.get(k, at), at)
            order = lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "")
            held = windows.get((k, start))
            if held is None or (order((at, v, w)) > order(held) if last else order((at, v, w)) < order(held)):
                windows[k, start] = (at, v, w)
    return sorted([(*k, *r) for k, r in windows.items()], key=repr), sorted(late, key=repr)


def test_windows_late_records_and_bounded_state(spark):
    rng, batches = random.Random(3), []
    for b in range(6):
        rows = [(rng.choice([1, 1, 2, None]), START + dt.timedelta(seconds=b * 600 + rng.randrange(600)), rng.choice([None, rng.randrange(9)]), rng.choice([None, "x", "y"])) for _ in range(60)]
        rows += [(1, START + dt.timedelta(seconds=rng.randrange(60)), b, "late")] * (b % 2) + [(2, None, 1, "n")]
        batches.append(rows)
    stream = keyed.per_window(files(spark, batches), ["k"], "at", 60, 300)
    path, late = scratch_path(spark, "windows"), scratch_path(spark, "late")
    run = sinks.drain(sinks.merge_windows(stream, path, late, scratch_path(spark, "state"), ["k"], once=True))
    windows, too_late = by_hand(batches, dt.timedelta(seconds=60), dt.timedelta(seconds=300))
    names = ["k", "window_start", "at", "v", "w"]
    shape = stream.drop(keyed.LATE).schema
    got, left = spark.read.parquet(path).select(*names), spark.read.schema(shape).parquet(late).select(*names)
    assert sorted(map(tuple, got.collect()), key=repr) == windows
    assert sorted(map(tuple, left.collect()), key=repr) == too_late and too_late
    # two keys hold the time of their last event and the windows of five minutes and one or two more, however many there were
    assert len(windows) > 80
    assert all(op["numRowsTotal"] <= 2 * (2 + 7) for p in run.recentProgress for op in p["stateOperators"])
    # late records and windows together are what they would be had all come in time
    whole = keyed.reconciled(got, left, ["k"], "at")
    assert sorted(map(tuple, whole.collect()), key=repr) == by_hand([[r for b in batches for r in b]], dt.timedelta(seconds=60), dt.timedelta(days=9))[0]


def test_a_key_is_one_row_of_state(spark):
    """One read and one write per key and micro-batch, however many windows are open."""
    batches = [[(k, START + dt.timedelta(seconds=60 * i + b), i, None) for k in (1, 2) for i in range(10)] for b in range(2)]
    stream = keyed.per_window(files(spark, batches), ["k"], "at", 60, 3600)
    path, late = scratch_path(spark, "windows"), scratch_path(spark, "late")
    run = sinks.drain(sinks.merge_windows(stream, path, late, scratch_path(spark, "state"), ["k"], once=True))
    assert spark.read.parquet(path).count() == 20
    assert max(op["numRowsTotal"] for p in run.recentProgress for op in p["stateOperators"]) == 2


def test_counts_are_observed_by_the_write(spark):
    batches = [[(1, START, 1, None), (1, START + dt.timedelta(1), None, "x")], [(2, None, 5, None)], [(None, START, None, None)]]
    path, counts = scratch_path(spark, "sink"), scratch_path(spark, "counts")
    stream = files(spark, batches).withColumn("event_date", F.to_date("at"))
    sinks.drain(sinks.append_observed(stream, path, counts, scratch_path(spark, "state"), ["v"], "at", once=True))
    told = spark.read.parquet(counts).orderBy("batch_id").select("processed", "inserted", "first_at", "last_at").collect()
    assert [tuple(r) for r in told] == [(2, 1, START, START + dt.timedelta(1)), (1, 1, None, None), (1, 0, START, START)]
    assert sinks.read_batches(spark, path).count() == 2
