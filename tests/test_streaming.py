"""Streams over files, run until all input is read."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitwall.streaming import feeds, sinks, state

T0 = dt.datetime(2024, 3, 2, 15)


def write(path, name, records):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in records))


def car(seconds, driver=44, speed=100, event_time=None):
    text = event_time or (T0 + dt.timedelta(seconds=seconds)).isoformat()
    return {"replay_id": "r", "event_time": text, "emitted_at": "x", "session_key": 1, "driver_number": driver, "speed": speed}


def run(spark, tmp_path, stream, name="out"):
    out = str(tmp_path / name)
    sinks.drain(sinks.append_table(stream, out, str(tmp_path / f"{name}-state"), None, once=True))
    return spark.read.schema(stream.schema).parquet(out)


def test_unreadable_time_is_the_epoch(spark, tmp_path):
    write(tmp_path / "in", "a.json", [car(0), car(0, event_time="soon"), car(0, event_time="2024-03-02T15:00:00.123456+00:00")])
    got = run(spark, tmp_path, feeds.parse_feed(feeds.file_rows(spark, str(tmp_path / "in")), "car_data"))
    assert sorted(r["event_time"] for r in got.collect()) == [dt.datetime(1970, 1, 1), T0, T0 + dt.timedelta(milliseconds=123)]


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "a.json", [car(s, speed=s) for s in range(0, 200, 7)])
    write(source, "z.json", [car(400 * 86400, driver=-1)])
    stream = feeds.parse_feed(feeds.file_rows(spark, str(source)), "car_data")
    got = run(spark, tmp_path, state.telemetry_windows(stream)).filter("driver_number > 0")
    batch = feeds.parse_feed(spark.read.text(str(source)), "car_data")
    want = state.telemetry_windows(batch).filter("driver_number > 0")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() == 4


def test_latest_window_values(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "a.json", [car(1, speed=1), car(59, speed=2), car(60, speed=3), car(30, speed=9)])
    write(source, "z.json", [car(400 * 86400, driver=-1)])
    stream = feeds.parse_feed(feeds.file_rows(spark, str(source)), "car_data")
    got = run(spark, tmp_path, state.latest_windows(stream, ["driver_number"], "event_time", ["speed"])).filter("driver_number > 0")
    assert sorted(r["speed"] for r in got.collect()) == [2, 3]


def test_duplicates_in_and_across_batches(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "a.json", [car(0), car(0), car(5)])
    write(source, "b.json", [car(0), car(6)])
    rows = feeds.file_rows(spark, str(source), files_per_batch=1)
    stream = feeds.parse_feed(rows, "car_data").withColumn("id", F.date_format("event_time", "HHmmss"))
    got = run(spark, tmp_path, state.skip_duplicates(stream, "id", "event_time"))
    assert sorted(r["id"] for r in got.collect()) == ["150000", "150005", "150006"]


def test_late_record_is_dropped_beyond_the_watermark(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "a.json", [car(10 * 86400)])
    rows = feeds.file_rows(spark, str(source), files_per_batch=1)
    stream = feeds.parse_feed(rows, "car_data").withColumn("id", F.col("event_time").cast("string"))
    out = state.skip_duplicates(stream, "id", "event_time")
    assert run(spark, tmp_path, out).count() == 1
    write(source, "b.json", [car(0), car(9 * 86400)])
    # ten days late is beyond the three-day watermark, one day is not
    assert run(spark, tmp_path, out).count() == 2


def test_one_per_second_per_key(spark, tmp_path):
    write(tmp_path / "in", "a.json", [car(0.1), car(0.9), car(1.2), car(0.3, driver=7)])
    stream = feeds.parse_feed(feeds.file_rows(spark, str(tmp_path / "in")), "car_data")
    got = run(spark, tmp_path, state.one_per_second(stream, ["driver_number"], "event_time"))
    assert sorted((r["driver_number"], r["second"].second) for r in got.collect()) == [(7, 0), (44, 0), (44, 1)]


def test_merge_sink_repeats_safely(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "a.json", [car(0, speed=1), car(1, speed=2)])
    write(source, "b.json", [car(0, speed=5)])
    stream = feeds.parse_feed(feeds.file_rows(spark, str(source), files_per_batch=1), "car_data")
    for name in ("s1", "s2"):
        sinks.drain(sinks.merge_table(
            stream, str(tmp_path / "out"), str(tmp_path / name), ["driver_number", "event_time"], "event_date", [F.col("speed").desc()], once=True
        ))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 2


def test_late_records_count(spark, tmp_path):
    """A record that is a month late is in the table and in its window."""
    source = tmp_path / "in"
    write(source, "a.json", [car(40 * 86400, speed=1), car(10, speed=2)])
    stream = feeds.parse_feed(feeds.file_rows(spark, str(source), files_per_batch=1), "car_data")

    def once():
        sinks.drain(sinks.append_new(stream, str(tmp_path / "new"), str(tmp_path / "s1"), ["driver_number", "event_time"], "event_date", [F.col("speed")], once=True))
        sinks.drain(sinks.keep_windows(stream, str(tmp_path / "rows"), str(tmp_path / "win"), str(tmp_path / "s2"), ["session_key", "driver_number"], "event_time", "1 minute", state.telemetry_windows, once=True))

    once()
    write(source, "b.json", [car(20, speed=4), car(10, speed=9), car(30 * 86400, speed=5), car(3, driver=None)])
    once()
    got = sinks.read_batches(spark, str(tmp_path / "new"))
    assert sorted((r["event_time"], r["speed"]) for r in got.filter("driver_number = 44").collect()) == sorted((T0 + dt.timedelta(seconds=s), v) for s, v in ((40 * 86400, 1), (10, 2), (20, 4), (30 * 86400, 5)))
    windows = {r["window_start"]: (r["sample_count"], r["max_speed"]) for r in spark.read.parquet(str(tmp_path / "win")).collect()}
    assert windows == {T0: (3, 9), T0 + dt.timedelta(30): (1, 5), T0 + dt.timedelta(40): (1, 1)}
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 6


def test_progress_over_many_batches(spark, tmp_path):
    """More batches than the reports Spark keeps of a query."""
    source, out, counts = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "counts")
    for i in range(104):
        write(source, f"{i:03}.json", [car(i, driver=i % 3, speed=None if i % 4 == 0 else 5)])
    stream = feeds.parse_feed(feeds.file_rows(spark, str(source), files_per_batch=1), "car_data")
    sinks.drain(sinks.append_counted(stream, out, counts, str(tmp_path / "state"), ["speed"], ["driver_number"], once=True))
    got = {r["driver_number"]: (r["processed"], r["inserted"]) for r in sinks.progress(spark, counts, ["driver_number"]).collect()}
    assert got == {d: (sum(i % 3 == d for i in range(104)), sum(i % 3 == d and i % 4 > 0 for i in range(104))) for d in range(3)}
    assert sinks.read_batches(spark, out).count() == sum(n for _, n in got.values())


def test_route_order(spark):
    df = spark.createDataFrame([(1, 2, 3, None, None, None, None), (None, None, None, 4, 5, 6, "1"), (None,) * 7], "x int, y int, z int, position int, rpm int, speed int, gap_to_leader string")
    assert [r["feed"] for r in feeds.route(df).collect()] == ["location", "position", None]


def test_replay(spark):
    df = spark.createDataFrame([(T0,), (T0 + dt.timedelta(minutes=30),), (T0 + dt.timedelta(minutes=10),)], "ts timestamp_ntz")
    # the window is open on both sides
    assert feeds.replay_window(df, "ts", T0).count() == 1
    assert sorted(r["emit_offset_s"] for r in feeds.replay_schedule(df, "ts", 2.0).collect()) == [0.0, 300.0, 900.0]
    assert sorted(r["emit_offset_s"] for r in feeds.replay_schedule(df, "ts", 0.0).collect())[1] == pytest.approx(600 / 0.001)
