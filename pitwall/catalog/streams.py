"""Queries for streaming operators (ST).

Streams run over JSON files written from the feeds, until all files are read; the result is read from the sink.
The comparison SQL states the batch meaning.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from pitwall import functions as fx
from pitwall.catalog.oracle import key, time
from pitwall.catalog.registry import query, register
from pitwall.catalog.scalars import r
from pitwall.operators.reshape import append_all
from pitwall.schemas import ENVELOPE_PAYLOADS
from pitwall.sources.scratch import scratch_path
from pitwall.streaming import feeds, keyed, sinks, state

REPLAY = "replay-1"
def emitted():
    return F.lit("2024-02-01").cast("timestamp_ntz")


def _records(t, feed: str, copies: int = 1) -> str:
    """Live records of a feed as JSON text files."""
    path = scratch_path(t.spark, f"topic-{feed}")
    rows = feeds.keyed(feeds.normalise(t[feed], feed, REPLAY, emitted())).select("value")
    for _ in range(copies):
        rows.write.mode("append").text(path)
    return path


def _sink(t, stream: DataFrame, partition: str | None = None) -> DataFrame:
    path = scratch_path(t.spark, "sink")
    sinks.drain(sinks.append_table(stream, path, scratch_path(t.spark, "state"), partition, once=True))
    return t.spark.read.schema(stream.schema).parquet(path)


def _new_only(t, stream: DataFrame, keys: list[str], order: list, partition: str = "event_date") -> DataFrame:
    """The stream's first record per key, through the sink that keeps late records."""
    path = scratch_path(t.spark, "new")
    sinks.drain(sinks.append_new(stream, path, scratch_path(t.spark, "state"), keys, partition, order, once=True))
    return sinks.read_batches(t.spark, path)


def _windows(t, feed: str, build) -> DataFrame:
    """Windows of a feed whose files arrive one by one, in whatever order."""
    path, stored = scratch_path(t.spark, "windows"), scratch_path(t.spark, "records")
    stream = feeds.parse_feed(feeds.file_rows(t.spark, _records(t, feed), files_per_batch=2), feed)
    sinks.drain(sinks.keep_windows(stream, stored, path, scratch_path(t.spark, "state"), ["session_key", "driver_number"], "event_time", "1 minute", build, once=True))
    return t.spark.read.parquet(path).drop("event_date")


_MS = "date_trunc('millisecond', date)"
_HEAD = f"'{REPLAY}' AS replay_id, {_MS} AS event_time, TIMESTAMP '2024-02-01' AS emitted_at, meeting_key, session_key, CAST(driver_number AS INTEGER) AS driver_number"


def _parsed(feed: str, view: str, columns: str):
    sql = f"SELECT {_HEAD}, {columns}, CAST(CAST(date AS DATE) AS VARCHAR) AS event_date FROM {view}"
    register(
        f"st02_append_{feed}", lambda t: _sink(t, feeds.parse_feed(feeds.file_rows(t.spark, _records(t, feed)), feed), "event_date"), sql,
    )


_parsed("car_data", "b_car", "brake, drs, n_gear, CAST(rpm AS BIGINT) AS rpm, speed, throttle")
_parsed("position", "b_position", "position")
_parsed("location", "b_location", "x, y, z")


@query("st01_json_source", f"SELECT {_HEAD}, brake, drs, n_gear, CAST(rpm AS BIGINT) AS rpm, speed, throttle, CAST(CAST(date AS DATE) AS VARCHAR) AS event_date FROM b_car")
def _(t):
    """The same parse function on a batch of topic records."""
    return feeds.parse_feed(t.spark.read.text(_records(t, "car_data")), "car_data")


def _payload(t) -> DataFrame:
    p = t["position"].select(
        fx.surrogate_key(F.col("session_key"), F.col("driver_number"), fx.time_text(F.col("date"))).alias("id"), "position",
        F.col("driver_number").cast("int").alias("driver_number"), F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.col("session_key").cast("int").alias("session_key"), F.col("meeting_key").cast("int").alias("meeting_key"),
    )
    return p.select(*ENVELOPE_PAYLOADS["position"].fieldNames())


_UNWRAPPED = f"""SELECT {key('session_key', 'driver_number', time('date'))} AS id, position, CAST(driver_number AS INTEGER) AS driver_number, date_trunc('second', date) AS date,
       CAST(session_key AS INTEGER) AS session_key, CAST(meeting_key AS INTEGER) AS meeting_key FROM b_position"""


def _envelopes(t, copies: int = 1) -> str:
    path, rows = scratch_path(t.spark, "envelopes"), _payload(t)
    for _ in range(copies):
        rows.select(feeds.enveloped(rows).alias("value")).write.mode("append").text(path)
    return path


@query(
    "st07_normalise_intervals",
    f"""SELECT {key('session_key', 'driver_number', time('date'))} AS id, CASE WHEN NOT contains(gap_to_leader, 'L') THEN TRY_CAST(gap_to_leader AS DOUBLE) END AS gap_to_leader,
        CASE WHEN NOT contains("interval", 'L') THEN TRY_CAST("interval" AS DOUBLE) END AS time_interval, CAST(driver_number AS INTEGER) AS driver_number, date_trunc('second', date) AS date,
        CAST(session_key AS INTEGER) AS session_key, CAST(meeting_key AS INTEGER) AS meeting_key FROM b_intervals""",
)
def _(t):
    """Interval rows through their envelope and back."""
    path, rows = scratch_path(t.spark, "envelopes"), feeds.normalise_intervals(t["intervals"])
    rows.select(feeds.enveloped(rows).alias("value")).write.text(path)
    return _sink(t, feeds.unwrap(feeds.file_rows(t.spark, path), "intervals"))


def _payload_of(t, feed: str, payload: str, kind: str) -> DataFrame:
    ids = [F.col(c).cast("int").alias(c) for c in ("driver_number", "session_key", "meeting_key")]
    values = [F.col(c).cast(kind).alias(c) for c in feeds.MEASURES[feed]]
    id_ = fx.surrogate_key(F.col("session_key"), F.col("driver_number"), fx.time_text(F.col("date"))).alias("id")
    return t[feed].select(id_, *values, ids[0], F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), *ids[1:]).select(*ENVELOPE_PAYLOADS[payload].fieldNames())


def _unwrapped(feed: str, payload: str, view: str, kind: str, sql_kind: str) -> None:
    def build(t):
        path, rows = scratch_path(t.spark, "envelopes"), _payload_of(t, feed, payload, kind)
        rows.select(feeds.enveloped(rows).alias("value")).write.text(path)
        return _sink(t, feeds.unwrap(feeds.file_rows(t.spark, path), payload))

    columns = ", ".join(f"CAST({c} AS {sql_kind}) AS {c}" for c in feeds.MEASURES[feed])
    register(
        f"st03_unwrap_{payload}", build,
        f"""SELECT {key('session_key', 'driver_number', time('date'))} AS id, {columns}, CAST(driver_number AS INTEGER) AS driver_number, date_trunc('second', date) AS date,
            CAST(session_key AS INTEGER) AS session_key, CAST(meeting_key AS INTEGER) AS meeting_key FROM {view}""",
    )


_unwrapped("car_data", "car", "b_car", "int", "INTEGER")
_unwrapped("location", "location", "b_location", "double", "DOUBLE")
register("st03_unwrap", lambda t: _sink(t, feeds.unwrap(feeds.file_rows(t.spark, _envelopes(t)), "position")), _UNWRAPPED)
@query("st04_skip_duplicates", _UNWRAPPED)
def _(t):
    stream = feeds.unwrap(feeds.file_rows(t.spark, _envelopes(t, copies=2)), "position").withColumn("event_date", F.to_date("date"))
    return _new_only(t, stream, ["id"], [F.col("date")]).drop("event_date")


_SECONDS = f"""SELECT event_type, user_id, second{{extra}} FROM (SELECT event_type, user_id, date_trunc('second', ts) AS second, event_id, ts FROM events)
       QUALIFY row_number() OVER (PARTITION BY event_type, user_id, second ORDER BY ts, event_id) = 1"""
register(
    "st05_first_per_second",
    lambda t: feeds.first_per_second(t.table("events"), ["event_type", "user_id"], "ts", ["event_id"]).select("event_type", "user_id", "second", "event_id"),
    _SECONDS.format(extra=", event_id"),
)


@query("st05_one_per_second_stream", "SELECT DISTINCT driver_number, date_trunc('second', date) AS second FROM (SELECT CAST(driver_number AS INTEGER) AS driver_number, date FROM b_position)")
def _(t):
    stream = feeds.parse_feed(feeds.file_rows(t.spark, _records(t, "position", copies=2)), "position").withColumn("second", fx.trunc_to("second", F.col("event_time")))
    return _new_only(t, stream.select("driver_number", "second", "event_time", "event_date"), ["driver_number", "second"], [F.col("event_time")]).select("driver_number", "second")


@query(
    "st06_route",
    "SELECT event_id, CASE event_type WHEN 'view' THEN 'car' WHEN 'signup' THEN 'position' WHEN 'purchase' THEN 'intervals' WHEN 'error' THEN 'location' END AS feed FROM events",
)
def _(t):
    kind, k = F.col("event_type"), F.col("k")
    mixed = t.events().select(
        "event_id", *[F.when(kind == "error", k).alias(c) for c in "xyz"], F.when(kind == "signup", k).alias("position"),
        *[F.when(kind == "view", k).alias(c) for c in ("rpm", "speed")], F.when(kind == "purchase", k.cast("string")).alias("gap_to_leader"),
    )
    return feeds.route(mixed).select("event_id", "feed")


def _normalised(feed: str, view: str, columns: str):
    register(
        f"st07_normalise_{feed}", lambda t: feeds.normalise(t[feed], feed, REPLAY, emitted()).select("replay_id", "event_time", *feeds.IDS, *feeds.MEASURES[feed]),
        f"""SELECT '{REPLAY}' AS replay_id, {time('date')} AS event_time, CAST(meeting_key AS INTEGER) AS meeting_key, CAST(session_key AS INTEGER) AS session_key,
            CAST(driver_number AS INTEGER) AS driver_number, {columns} FROM {view}""",
    )


_normalised("car_data", "b_car", "brake, drs, n_gear, rpm, speed, throttle")
_normalised("position", "b_position", "position")
_normalised("location", "b_location", "x, y, z")
register(
    "st08_replay_schedule",
    lambda t: feeds.replay_schedule(t.events().select("event_id", "ts"), "ts", 5.0),
    f"SELECT event_id, ts, {r('date_diff($$microsecond$$, min(ts) OVER (), ts) / 1e6 / 5', 'emit_offset_s')} FROM events",
)
_FROM = datetime.datetime(2024, 1, 10, 12)
register(
    "st09_replay_window", lambda t: feeds.replay_window(t.events().select("event_id", "ts", "driver_number"), "ts", _FROM, 24 * 60),
    "SELECT event_id, ts, driver_number FROM e_all WHERE ts > TIMESTAMP '2024-01-10 12:00:00' AND ts < TIMESTAMP '2024-01-11 12:00:00'",
)


@query(
    "st10_keyed_sink",
    f"""SELECT '{REPLAY}:' || driver_number AS key, '{{"replay_id":"{REPLAY}","event_time":"' || strftime({_MS}, '%Y-%m-%dT%H:%M:%S.%g') || '","position":' || position || '}}' AS value FROM b_position""",
)
def _(t):
    parsed = feeds.parse_feed(feeds.file_rows(t.spark, _records(t, "position")), "position")
    body = F.to_json(F.struct("replay_id", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("event_time"), "position"))
    return _sink(t, parsed.select(fx.stream_key(F.col("replay_id"), F.col("driver_number")).alias("key"), body.alias("value")))


_WINDOWS = f"""SELECT session_key, CAST(driver_number AS INTEGER) AS driver_number, date_trunc('minute', date) AS window_start, count(*) AS sample_count, {r('avg(speed)', 'avg_speed')}, max(speed) AS max_speed,
       {r('avg(throttle)', 'avg_throttle')}, max(drs) AS max_drs_state, max(n_gear) AS max_gear FROM b_car GROUP BY ALL"""


register("st11_telemetry_windows", lambda t: _windows(t, "car_data", state.telemetry_windows), _WINDOWS)


register(
    "st11_weather_windows", lambda t: state.weather_windows(t["weather"]),
    f"""SELECT session_key, time_bucket(INTERVAL 5 MINUTE, date) AS window_start, {r('avg(air_temperature)', 'avg_air_temperature')}, {r('avg(humidity)', 'avg_humidity')},
        max(CASE WHEN rainfall THEN 1 ELSE 0 END) AS has_rainfall, count(*) AS weather_sample_count FROM b_weather GROUP BY ALL""",
)


@query(
    "st12_latest_windows",
    f"""SELECT session_key, CAST(driver_number AS INTEGER) AS driver_number, date_trunc('minute', date) AS window_start, {_MS} AS event_time, position FROM b_position
        QUALIFY row_number() OVER (PARTITION BY session_key, driver_number, date_trunc('minute', date) ORDER BY date DESC) = 1""",
)
def _(t):
    return _windows(t, "position", lambda rows: state.latest_windows(rows, ["session_key", "driver_number"], "event_time", ["position"]))


@query(
    "st13_merge_late_data",
    f"""SELECT session_key, CAST(driver_number AS INTEGER) AS driver_number, {_MS} AS event_time, position, CAST(CAST(date AS DATE) AS VARCHAR) AS event_date FROM b_position""",
)
def _(t):
    """Every record arrives twice, in micro-batches; the merged table holds it once."""
    stream = feeds.parse_feed(feeds.file_rows(t.spark, _records(t, "position", copies=2)), "position").drop("replay_id", "emitted_at", "meeting_key")
    path = scratch_path(t.spark, "merged")
    sinks.drain(sinks.merge_table(
        stream, path, scratch_path(t.spark, "state"), ["session_key", "driver_number", "event_time"], "event_date", [F.col("position")], once=True
    ))
    return t.spark.read.schema(stream.schema).parquet(path)


@query(
    "st14_progress",
    "SELECT session_key, CAST(driver_number AS INTEGER) AS driver_number, count(*) AS processed, count(*) FILTER (k % 3 <> 0) AS inserted FROM e_all WHERE event_type = 'signup' GROUP BY ALL",
)
def _(t):
    """Every third record lacks its position: it is processed but not inserted."""
    source, path, counts = scratch_path(t.spark, "topic"), scratch_path(t.spark, "sink"), scratch_path(t.spark, "counts")
    body = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time"), "session_key", F.col("driver_number").cast("int").alias("driver_number"), F.when(F.col("k") % 3 != 0, F.col("k")).alias("position"))
    t.events("signup").select(F.to_json(body).alias("value")).repartition(5).write.text(source)
    stream = feeds.parse_feed(feeds.file_rows(t.spark, source, files_per_batch=1), "position")
    by = ["session_key", "driver_number"]
    sinks.drain(sinks.append_counted(stream, path, counts, scratch_path(t.spark, "state"), ["position"], by, once=True))
    # what the counters say was inserted must be in the table
    held = sinks.read_batches(t.spark, path).groupBy(*by).agg(F.count("*").alias("held"))
    told = sinks.progress(t.spark, counts, by).join(held, by, "left")
    return told.select(*by, "processed", F.when(F.col("inserted") == F.coalesce("held", F.lit(0)), F.col("inserted")).alias("inserted"))


@query(
    "st12_latest_keyed",
    f"""SELECT session_key, CAST(driver_number AS INTEGER) AS driver_number, date_trunc('minute', date) AS window_start, {_MS} AS event_time, position FROM b_position
        QUALIFY row_number() OVER (PARTITION BY session_key, driver_number, date_trunc('minute', date) ORDER BY date DESC) = 1""",
)
def _(t):
    """From state by key: files come in any order, so many records are late; they come out as such, and the windows and they together are the whole."""
    path, late = scratch_path(t.spark, "windows"), scratch_path(t.spark, "late")
    stream = feeds.parse_feed(feeds.file_rows(t.spark, _records(t, "position"), files_per_batch=2), "position").select("session_key", "driver_number", "event_time", "position")
    windows = keyed.per_window(stream, ["session_key", "driver_number"], "event_time", 60, 3600)
    sinks.drain(sinks.merge_windows(windows, path, late, scratch_path(t.spark, "state"), ["session_key", "driver_number"], once=True))
    shape = windows.drop(keyed.LATE).schema
    return keyed.reconciled(t.spark.read.schema(shape).parquet(path).select(*shape.fieldNames()), t.spark.read.schema(shape).parquet(late), ["session_key", "driver_number"], "event_time")


@query(
    "st14_observed",
    f"""SELECT count(*) AS processed, count(*) FILTER (k % 3 <> 0) AS inserted, min(date_trunc('millisecond', ts)) AS first_at, max(date_trunc('millisecond', ts)) AS last_at,
        count(*) FILTER (k % 3 <> 0) AS held FROM e_all WHERE event_type = 'signup'""",
)
def _(t):
    """Counts that the write itself observed, over all batches, and what the table holds."""
    source, path, counts = scratch_path(t.spark, "topic"), scratch_path(t.spark, "sink"), scratch_path(t.spark, "counts")
    body = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time"), "session_key", F.col("driver_number").cast("int").alias("driver_number"), F.when(F.col("k") % 3 != 0, F.col("k")).alias("position"))
    t.events("signup").select(F.to_json(body).alias("value")).repartition(5).write.text(source)
    stream = feeds.parse_feed(feeds.file_rows(t.spark, source, files_per_batch=1), "position")
    sinks.drain(sinks.append_observed(stream, path, counts, scratch_path(t.spark, "state"), ["position"], "event_time", once=True))
    told = sinks.read_batches(t.spark, counts).agg(F.sum("processed").alias("processed"), F.sum("inserted").alias("inserted"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
    return told.withColumn("held", sinks.read_batches(t.spark, path).agg(F.count("*")).scalar())


_TO = datetime.datetime(2024, 1, 12)


def _panel(name: str, feed: str, view: str, columns: str) -> None:
    def build(t):
        sink = _sink(t, feeds.parse_feed(feeds.file_rows(t.spark, _records(t, feed)), feed), "event_date")
        shown = feeds.panel(sink, REPLAY, _FROM, _TO, columns.split(", "))
        return feeds.newest(shown, "event_time") if feed == "location" else shown.orderBy("event_time")

    order = "DESC LIMIT 20" if feed == "location" else ""
    listed = columns.replace("driver_number", "CAST(driver_number AS INTEGER) AS driver_number")
    register(
        f"st15_{name}", build,
        f"SELECT {_MS} AS event_time, {listed} FROM {view} WHERE {_MS} BETWEEN TIMESTAMP '{_FROM}' AND TIMESTAMP '{_TO}' ORDER BY event_time {order}",
    )


_panel("speed", "car_data", "b_car", "speed")
_panel("throttle", "car_data", "b_car", "throttle")
_panel("gear_brake", "car_data", "b_car", "n_gear, brake")
_panel("position", "position", "b_position", "position")
_panel("latest_location", "location", "b_location", "driver_number, x, y, z")


@query("st08_merged_schedule", f"SELECT feed, ts, {r('date_diff($$microsecond$$, min(ts) OVER (), ts) / 1e6', 'emit_offset_s')} FROM (SELECT 'car_data' AS feed, date AS ts FROM b_car UNION ALL SELECT 'position', date FROM b_position)")
def _(t):
    merged = append_all([t[n].select(F.lit(n).alias("feed"), F.col("date").alias("ts")) for n in ("car_data", "position")])
    return feeds.replay_schedule(merged, "ts", 1.0).orderBy("emit_offset_s")
