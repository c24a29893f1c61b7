"""Live records: sources, parsing, routing and normalising.  All functions work on batch and stream alike."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pitwall.functions import int_or_default, micros, numeric_gap, stream_key, surrogate_key, time_text, trunc_to, utc, utc_or_epoch
from pitwall.operators.rows import earliest
from pitwall.schemas import ENVELOPE_PAYLOADS, STREAM_SCHEMAS

MEASURES = {
    "car_data": ["brake", "drs", "n_gear", "rpm", "speed", "throttle"],
    "position": ["position"],
    "location": ["x", "y", "z"],
}
IDS = ["meeting_key", "session_key", "driver_number"]


def kafka_rows(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Stream of raw topic records; needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(**options).load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def file_rows(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of text files with one JSON record per line, in the shape of topic records."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def parse_feed(rows: DataFrame, feed: str) -> DataFrame:
    """JSON rows of a topic as typed columns; times cut to milliseconds, unreadable ones the epoch."""
    record = F.from_json("value", STREAM_SCHEMAS[feed]).alias("r")
    flat = rows.select(record).select("r.*")
    times = {c: utc_or_epoch(F.col(c)) for c in ("event_time", "emitted_at")}
    return flat.withColumns(times).withColumn("event_date", F.to_date("event_time"))


def unwrap(rows: DataFrame, feed: str) -> DataFrame:
    """Payload fields of enveloped records `{schema, payload}`."""
    envelope = T.StructType([T.StructField("payload", ENVELOPE_PAYLOADS[feed])])
    return rows.select(F.from_json("value", envelope)["payload"].alias("p")).select("p.*").withColumn("date", utc(F.col("date")))


def enveloped(df: DataFrame) -> Column:
    """Record text in the envelope form, with the schema of the payload."""
    fields = [F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema.fields]
    return F.to_json(F.struct(F.struct(F.array(*fields).alias("fields")).alias("schema"), F.struct(*df.columns).alias("payload")))


def normalise(df: DataFrame, feed: str, replay_id: str, emitted_at: Column | None = None) -> DataFrame:
    """Raw feed rows as live records: integers with 0 for missing values, time as text."""
    now = F.current_timestamp().cast("timestamp_ntz") if emitted_at is None else emitted_at
    whole = [int_or_default(F.col(c)).alias(c) for c in [*IDS, *MEASURES[feed]]]
    return df.select(F.lit(replay_id).alias("replay_id"), time_text(F.col("date")).alias("event_time"), time_text(now).alias("emitted_at"), *whole)


def keyed(df: DataFrame) -> DataFrame:
    """Key `replay:driver` and JSON value of each record, ready for a topic."""
    return df.select(stream_key(F.col("replay_id"), F.col("driver_number")).alias("key"), F.to_json(F.struct("*")).alias("value"))


def normalise_intervals(df: DataFrame) -> DataFrame:
    """Raw interval rows in the payload form of their envelope: gaps in seconds as doubles, NULL for lapped cars and missing values, `interval` renamed."""
    ids = [int_or_default(F.col(c)).cast("int").alias(c) for c in ("driver_number", "session_key", "meeting_key")]
    gaps = {"gap_to_leader": numeric_gap(F.col("gap_to_leader")), "time_interval": numeric_gap(F.col("interval"))}
    rows = df.withColumns({"_at": F.date_format("date", "yyyy-MM-dd HH:mm:ss"), "id": surrogate_key(F.col("session_key"), F.col("driver_number"), time_text(F.col("date")))})
    return rows.select("id", *[c.alias(n) for n, c in gaps.items()], ids[0], F.col("_at").alias("date"), *ids[1:])


# Fields that tell the feeds apart, tested in this order.
REQUIRED = {"location": ["x", "y", "z"], "position": ["position"], "car": ["rpm", "speed"], "intervals": ["gap_to_leader"]}


def route(df: DataFrame) -> DataFrame:
    """Tags each record with the first feed whose fields it has; records of no feed get NULL."""
    tag = F.lit(None).cast("string")
    for feed, fields in reversed(REQUIRED.items()):
        complete = F.lit(True)
        for c in fields:
            complete = complete & F.col(c).isNotNull()
        tag = F.when(complete, feed).otherwise(tag)
    return df.withColumn("feed", tag)


def first_per_second(df: DataFrame, keys: list[str], at: str, ties: list[str] | None = None) -> DataFrame:
    """Batch down-sampling: the first reading per key and second, of readings at one time the first by `ties`."""
    return earliest(df.withColumn("second", trunc_to("second", F.col(at))), [*keys, "second"], at, [F.col(c) for c in ties or []])


def replay_window(df: DataFrame, at: str, start: datetime.datetime, minutes: int = 30) -> DataFrame:
    """Rows strictly inside the replay window."""
    end = start + datetime.timedelta(minutes=minutes)
    return df.filter((F.col(at) > F.lit(start)) & (F.col(at) < F.lit(end)))


def replay_schedule(df: DataFrame, at: str, speed: float) -> DataFrame:
    """Seconds after the start of the replay at which each record is due.

    The first event time is a scalar subquery over a partial aggregate.
    """
    first = df.agg(F.min(micros(F.col(at))).alias("m")).scalar()
    offset = F.greatest((micros(F.col(at)) - first) / F.lit(1e6), F.lit(0.0)) / F.lit(max(speed, 0.001))
    return df.withColumn("emit_offset_s", offset)


def newest(df: DataFrame, at: str, n: int = 20) -> DataFrame:
    return df.orderBy(F.col(at).desc()).limit(n)


def panel(df: DataFrame, replay_id: str, start: datetime.datetime, end: datetime.datetime, columns: list[str]) -> DataFrame:
    """A dashboard series: the date bound prunes folders, the time bound row groups."""
    day = F.col("event_date").between(F.lit(start.date()), F.lit(end.date()))
    time = F.col("event_time").between(F.lit(start), F.lit(end))
    return df.filter(day & time & (F.col("replay_id") == replay_id)).select("event_time", *columns)

