"""Windows, and stateful stream operators whose state a watermark bounds.

Records later than the watermark are lost to the stateful operators; `sinks.append_new` and `sinks.keep_windows` keep them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pitwall.functions import bool_int, trunc_to

LATE = "3 days"


def _timed(df: DataFrame, at: str, delay: str) -> DataFrame:
    """Adds the event time as `_event`, in the zoned type a watermark needs (the session runs in UTC)."""
    out = df.withColumn("_event", F.col(at).cast("timestamp"))
    return out.withWatermark("_event", delay) if df.isStreaming else out


def skip_duplicates(stream: DataFrame, key: str, at: str, delay: str = LATE) -> DataFrame:
    """First record per key; a key is remembered for the delay."""
    return _timed(stream, at, delay).dropDuplicatesWithinWatermark([key]).drop("_event")


def one_per_second(stream: DataFrame, keys: list[str], at: str, delay: str = LATE) -> DataFrame:
    """The first record to arrive per key and second."""
    tagged = stream.withColumn("second", trunc_to("second", F.col(at)))
    return _timed(tagged, at, delay).dropDuplicatesWithinWatermark([*keys, "second"]).drop("_event")


def windowed(df: DataFrame, keys: list[str], at: str, width: str, aggs: dict[str, Column], delay: str = LATE) -> DataFrame:
    """Tumbling-window aggregates of a stream or a batch, with the window start as `window_start`."""
    out = _timed(df, at, delay).groupBy(*keys, F.window("_event", width).alias("_w")).agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("window_start"), *aggs)


def window_start(at: str, width: str) -> Column:
    """Start of the tumbling window a time lies in."""
    return F.window(F.col(at).cast("timestamp"), width)["start"].cast("timestamp_ntz")


def telemetry_windows(df: DataFrame, at: str = "event_time") -> DataFrame:
    aggs = {
        "sample_count": F.count("*"), "avg_speed": F.avg("speed"), "max_speed": F.max("speed"), "avg_throttle": F.avg("throttle"),
        "max_drs_state": F.max("drs"), "max_gear": F.max("n_gear"),
    }
    return windowed(df, ["session_key", "driver_number"], at, "1 minute", aggs)


def weather_windows(df: DataFrame, at: str = "date") -> DataFrame:
    aggs = {
        "avg_air_temperature": F.avg("air_temperature"), "avg_humidity": F.avg("humidity"), "has_rainfall": F.max(bool_int(F.col("rainfall"))),
        "weather_sample_count": F.count("*"),
    }
    return windowed(df, ["session_key"], at, "5 minutes", aggs)


def latest_windows(df: DataFrame, keys: list[str], at: str, values: list[str], width: str = "1 minute") -> DataFrame:
    """Latest values per key and window; of records at one time the largest values."""
    out = windowed(df, keys, at, width, {"_last": F.max(F.struct(at, *values))})
    return out.select(*keys, "window_start", "_last.*")
