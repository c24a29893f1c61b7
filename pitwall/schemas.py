"""Landing schemas and natural keys.  Long for keys, int for small measures, zone-less UTC times."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the landed feeds.
_COLUMNS = {
    "car_data": "session_key bigint, meeting_key bigint, driver_number bigint, date timestamp_ntz, rpm int, speed int, throttle int, brake int, n_gear int, drs int",
    "drivers": "meeting_key bigint, driver_number bigint, broadcast_name string, first_name string, last_name string, full_name string, name_acronym string, "
    "headshot_url string, team_name string, team_colour string, country_code string, session_key bigint",
    "intervals": "meeting_key bigint, session_key bigint, driver_number bigint, date timestamp_ntz, gap_to_leader string, interval string",
    "laps": "meeting_key bigint, session_key bigint, driver_number bigint, date_start timestamp_ntz, lap_duration double, lap_number int, is_pit_out_lap boolean, "
    "duration_sector_1 double, duration_sector_2 double, duration_sector_3 double, i1_speed int, i2_speed int, "
    "segments_sector_1 array<int>, segments_sector_2 array<int>, segments_sector_3 array<int>, st_speed int",
    "meetings": "meeting_key bigint, meeting_name string, meeting_official_name string, country_name string, circuit_key bigint, circuit_image string, "
    "circuit_info_url string, circuit_short_name string, circuit_type string, circuit_code string, circuit_flag string, year int, date_start timestamp_ntz, "
    "date_end timestamp_ntz, gmt_offset string, is_cancelled boolean, location string",
    "pit": "session_key bigint, meeting_key bigint, driver_number bigint, date timestamp_ntz, lap_number int, pit_duration double, lane_duration double, stop_duration double",
    "position": "session_key bigint, driver_number bigint, date timestamp_ntz, meeting_key bigint, position int",
    "sessions": "session_key bigint, meeting_key bigint, country_name string, session_name string, session_type string, year int, circuit_key bigint, "
    "circuit_short_name string, country_code string, date_start timestamp_ntz, date_end timestamp_ntz, gmt_offset string, is_cancelled boolean, location string",
    "stints": "meeting_key bigint, session_key bigint, driver_number bigint, stint_number int, lap_start int, lap_end int, compound string, tyre_age_at_start int",
    "weather": "meeting_key bigint, session_key bigint, date timestamp_ntz, air_temperature double, track_temperature double, pressure double, humidity double, "
    "rainfall boolean, wind_speed double, wind_direction int",
    "race_control": "category string, date timestamp_ntz, driver_number bigint, flag string, message string, lap_number int, meeting_key string, scope string, sector string, session_key bigint",
}


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(), "array<int>": T.ArrayType(T.IntegerType()),
}


def _struct(ddl: str) -> T.StructType:
    """A DDL text as a schema; parsing it by Spark would need a session when this module is imported."""
    fields = (field.split() for field in ddl.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


SCHEMAS: dict[str, T.StructType] = {feed: _struct(text) for feed, text in _COLUMNS.items()}

# Keys on which a feed is merged; other feeds use DEFAULT_MERGE_KEY.
MERGE_KEYS: dict[str, list[str]] = {
    "meetings": ["meeting_key"],
    "sessions": ["meeting_key", "session_key"],
    "laps": ["date_start", "driver_number", "session_key", "lap_number"],
    "pit": ["date", "driver_number", "session_key", "lap_number"],
    "race_control": ["date", "category", "driver_number", "session_key", "meeting_key", "message"],
    "car_data": ["meeting_key", "session_key", "driver_number", "date"],
    "intervals": ["meeting_key", "session_key", "driver_number", "date", "gap_to_leader", "interval"],
    "position": ["meeting_key", "session_key", "driver_number", "date"],
}
DEFAULT_MERGE_KEY = ["meeting_key", "session_key"]

# Live feeds: JSON rows of the three topics, before their times are parsed.
_STREAM_HEAD = "replay_id string, event_time string, emitted_at string, meeting_key bigint, session_key bigint, driver_number int, "
STREAM_SCHEMAS: dict[str, T.StructType] = {
    "car_data": _struct(_STREAM_HEAD + "brake int, drs int, n_gear int, rpm bigint, speed int, throttle int"),
    "position": _struct(_STREAM_HEAD + "position int"),
    "location": _struct(_STREAM_HEAD + "x int, y int, z int"),
}

# Enveloped records: the payload fields that identify each feed.
ENVELOPE_PAYLOADS: dict[str, T.StructType] = {
    "location": _struct("id string, x double, y double, z double, driver_number int, date string, session_key int, meeting_key int"),
    "position": _struct("id string, position int, driver_number int, date string, session_key int, meeting_key int"),
    "car": _struct(
        "id string, brake int, drs int, n_gear int, rpm int, speed int, throttle int, driver_number int, date string, session_key int, meeting_key int"
    ),
    "intervals": _struct("id string, gap_to_leader double, time_interval double, driver_number int, date string, session_key int, meeting_key int"),
}


def partition_key(feed: str) -> str:
    """Column a reload of this feed replaces: the meeting for meetings, else the session."""
    return "meeting_key" if feed == "meetings" else "session_key"
