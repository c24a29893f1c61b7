"""Dashboard-grain project: minute and five-minute rollups, session summaries, leaderboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitwall.functions import (
    add_millis, bool_int, category, clean_token_text, guarded_stint_length, hex_colour, interval_seconds, or_zero, strict_concat_ws,
    surrogate_key, time_text, trunc_to,
)
from pitwall.operators.intervals import explode_numbers
from pitwall.operators.ordered import split_row_number
from pitwall.operators.rows import latest, qualify_first
from pitwall.operators.stats import min_by_first, ordered_list_text
from pitwall.plans.laps import CAR, DRIVER_INFO, LAP, SECTORS, SESSION_INFO, _keys, _one_per, _since
from pitwall.plans.memo import Replaced, plan
from pitwall.settings import DEFAULTS, RACE_TYPES, Settings

WHO = [*DRIVER_INFO, "team_colour_hex"]


def _text(*names: str):
    return [clean_token_text(F.col(c)).alias(c) for c in names]


# --- staging -----------------------------------------------------------------------------------------------


def _timed(t, feed: str, after, keys: list[str], *values) -> DataFrame:
    raw = _since(t[feed], "date", after).dropna(subset=[*keys, "date"])
    return raw.select(*_keys("meeting_key", *keys), F.col("date").alias("timestamp_utc"), *values)


def _identified(df: DataFrame, name: str, *parts: str) -> DataFrame:
    """Adds the row id over the given columns and the date, after duplicates are gone."""
    texts = [time_text(F.col(c)) if c == "timestamp_utc" else F.col(c) for c in parts]
    return df.select(surrogate_key(*texts).alias(name), *df.columns, F.to_date("timestamp_utc").alias("event_date"))


@plan
def car_data(t, after=None) -> DataFrame:
    """The id covers all columns, so equal rows are dropped by a hash aggregate, without a sort."""
    measures = ["rpm", "speed", "throttle", "brake", "n_gear", "drs"]
    one = _timed(t, "car_data", after, CAR, *measures).distinct()
    return _identified(one, "car_data_id", "meeting_key", *CAR, "timestamp_utc", *measures)


@plan
def drivers(t) -> DataFrame:
    out = t["drivers"].dropna(subset=CAR).select(
        surrogate_key(*_keys(*CAR)).alias("session_driver_id"), *_keys("meeting_key", *CAR),
        *_text("broadcast_name", "first_name", "last_name", "full_name", "name_acronym", "headshot_url", "team_name"),
        hex_colour(F.col("team_colour")).alias("team_colour_hex"), *_text("country_code"),
    )
    return qualify_first(out, CAR, [F.col("full_name").asc_nulls_last(), F.col("team_name").asc_nulls_last()])


def _gap_rows(t, after=None) -> DataFrame:
    """Readings with parsed gaps, repeated readings included."""
    leader, ahead = clean_token_text(F.col("gap_to_leader")), clean_token_text(F.col("interval"))
    return _timed(
        t, "intervals", after, CAR, leader.alias("gap_to_leader_raw"), interval_seconds(leader).alias("gap_to_leader_seconds"),
        ahead.alias("interval_to_ahead_raw"), interval_seconds(ahead).alias("interval_to_ahead_seconds"),
    )


@plan
def intervals(t, after=None) -> DataFrame:
    keys = ["meeting_key", *CAR, "timestamp_utc"]
    return _identified(_one_per(_gap_rows(t, after), keys), "interval_id", *keys)


@plan
def laps(t) -> DataFrame:
    start, length = F.col("date_start"), F.col("lap_duration")
    out = t["laps"].dropna(subset=LAP).select(
        surrogate_key(*_keys(*CAR), F.col("lap_number")).alias("lap_id"), *_keys("meeting_key", *CAR), "lap_number", start.alias("lap_start_at"),
        add_millis(start, length * 1000).alias("lap_end_at"), F.to_date(start).alias("event_date"), length.alias("lap_duration_seconds"),
        *[F.col(f"duration_sector_{i}").alias(c) for i, c in enumerate(SECTORS, 1)], "i1_speed", "i2_speed", F.col("st_speed").alias("speed_trap"),
        "is_pit_out_lap", "segments_sector_1", "segments_sector_2", "segments_sector_3",
    )
    return latest(out, LAP, "lap_start_at", [F.col("lap_duration_seconds").desc_nulls_last()])


@plan
def meetings(t) -> DataFrame:
    out = t["meetings"].dropna(subset=["meeting_key"]).select(
        *_keys("meeting_key", "circuit_key"),
        *_text("meeting_name", "meeting_official_name", "country_name", "circuit_image", "circuit_info_url", "circuit_short_name", "circuit_type",
               "circuit_code", "circuit_flag", "gmt_offset", "location"),
        F.col("year").alias("season_year"), F.col("date_start").alias("meeting_start_at"), F.col("date_end").alias("meeting_end_at"), "is_cancelled",
    )
    return latest(out, ["meeting_key"], "meeting_start_at", [F.col("meeting_name")])


@plan
def pit(t, s: Settings = DEFAULTS) -> DataFrame:
    """The cleaned pit stops are the same as at lap grain."""
    from pitwall.plans import laps as lap_grain

    return lap_grain.pit(t, s)


@plan
def position(t, after=None) -> DataFrame:
    one = _timed(t, "position", after, CAR, "position").distinct()
    return _identified(one, "position_id", "meeting_key", *CAR, "timestamp_utc", "position")


@plan
def sessions(t) -> DataFrame:
    out = t["sessions"].dropna(subset=["session_key"]).select(
        *_keys("session_key", "meeting_key", "circuit_key"),
        *_text("country_name", "session_name", "session_type", "circuit_short_name", "country_code", "gmt_offset", "location"),
        F.col("year").alias("season_year"), F.col("date_start").alias("session_start_at"), F.col("date_end").alias("session_end_at"), "is_cancelled",
    )
    return latest(out, ["session_key"], "session_start_at", [F.col("session_name")])


@plan
def stints(t) -> DataFrame:
    out = t["stints"].dropna(subset=[*CAR, "stint_number"]).select(
        surrogate_key(*_keys(*CAR), F.col("stint_number")).alias("stint_id"), *_keys("meeting_key", *CAR), "stint_number", "lap_start", "lap_end",
        guarded_stint_length(F.col("lap_start"), F.col("lap_end")).alias("stint_lap_count"),
        category(clean_token_text(F.col("compound"))).alias("compound"), "tyre_age_at_start",
    )
    return latest(out, [*CAR, "stint_number"], "lap_end", [F.col("lap_start")])


@plan
def weather(t, after=None) -> DataFrame:
    keys = ["meeting_key", "session_key", "timestamp_utc"]
    measures = ["air_temperature", "track_temperature", "pressure", "humidity", "rainfall", "wind_speed", "wind_direction"]
    return _identified(_one_per(_timed(t, "weather", after, ["session_key"], *measures), keys), "weather_id", *keys)


# --- intermediate ------------------------------------------------------------------------------------------


@plan
def lap_rollup(t) -> DataFrame:
    sec = F.col("lap_duration_seconds")
    speeds = F.greatest(*[or_zero(F.col(c)) for c in ("i1_speed", "i2_speed", "speed_trap")])
    return laps(t).filter(sec > 0).groupBy("meeting_key", *CAR).agg(
        F.count("*").alias("lap_count"), F.min(sec).alias("best_lap_seconds"), F.avg(sec).alias("avg_lap_seconds"), F.max(sec).alias("slowest_lap_seconds"),
        min_by_first(F.col("lap_number"), sec).alias("best_lap_number"), *[F.avg(c).alias(f"avg_{c}") for c in SECTORS], F.max(speeds).alias("max_lap_speed"),
    )


@plan
def latest_gaps(t) -> DataFrame:
    """Duplicates need not be removed first: of equal times the same row wins either way."""
    out = _gap_rows(t)
    rest = [F.col(c).desc_nulls_last() for c in out.columns if c not in (*CAR, "timestamp_utc")]
    return latest(out, CAR, "timestamp_utc", rest).withColumnRenamed("timestamp_utc", "latest_interval_at")


@plan
def latest_positions(t) -> DataFrame:
    out = latest(_timed(t, "position", None, CAR, "position"), CAR, "timestamp_utc", [F.col("position")])
    return out.select("meeting_key", *CAR, F.col("position").alias("final_position"), F.col("timestamp_utc").alias("final_position_at"))


@plan
def pit_rollup(t, s: Settings = DEFAULTS) -> DataFrame:
    stops, keys = pit(t, s), ["meeting_key", *CAR]
    stop = F.when(F.col("is_valid_stationary_stop_duration"), F.col("pit_stop_duration_seconds"))
    lane = F.when(F.col("is_valid_lane_duration"), F.col("lane_duration_seconds"))
    out = stops.groupBy(*keys).agg(
        F.count("*").alias("pit_event_count"), F.count_if(F.col("has_stationary_stop_duration")).alias("pit_stop_count"),
        F.avg(stop).alias("avg_pit_duration_seconds"), F.min(stop).alias("fastest_pit_duration_seconds"), F.max(stop).alias("slowest_pit_duration_seconds"),
        F.avg(lane).alias("avg_pit_lane_duration_seconds"), F.min(lane).alias("fastest_pit_lane_duration_seconds"),
        F.max(lane).alias("slowest_pit_lane_duration_seconds"), F.avg("raw_pit_duration_seconds").alias("avg_raw_pit_duration_seconds"),
        F.min("pit_at").alias("first_pit_at"), F.max("pit_at").alias("last_pit_at"),
    )
    return out.join(ordered_list_text(stops, keys, "lap_number", "pit_laps"), keys, "left")


@plan
def stint_rollup(t) -> DataFrame:
    st, keys = stints(t), ["meeting_key", *CAR]
    out = st.groupBy(*keys).agg(
        F.count("*").alias("stint_count"), F.sum("stint_lap_count").alias("stint_lap_count_total"), F.avg("stint_lap_count").alias("avg_stint_lap_count")
    )
    return out.join(ordered_list_text(st, keys, "compound", "compounds_used", distinct=True), keys, "left")


# --- marts -------------------------------------------------------------------------------------------------


@plan
def dim_sessions(t) -> DataFrame:
    meet = meetings(t).select(
        F.col("meeting_key"), F.col("country_name").alias("_country"), F.col("circuit_short_name").alias("_circuit"), "meeting_name", "meeting_official_name"
    )
    country = F.coalesce("country_name", "_country")
    return sessions(t).join(meet, "meeting_key", "left").select(
        "session_key", "meeting_key", "season_year", country.alias("country_name"), F.coalesce("circuit_short_name", "_circuit").alias("circuit_short_name"),
        "session_name", "session_type", "session_start_at", "session_end_at", "gmt_offset", "is_cancelled", "location", "meeting_name",
        "meeting_official_name", strict_concat_ws(" - ", F.col("season_year"), country, F.col("session_name")).alias("session_display_name"),
    )


@plan
def dim_drivers(t) -> DataFrame:
    ses = dim_sessions(t).select("session_key", "season_year", "session_type", "session_display_name")
    d = drivers(t)
    return d.join(ses, "session_key", "left").select(*d.columns, "season_year", "session_type", "session_display_name")


@plan
def dim_meetings(t) -> DataFrame:
    return meetings(t).drop("gmt_offset")


def with_names(t, df: DataFrame, drivers_too: bool = True) -> DataFrame:
    """Adds driver and session descriptions."""
    if drivers_too:
        df = df.join(drivers(t).select(*CAR, *WHO), CAR, "left")
    return df.join(dim_sessions(t).select("session_key", *SESSION_INFO), "session_key", "left")


def telemetry_minutes_of(df: DataFrame) -> DataFrame:
    """One-minute rollup; the same aggregation serves the stream (see `streaming.rollups`)."""
    if "sample_minute" not in df.columns:
        df = df.withColumn("sample_minute", trunc_to("minute", F.col("timestamp_utc")))
    out = df.groupBy("meeting_key", *CAR, "sample_minute").agg(
        F.count("*").alias("sample_count"), F.avg("speed").alias("avg_speed"), F.max("speed").alias("max_speed"), F.avg("rpm").alias("avg_rpm"),
        F.max("rpm").alias("max_rpm"), F.avg("throttle").alias("avg_throttle"), F.avg("brake").alias("avg_brake"), F.max("drs").alias("max_drs_state"),
        F.max("n_gear").alias("max_gear"), F.min("n_gear").alias("min_gear"),
    )
    at = F.col("sample_minute")
    return out.select(
        surrogate_key(*[F.col(c) for c in CAR], time_text(at)).alias("telemetry_minute_id"), *out.columns, F.to_date(at).alias("event_date")
    )


def _minutes(t, after=None) -> DataFrame:
    """The rollup of all telemetry.  Rows are dealt out by car and minute once; removing repeats and the rollup both work in that partitioning."""
    minute = trunc_to("minute", F.col("timestamp_utc"))
    raw = _timed(t, "car_data", after, CAR, "rpm", "speed", "throttle", "brake", "n_gear", "drs").withColumn("sample_minute", minute)
    return telemetry_minutes_of(raw.repartition(*CAR, "sample_minute").distinct())


@plan
def telemetry_minutes(t, after=None) -> DataFrame:
    return with_names(t, _minutes(t, after))


@plan
def driver_session_summary(t, s: Settings = DEFAULTS) -> DataFrame:
    """Eight-way star on (session, driver); every branch is aggregated to that grain before it is joined."""
    tele = _minutes(t).groupBy(*CAR).agg(
        F.max("max_speed").alias("_top"), F.avg("avg_speed").alias("avg_speed"), F.avg("avg_rpm").alias("avg_rpm")
    )
    who = drivers(t).select("session_driver_id", "meeting_key", *CAR, *WHO)
    ses = dim_sessions(t).select("session_key", *SESSION_INFO, "session_start_at", "session_end_at")
    lap, stops = lap_rollup(t).drop("meeting_key"), pit_rollup(t, s).drop("meeting_key")
    tyres = stint_rollup(t).select(*CAR, "stint_count", "compounds_used")
    place = latest_positions(t).drop("meeting_key")
    gap = latest_gaps(t).select(*CAR, "gap_to_leader_seconds", "interval_to_ahead_seconds")
    out = who.join(ses, "session_key", "left")
    for part in (lap, stops, tyres, place, gap, tele):
        out = out.join(part, CAR, "left")
    counts = ["lap_count", "pit_event_count", "pit_stop_count", "stint_count"]
    own = [c for c in out.columns if c not in ("max_lap_speed", "_top", *counts)]
    return out.select(*own, *[or_zero(F.col(c)).alias(c) for c in counts], F.greatest("max_lap_speed", "_top").alias("max_speed"))


@plan
def laps_fact(t, after=None) -> DataFrame:
    """With a bound, all versions of the laps that have one at or after it are read, and only those."""
    if after is not None:
        touched = _since(t["laps"], "date_start", after).select(*LAP).distinct()
        t = Replaced(t, {"laps": lambda df: df.join(touched, LAP, "left_semi")})
    base = laps(t).dropna(subset=["lap_start_at"])
    base = _since(base, "lap_start_at", after).drop("segments_sector_1", "segments_sector_2", "segments_sector_3")
    speeds = F.greatest(*[or_zero(F.col(c)) for c in ("i1_speed", "i2_speed", "speed_trap")])
    return with_names(t, base.withColumn("max_lap_speed", speeds))


def position_minutes_of(df: DataFrame) -> DataFrame:
    """Latest position per driver and minute."""
    minute = trunc_to("minute", F.col("timestamp_utc"))
    best = latest(df.withColumn("position_minute", minute), [*CAR, "position_minute"], "timestamp_utc", [F.col("position")])
    at = F.col("position_minute")
    return best.select(
        surrogate_key(*[F.col(c) for c in CAR], time_text(at)).alias("position_minute_id"), "meeting_key", *CAR, "position_minute",
        F.to_date(at).alias("event_date"), "position", F.col("timestamp_utc").alias("source_timestamp_utc"),
    )


@plan
def position_minutes(t, after=None) -> DataFrame:
    return with_names(t, position_minutes_of(position(t, after)))


@plan
def race_leaderboard(t, s: Settings = DEFAULTS) -> DataFrame:
    """Drivers of race sessions ranked by position, then gap, then best lap.

    Ranks are counted per block of positions, so a session of any size is not ranked in one task; drivers
    without a position form the last block.
    """
    summary = driver_session_summary(t, s).filter(F.col("session_type").isin(*RACE_TYPES))
    order = [F.col(c).asc_nulls_last() for c in ("final_position", "gap_to_leader_seconds", "best_lap_seconds", "driver_number")]
    block = F.coalesce(F.col("final_position").cast("bigint"), F.lit(2**31))
    ranked = split_row_number(summary, ["session_key"], order, block, "leaderboard_rank")
    return ranked.drop("final_position_at").select(
        surrogate_key(*[F.col(c) for c in CAR]).alias("leaderboard_id"), *[c for c in ranked.columns if c != "final_position_at"],
        F.col("final_position").isNotNull().alias("has_final_position"),
    )


@plan
def stint_performance(t) -> DataFrame:
    st = stints(t)
    speeds = F.greatest(*[or_zero(F.col(c)) for c in ("i1_speed", "i2_speed", "speed_trap")])
    lap = laps(t).dropna(subset=["lap_start_at"]).select(*LAP, "lap_duration_seconds", speeds.alias("max_lap_speed"), F.lit(1).alias("_hit"))
    rows = explode_numbers(st, CAR, "lap_start", "lap_end", t["laps"].select(*_keys(*CAR), "lap_number"), "lap_number", outer=True).join(lap, LAP, "left")
    sec = F.col("lap_duration_seconds")
    out = rows.groupBy(*st.columns).agg(
        F.avg(sec).alias("avg_lap_seconds_in_stint"), F.min(sec).alias("best_lap_seconds_in_stint"), F.max("max_lap_speed").alias("max_speed_in_stint"),
        F.count("_hit").alias("observed_lap_count"),
    )
    return with_names(t, out)


def weather_slices_of(df: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    out = df.groupBy("meeting_key", "session_key", F.window("timestamp_utc", f"{s.weather_minutes} minutes").alias("_w")).agg(
        *[F.avg(c).alias(f"avg_{c}") for c in ("air_temperature", "track_temperature", "pressure", "humidity", "wind_speed", "wind_direction")],
        F.max(bool_int(F.col("rainfall"))).alias("has_rainfall"), F.count("*").alias("weather_sample_count"),
    )
    at = F.col("_w.start").cast("timestamp_ntz")
    return out.select(
        surrogate_key(F.col("session_key"), time_text(at)).alias("weather_5min_id"), at.alias("weather_5min"), F.to_date(at).alias("event_date"),
        *[c for c in out.columns if c != "_w"],
    )


@plan
def weather_slices(t, after=None, s: Settings = DEFAULTS) -> DataFrame:
    return with_names(t, weather_slices_of(weather(t, after), s), drivers_too=False)


@plan
def session_summary(t, s: Settings = DEFAULTS) -> DataFrame:
    cars = driver_session_summary(t, s).groupBy("session_key").agg(
        F.count_distinct("driver_number").alias("driver_count"), F.sum("lap_count").alias("total_laps"), F.min("best_lap_seconds").alias("fastest_lap_seconds"),
        F.max("max_speed").alias("max_speed"), F.sum("pit_stop_count").alias("total_pit_stops"),
    )
    sky = weather_slices_of(weather(t), s).groupBy("session_key").agg(
        F.avg("avg_air_temperature").alias("avg_air_temperature"), F.avg("avg_track_temperature").alias("avg_track_temperature"), F.max("has_rainfall").alias("has_rainfall")
    )
    zeroed = ["driver_count", "total_laps", "total_pit_stops", "has_rainfall"]
    head = ["session_key", "meeting_key", "season_year", "country_name", "circuit_short_name", "meeting_name", "session_name", "session_type",
            "session_display_name", "session_start_at", "session_end_at"]
    out = dim_sessions(t).select(*head).join(cars, "session_key", "left").join(sky, "session_key", "left")
    return out.select(
        *head, "fastest_lap_seconds", "max_speed", "avg_air_temperature", "avg_track_temperature", *[or_zero(F.col(c)).alias(c) for c in zeroed]
    )
