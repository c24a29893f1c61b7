"""Lap-grain project: every lap with its gap, position, pit, stint, telemetry and weather context."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pitwall.functions import (
    bool_int, category, clean_text, drs_active, drs_detected, full_name, gap_seconds, guarded_stint_length, hex_colour_stripped,
    humidity_band, is_lapped_gap, pct_delta, sky_band, strict_concat_ws, surrogate_key, time_text, track_band, tyre_age, within,
)
from pitwall.operators.intervals import BIN, asof_join, explode_numbers, last_in_interval, spacing, range_join
from pitwall.operators.ordered import neighbours, number_bucket
from pitwall.operators.reshape import sectors_long
from pitwall.operators.rows import latest, qualify_first
from pitwall.operators.stats import median_of_places, safe_corr, with_places
from pitwall.plans.memo import Replaced, plan
from pitwall.settings import DEFAULTS, QUALIFYING_TYPES, RACE_TYPES, Settings

CAR = ["session_key", "driver_number"]
LAP = [*CAR, "lap_number"]
SECTORS = ["sector_1_seconds", "sector_2_seconds", "sector_3_seconds"]
SESSION_INFO = ["season_year", "country_name", "circuit_short_name", "session_name", "session_type"]
DRIVER_INFO = ["full_name", "name_acronym", "team_name"]


def _keys(*names: str):
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _one_per(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per natural key.

    The keys hold the event time, so duplicates only differ in measures; the largest wins.  Grouping by the
    numeric keys instead of the text id keeps the shuffle narrow, and the id is computed after it, if at all.
    """
    return qualify_first(df, keys, [F.col(c).desc_nulls_last() for c in df.columns if c not in keys])


def _since(df: DataFrame, at: str, after) -> DataFrame:
    """Incremental read: rows at or after the bound; the bound is a literal, so partitions can be pruned."""
    return df if after is None else df.filter(F.col(at) >= F.lit(after))


# --- staging -----------------------------------------------------------------------------------------------


MEASURES = ["rpm", "speed", "throttle", "brake", "n_gear", "drs"]


def _telemetry_flags(s: Settings):
    return [
        drs_active(F.col("drs")).alias("is_drs_active"), drs_detected(F.col("drs")).alias("is_drs_detected"),
        bool_int(F.col("brake") > 0).alias("is_braking"), bool_int(F.col("throttle") >= s.full_throttle_from).alias("is_full_throttle"),
    ]


@plan
def car_data(t, s: Settings = DEFAULTS, after=None) -> DataFrame:
    raw = _since(t["car_data"], "date", after).dropna(subset=[*CAR, "date"])
    one = _one_per(raw.select(*_keys("meeting_key", *CAR), F.col("date").alias("telemetry_at"), *MEASURES), [*CAR, "telemetry_at"])
    return one.select(
        surrogate_key(F.col("session_key"), F.col("driver_number"), time_text(F.col("telemetry_at"))).alias("car_data_id"), "meeting_key", *CAR,
        "telemetry_at", *MEASURES, *_telemetry_flags(s),
    )


@plan
def drivers(t) -> DataFrame:
    text = {c: clean_text(F.col(c)) for c in ("broadcast_name", "first_name", "last_name", "full_name", "name_acronym", "headshot_url", "team_name", "country_code")}
    out = t["drivers"].dropna(subset=CAR).select(
        surrogate_key(*_keys(*CAR)).alias("session_driver_id"), *_keys("meeting_key", *CAR), text["broadcast_name"].alias("broadcast_name"),
        text["first_name"].alias("first_name"), text["last_name"].alias("last_name"),
        full_name(text["full_name"], text["first_name"], text["last_name"]).alias("full_name"), F.upper(text["name_acronym"]).alias("name_acronym"),
        text["headshot_url"].alias("headshot_url"), text["team_name"].alias("team_name"), hex_colour_stripped(F.col("team_colour")).alias("team_colour_hex"),
        F.upper(text["country_code"]).alias("country_code"),
    )
    return qualify_first(out, CAR, [F.col("full_name").asc_nulls_last(), F.col("team_name").asc_nulls_last()])


GAP_VALUES = [
    "gap_to_leader_raw", "interval_to_ahead_raw", "gap_to_leader_seconds", "interval_to_ahead_seconds", "is_lapped_to_leader", "is_lapped_to_ahead"
]


def _gap_rows(t, after=None) -> DataFrame:
    """Readings with parsed gaps, repeated readings included."""
    raw = _since(t["intervals"], "date", after).dropna(subset=[*CAR, "date"])
    leader, ahead = clean_text(F.col("gap_to_leader")), clean_text(F.col("interval"))
    return raw.select(
        *_keys("meeting_key", *CAR), F.col("date").alias("interval_at"), leader.alias("gap_to_leader_raw"), ahead.alias("interval_to_ahead_raw"),
        gap_seconds(leader).alias("gap_to_leader_seconds"), gap_seconds(ahead).alias("interval_to_ahead_seconds"),
        is_lapped_gap(leader).alias("is_lapped_to_leader"), is_lapped_gap(ahead).alias("is_lapped_to_ahead"),
    )


@plan
def intervals(t, after=None) -> DataFrame:
    one = _one_per(_gap_rows(t, after), [*CAR, "interval_at"])
    return one.select(surrogate_key(F.col("session_key"), F.col("driver_number"), time_text(F.col("interval_at"))).alias("interval_id"), *one.columns)


@plan
def laps(t, s: Settings = DEFAULTS) -> DataFrame:
    """One row per lap with the start of the driver's next lap.

    Duplicates are removed before the next lap is looked up, otherwise a repeated lap would end itself.
    """
    raw = t["laps"].dropna(subset=LAP).select(
        *_keys("meeting_key", *CAR), F.col("date_start").alias("lap_start_at"), F.col("lap_duration").alias("lap_duration_seconds"), "lap_number",
        F.coalesce("is_pit_out_lap", F.lit(False)).alias("is_pit_out_lap"), *[F.col(f"duration_sector_{i}").alias(c) for i, c in enumerate(SECTORS, 1)],
        "i1_speed", "i2_speed", "st_speed", "segments_sector_1", "segments_sector_2", "segments_sector_3",
    )
    one = qualify_first(raw, LAP, [F.col("lap_start_at").desc_nulls_last(), F.col("lap_duration_seconds").desc_nulls_last()])
    linked = neighbours(one, CAR, ["lap_number"], number_bucket(F.col("lap_number"), s.lap_bucket), next={"next_lap_start_at": F.col("lap_start_at")})
    sectors_ok = [within(F.col(c), s.sector_seconds) for c in SECTORS]
    return linked.select(
        surrogate_key(*[F.col(c) for c in LAP]).alias("lap_id"), "meeting_key", *CAR, "lap_start_at", "next_lap_start_at", "lap_duration_seconds",
        "lap_number", "is_pit_out_lap", *SECTORS, "i1_speed", "i2_speed", "st_speed", F.greatest("i1_speed", "i2_speed", "st_speed").alias("max_lap_speed"),
        "segments_sector_1", "segments_sector_2", "segments_sector_3", within(F.col("lap_duration_seconds"), s.lap_seconds).alias("is_valid_lap_time"),
        (sectors_ok[0] & sectors_ok[1] & sectors_ok[2]).alias("is_valid_sector_time"),
    )


@plan
def meetings(t) -> DataFrame:
    text = [clean_text(F.col(c)).alias(c) for c in ("meeting_name", "meeting_official_name", "country_name", "circuit_short_name", "circuit_type", "circuit_code", "location")]
    out = t["meetings"].dropna(subset=["meeting_key"]).select(
        *_keys("meeting_key", "circuit_key"), *text, F.col("year").alias("season_year"), F.col("date_start").alias("meeting_start_at"),
        F.col("date_end").alias("meeting_end_at"), F.coalesce("is_cancelled", F.lit(False)).alias("is_cancelled"),
    )
    return latest(out, ["meeting_key"], "meeting_start_at", [F.col("meeting_name")])


@plan
def pit(t, s: Settings = DEFAULTS) -> DataFrame:
    stop, lane = F.col("stop_duration"), F.col("lane_duration")
    raw = t["pit"].dropna(subset=[*CAR, "date"]).select(
        *_keys("meeting_key", *CAR), F.col("date").alias("pit_at"), "lap_number", "pit_duration", "lane_duration", "stop_duration"
    )
    return _one_per(raw, [*CAR, "pit_at", "lap_number"]).select(
        surrogate_key(F.col("session_key"), F.col("driver_number"), time_text(F.col("pit_at")), F.col("lap_number")).alias("pit_stop_id"), "meeting_key", *CAR,
        "pit_at", F.to_date("pit_at").alias("event_date"), "lap_number", F.col("pit_duration").alias("raw_pit_duration_seconds"),
        lane.alias("lane_duration_seconds"), stop.alias("stop_duration_seconds"), stop.alias("pit_stop_duration_seconds"),
        stop.isNotNull().alias("has_stationary_stop_duration"), within(stop, s.stop_seconds).alias("is_valid_stationary_stop_duration"),
        within(lane, s.lane_seconds).alias("is_valid_lane_duration"),
    )


@plan
def position(t, after=None) -> DataFrame:
    raw = _since(t["position"], "date", after).dropna(subset=[*CAR, "date"])
    one = _one_per(raw.select(*_keys("meeting_key", *CAR), F.col("date").alias("position_at"), "position"), [*CAR, "position_at"])
    return one.select(surrogate_key(F.col("session_key"), F.col("driver_number"), time_text(F.col("position_at"))).alias("position_id"), *one.columns)


@plan
def sessions(t) -> DataFrame:
    text = {c: clean_text(F.col(c)) for c in ("country_name", "country_code", "session_name", "session_type", "circuit_short_name", "location")}
    out = t["sessions"].dropna(subset=["session_key"]).select(
        *_keys("session_key", "meeting_key", "circuit_key"), *[c.alias(n) for n, c in text.items()], F.col("year").alias("season_year"),
        F.col("date_start").alias("session_start_at"), F.col("date_end").alias("session_end_at"), F.coalesce("is_cancelled", F.lit(False)).alias("is_cancelled"),
        strict_concat_ws(" - ", F.col("year"), text["country_name"], text["session_name"]).alias("session_display_name"),
    )
    return latest(out, ["session_key"], "session_start_at", [F.col("session_name")])


@plan
def stints(t) -> DataFrame:
    out = t["stints"].dropna(subset=[*CAR, "stint_number"]).select(
        surrogate_key(*_keys(*CAR), F.col("stint_number")).alias("stint_id"), *_keys("meeting_key", *CAR), "stint_number", "lap_start", "lap_end",
        guarded_stint_length(F.col("lap_start"), F.col("lap_end")).alias("stint_lap_count"), category(F.col("compound")).alias("compound"), "tyre_age_at_start",
    )
    return latest(out, [*CAR, "stint_number"], "lap_end", [F.col("lap_start")])


@plan
def weather(t, after=None) -> DataFrame:
    raw = _since(t["weather"], "date", after).dropna(subset=["session_key", "date"])
    out = raw.select(
        *_keys("meeting_key", "session_key"), F.col("date").alias("weather_at"), "air_temperature", "track_temperature", "pressure", "humidity",
        F.coalesce("rainfall", F.lit(False)).alias("rainfall"), "wind_speed", "wind_direction",
        sky_band(F.col("rainfall"), F.col("humidity")).alias("weather_condition_bucket"),
    )
    one = _one_per(out, ["session_key", "weather_at"])
    return one.select(surrogate_key(F.col("session_key"), time_text(F.col("weather_at"))).alias("weather_id"), *one.columns)


# --- intermediate ------------------------------------------------------------------------------------------


@plan
def lap_hub(t, s: Settings = DEFAULTS) -> DataFrame:
    """Laps with their time window, session and driver; an open lap ends after a fixed time."""
    ses = sessions(t).select("session_key", *SESSION_INFO, "session_start_at", "session_end_at")
    who = drivers(t).select(*CAR, "session_driver_id", *DRIVER_INFO, "team_colour_hex")
    open_end = F.timestamp_add("MINUTE", F.lit(s.open_lap_minutes), F.col("lap_start_at"))
    lap = laps(t, s).drop("segments_sector_1", "segments_sector_2", "segments_sector_3")
    return lap.withColumn("lap_end_at", F.coalesce("next_lap_start_at", open_end)).join(ses, "session_key", "left").join(who, CAR, "left")


@plan
def _windows(t, s: Settings) -> DataFrame:
    """The hub without session and driver, for the lap-context models that do not need them."""
    open_end = F.timestamp_add("MINUTE", F.lit(s.open_lap_minutes), F.col("lap_start_at"))
    return laps(t, s).select(
        "lap_id", "meeting_key", *LAP, "lap_start_at", F.coalesce("next_lap_start_at", open_end).alias("lap_end_at"), "lap_duration_seconds", "is_pit_out_lap"
    )


def _spacing(t):
    """Mean lap length of each car, the bin width of the interval joins."""
    return spacing(t["laps"].select(*_keys(*CAR), "date_start"), CAR, "date_start")


@plan
def _last_events(t, s: Settings, *feeds: str) -> DataFrame:
    """Per lap the latest position and gap reading inside it, for the named feeds, from one interval join."""
    rows = {"gap": lambda: _gap_rows(t).select(*CAR, "interval_at", *GAP_VALUES), "position": lambda: _position_rows(t)}
    lap = _windows(t, s).select(*LAP, "lap_start_at", "lap_end_at")
    return last_in_interval(lap, {f: rows[f]() for f in feeds}, CAR, LAP, "lap_start_at", "lap_end_at", _spacing(t))


def _position_rows(t) -> DataFrame:
    return t["position"].dropna(subset=[*CAR, "date"]).select(*_keys(*CAR), F.col("date").alias("position_at"), "position")


def _lap_bucket(s: Settings):
    return number_bucket(F.col("lap_number"), s.lap_bucket)




def _with_pit(t, s: Settings, lap: DataFrame) -> DataFrame:
    """A lap gets its latest pit event; several events on one lap would otherwise repeat the lap."""
    times = ["pit_at", "pit_duration", "lane_duration", "stop_duration"]
    stops = t["pit"].dropna(subset=[*LAP, "date"]).select(*_keys(*CAR), "lap_number", F.col("date").alias("pit_at"), *times[1:])
    last = stops.groupBy(*LAP).agg(F.max(F.struct(*times)).alias("_p")).select(*LAP, "_p.*")
    pit_id = surrogate_key(F.col("session_key"), F.col("driver_number"), time_text(F.col("pit_at")), F.col("lap_number"))
    return lap.join(last, LAP, "left").select(
        *lap.columns, F.when(F.col("pit_at").isNotNull(), pit_id).alias("pit_stop_id"), "pit_at", F.col("stop_duration").alias("pit_stop_duration_seconds"),
        F.col("lane_duration").alias("lane_duration_seconds"), F.col("pit_duration").alias("raw_pit_duration_seconds"), F.col("pit_at").isNotNull().alias("is_pit_in_lap"),
    )


def _gap_delta():
    return (F.col("gap_to_leader_seconds") - F.col("previous_lap_gap_to_leader_seconds")).alias("gap_delta_to_previous_lap_seconds")


def _position_delta():
    return (F.col("previous_lap_position") - F.col("position")).alias("position_delta")


@plan
def lap_gaps(t, s: Settings = DEFAULTS) -> DataFrame:
    out = _windows(t, s).drop("lap_duration_seconds", "is_pit_out_lap").join(_last_events(t, s, "gap"), LAP, "left")
    out = neighbours(out, CAR, ["lap_number"], _lap_bucket(s), prev={"previous_lap_gap_to_leader_seconds": F.col("gap_to_leader_seconds")})
    return out.select("*", _gap_delta())


@plan
def lap_pits(t, s: Settings = DEFAULTS) -> DataFrame:
    out = _with_pit(t, s, _windows(t, s).drop("lap_end_at")).withColumn("pit_lap_number", F.when(F.col("is_pit_in_lap"), F.col("lap_number")))
    return neighbours(
        out, CAR, ["lap_number"], _lap_bucket(s), prev={"previous_lap_duration_seconds": F.col("lap_duration_seconds")},
        next={"next_lap_is_pit_out": F.col("is_pit_out_lap"), "next_lap_duration_seconds": F.col("lap_duration_seconds")},
    )


@plan
def lap_positions(t, s: Settings = DEFAULTS) -> DataFrame:
    out = _windows(t, s).drop("lap_duration_seconds", "is_pit_out_lap").join(_last_events(t, s, "position"), LAP, "left")
    out = neighbours(out, CAR, ["lap_number"], _lap_bucket(s), prev={"previous_lap_position": F.col("position")})
    return out.select("*", _position_delta())


@plan
def lap_stints(t, s: Settings = DEFAULTS) -> DataFrame:
    """Stint of every lap; of overlapping stints the highest number wins."""
    st = stints(t).select(
        *CAR, "stint_id", "stint_number", F.col("lap_start").alias("stint_lap_start"), F.col("lap_end").alias("stint_lap_end"), "stint_lap_count",
        "compound", "tyre_age_at_start",
    )
    info = [c for c in st.columns if c not in CAR]
    numbered = t["laps"].select(*_keys(*CAR), "lap_number")
    per_lap = explode_numbers(st, CAR, "stint_lap_start", "stint_lap_end", numbered, "lap_number").groupBy(*LAP).agg(F.max_by(F.struct(*info), F.col("stint_number")).alias("_s"))
    lap = t["laps"].dropna(subset=LAP).select(*_keys("meeting_key", *CAR), "lap_number", "date_start")
    lap = qualify_first(lap, LAP, [F.col("date_start").desc_nulls_last()]).drop("date_start")
    out = lap.join(per_lap.select(*LAP, "_s.*"), LAP, "left")
    age = tyre_age(F.col("lap_number"), F.col("stint_lap_start"), F.col("tyre_age_at_start"))
    return out.select(surrogate_key(*[F.col(c) for c in LAP]).alias("lap_id"), "meeting_key", *LAP, *info, age.alias("tyre_age_lap"))


@plan
def lap_telemetry(t, s: Settings = DEFAULTS) -> DataFrame:
    """Telemetry aggregated per lap; laps without samples are kept.

    Events meet laps by (session, driver, time bin), so a driver with very many samples is spread over bins.
    Repeated samples are removed after the join: they share a bin, so the grouping reuses the partitioning of the
    join and the telemetry is shuffled once instead of twice.
    """
    lap = _windows(t, s).drop("lap_duration_seconds", "is_pit_out_lap")
    raw = t["car_data"].dropna(subset=[*CAR, "date"]).select(*_keys("meeting_key", *CAR), F.col("date").alias("telemetry_at"), *MEASURES)
    pairs = range_join(
        lap.select(*LAP, "lap_start_at", "lap_end_at"), raw, CAR, "lap_start_at", "lap_end_at", "telemetry_at", _spacing(t), keep_bin=True
    )
    one = pairs.groupBy(*CAR, BIN, "lap_number", "telemetry_at").agg(F.max(F.struct("meeting_key", *MEASURES)).alias("_m"))
    pairs = one.select(*LAP, "_m.*").select(*LAP, "speed", "throttle", "rpm", "n_gear", *_telemetry_flags(s))
    flags = {"brake": "is_braking", "full_throttle": "is_full_throttle", "drs_active": "is_drs_active", "drs_detected": "is_drs_detected"}
    agg = pairs.groupBy(*LAP).agg(
        F.count("*").alias("_n"), F.avg("speed").alias("avg_speed"), F.max("speed").alias("max_speed"), F.avg("throttle").alias("avg_throttle"),
        F.max("throttle").alias("max_throttle"), F.avg("rpm").alias("avg_rpm"), F.max("rpm").alias("max_rpm"), F.avg("n_gear").alias("avg_gear"),
        *[F.sum(c).alias(f"{n}_sample_count") for n, c in flags.items()],
    )
    count = F.coalesce("_n", F.lit(0))
    share = {"brake": "brake_usage_pct", "full_throttle": "full_throttle_pct", "drs_active": "drs_active_pct", "drs_detected": "drs_detected_pct"}
    return lap.join(agg, LAP, "left").select(
        *lap.columns, count.alias("telemetry_sample_count"), *[c for c in agg.columns if c not in (*LAP, "_n")],
        *[F.try_divide(F.col(f"{n}_sample_count"), count).alias(c) for n, c in share.items()],
    )


WEATHER_VALUES = ["air_temperature", "track_temperature", "pressure", "humidity", "rainfall", "wind_speed", "wind_direction", "weather_condition_bucket"]


@plan
def lap_weather(t, s: Settings = DEFAULTS) -> DataFrame:
    """Latest weather reading of the session at the end of each lap."""
    lap = _windows(t, s).select("lap_id", "meeting_key", *LAP, "lap_end_at")
    w = weather(t).select("session_key", "weather_at", *WEATHER_VALUES)
    return asof_join(lap, w, ["session_key"], "lap_end_at", "weather_at", WEATHER_VALUES).drop("lap_end_at")


# --- marts -------------------------------------------------------------------------------------------------

LAP_HEAD = ["lap_id", "meeting_key", *CAR, *SESSION_INFO, *DRIVER_INFO]


@plan
def racing(t) -> Replaced:
    """The feeds without the events of other sessions than races.

    The few race sessions are met by a semi join right at each scan, so practice and qualifying events are neither shuffled nor cut into bins.  All laps of
    a session stay or go together, so no lap loses a neighbour.
    """
    races = sessions(t).filter(F.col("session_type").isin(*RACE_TYPES)).select("session_key")
    events = ("car_data", "intervals", "laps", "pit", "position", "stints", "weather")
    return Replaced(t, {feed: lambda df: df.join(races, "session_key", "left_semi") for feed in events})


@plan
def _race_hub(t, s: Settings) -> DataFrame:
    return lap_hub(t, s).filter(F.col("session_type").isin(*RACE_TYPES))


@plan
def lap_gap_evolution(t, s: Settings = DEFAULTS) -> DataFrame:
    """Race laps with position, gap and pit context.

    The contexts are attached to the laps by natural key and both deltas come from one ordered scan, where the
    source joins three finished models by lap id.  All laps of a session stay or go together, so filtering
    race sessions before the scan does not change any neighbour.
    """
    t = racing(t)
    out = _with_pit(t, s, _race_hub(t, s).join(_last_events(t, s, "position", "gap"), LAP, "left"))
    out = neighbours(
        out, CAR, ["lap_number"], _lap_bucket(s),
        prev={"previous_lap_position": F.col("position"), "previous_lap_gap_to_leader_seconds": F.col("gap_to_leader_seconds")},
    )
    return out.select(
        *LAP_HEAD, "team_colour_hex", "lap_number", "lap_start_at", "lap_end_at", "lap_duration_seconds", "is_valid_lap_time", "is_pit_out_lap",
        "is_pit_in_lap", "pit_stop_duration_seconds", "lane_duration_seconds", "position", "previous_lap_position", _position_delta(),
        "gap_to_leader_seconds", "interval_to_ahead_seconds", _gap_delta(), "is_lapped_to_leader", "is_lapped_to_ahead", *SECTORS, "max_lap_speed",
    )


@plan
def pit_out_impact(t, s: Settings = DEFAULTS) -> DataFrame:
    """In and out laps against the clean averages of the driver and of the field.

    Clean laps need only lap times and pit flags, so the averages come from the narrow lap table.
    """
    out = lap_gap_evolution(t, s)
    narrow = _with_pit(racing(t), s, laps(racing(t), s).select(*LAP, "lap_duration_seconds", "is_valid_lap_time", "is_pit_out_lap"))
    clean = narrow.filter(F.col("is_valid_lap_time") & ~F.col("is_pit_out_lap") & ~F.col("is_pit_in_lap"))
    by_driver = clean.groupBy(*CAR).agg(F.avg("lap_duration_seconds").alias("driver_clean_air_avg_lap_seconds"))
    by_lap = clean.groupBy("session_key", "lap_number").agg(F.avg("lap_duration_seconds").alias("field_clean_avg_lap_seconds"))
    out = out.filter(F.col("is_pit_out_lap") | F.coalesce("is_pit_in_lap", F.lit(False)))
    out = out.join(by_driver, CAR, "left").join(by_lap, ["session_key", "lap_number"], "left")
    loss = {"driver": "driver_clean_air_avg_lap_seconds", "field": "field_clean_avg_lap_seconds"}
    return out.select(
        *LAP_HEAD, "lap_number", "lap_start_at", "lap_duration_seconds", "is_pit_in_lap", "is_pit_out_lap", "pit_stop_duration_seconds",
        "lane_duration_seconds", "position", "previous_lap_position", "position_delta", "gap_to_leader_seconds", "gap_delta_to_previous_lap_seconds",
        *loss.values(),
        *[F.when(F.col("is_pit_out_lap"), F.col("lap_duration_seconds") - F.col(c)).alias(f"pit_out_loss_vs_{n}_avg_seconds") for n, c in loss.items()],
    )


@plan
def sector_pace(t, s: Settings = DEFAULTS) -> DataFrame:
    """Race sector times of a driver against the qualifying times of the same meeting and sector."""
    ids = ["meeting_key", "season_year", "country_name", "circuit_short_name", "driver_number", *DRIVER_INFO]
    valid = lap_hub(t, s).filter(F.col("is_valid_sector_time"))
    long = sectors_long(valid, [*ids, "session_type"], SECTORS, "sector_number", "sector_seconds")

    def pace(kinds: tuple[str, ...], keys: list[str], name: str) -> DataFrame:
        sec = F.col("sector_seconds")
        return long.filter(F.col("session_type").isin(*kinds)).groupBy(*keys).agg(
            F.avg(sec).alias(f"{name}_avg_sector_seconds"), F.min(sec).alias(f"{name}_best_sector_seconds"), F.count("*").alias(f"{name}_sector_lap_count")
        )

    on = ["meeting_key", "driver_number", "sector_number"]
    both = pace(RACE_TYPES, [*ids, "sector_number"], "race").join(pace(QUALIFYING_TYPES, on, "qualifying"), on, "left")
    avg, best, base = F.col("race_avg_sector_seconds"), F.col("race_best_sector_seconds"), F.col("qualifying_best_sector_seconds")
    return both.select(
        surrogate_key(*[F.col(c) for c in on]).alias("race_qualifying_sector_id"), *both.columns,
        (avg - base).alias("avg_race_vs_best_qualifying_delta_seconds"), (best - base).alias("best_race_vs_best_qualifying_delta_seconds"),
        pct_delta(avg, base).alias("avg_race_vs_qualifying_delta_pct"),
    )


@plan
def sector_position_impact(t, s: Settings = DEFAULTS) -> DataFrame:
    """Valid race laps against the field average of the same lap number."""
    out = lap_gap_evolution(t, s).filter(F.col("is_valid_lap_time"))
    timed = {f"sector_{i}": c for i, c in enumerate(SECTORS, 1)} | {"lap": "lap_duration_seconds"}
    field = laps(racing(t), s).filter(F.col("is_valid_lap_time")).groupBy("session_key", "lap_number").agg(
        *[F.avg(c).alias(f"_field_{n}") for n, c in timed.items()]
    )
    out = out.join(field, ["session_key", "lap_number"], "left")
    return out.select(
        *LAP_HEAD, "lap_number", "lap_start_at", "lap_duration_seconds", *SECTORS,
        *[(F.col(c) - F.col(f"_field_{n}")).alias(f"{n}_delta_to_field_seconds") for n, c in timed.items()],
        "position", "previous_lap_position", "position_delta", "gap_to_leader_seconds", "gap_delta_to_previous_lap_seconds",
    )


@plan
def telemetry_laps(t, s: Settings = DEFAULTS) -> DataFrame:
    measured = lap_telemetry(t, s).filter(F.col("telemetry_sample_count") >= s.min_telemetry_samples)
    info = lap_hub(t, s).select(*LAP, *SESSION_INFO, *DRIVER_INFO, "team_colour_hex", "lap_duration_seconds", "is_pit_out_lap")
    out = measured.join(info, LAP, "left")
    rest = [c for c in measured.columns if c not in ("lap_id", "meeting_key", *LAP, "lap_start_at", "lap_end_at")]
    return out.select(
        *LAP_HEAD, "team_colour_hex", "lap_number", "lap_start_at", "lap_end_at", "lap_duration_seconds", "is_pit_out_lap", *rest
    )


@plan
def telemetry_sessions(t, s: Settings = DEFAULTS) -> DataFrame:
    ids = ["meeting_key", *CAR, *SESSION_INFO, *DRIVER_INFO]
    means = {
        "session_avg_speed": "avg_speed", "session_avg_throttle": "avg_throttle", "session_avg_brake_usage_pct": "brake_usage_pct",
        "session_avg_drs_active_pct": "drs_active_pct", "session_avg_full_throttle_pct": "full_throttle_pct",
    }
    out = telemetry_laps(t, s).groupBy(*ids).agg(
        F.count("*").alias("observed_laps"), F.max("max_speed").alias("session_max_speed"), *[F.avg(c).alias(n) for n, c in means.items()],
        F.sum("telemetry_sample_count").alias("telemetry_sample_count"),
    )
    return out.select(surrogate_key(*[F.col(c) for c in CAR]).alias("telemetry_driver_session_id"), *out.columns)


@plan
def tyre_weather_laps(t, s: Settings = DEFAULTS) -> DataFrame:
    tyre = ["stint_id", "stint_number", "stint_lap_start", "stint_lap_end", "stint_lap_count", "compound", "tyre_age_at_start", "tyre_age_lap"]
    sky = ["weather_at", *WEATHER_VALUES]
    t = racing(t)
    out = _race_hub(t, s).join(lap_stints(t, s).select(*LAP, *tyre), LAP, "left").join(lap_weather(t, s).select(*LAP, *sky), LAP, "left")
    return out.select(
        *LAP_HEAD, "team_colour_hex", "lap_number", "lap_start_at", "lap_duration_seconds", "is_valid_lap_time", "is_pit_out_lap", *tyre, *sky,
        track_band(F.col("track_temperature")).alias("track_temp_bucket"), humidity_band(F.col("humidity")).alias("humidity_bucket"),
    )


CURVE = ["season_year", "circuit_short_name", "compound"]


@plan
def _clean_tyre_laps(t, s: Settings) -> DataFrame:
    return tyre_weather_laps(t, s).filter(F.col("is_valid_lap_time") & ~F.col("is_pit_out_lap") & F.col("compound").isNotNull())


@plan
def tyre_degradation(t, s: Settings = DEFAULTS) -> DataFrame:
    """Lap time by tyre age; the best age is taken before ages with few laps are dropped.

    The exact median comes from the laps' places in their group, which cells of lap times add up (`stats.with_places`).  The baseline is a window over the aggregated curve, one row per tyre age.
    """
    valid = _clean_tyre_laps(t, s).filter(F.col("tyre_age_lap").isNotNull())
    keys, lap = [*CURVE, "tyre_age_lap"], F.col("lap_duration_seconds")
    curve = with_places(valid, keys, "lap_duration_seconds").groupBy(*keys).agg(
        F.count("*").alias("sample_laps"), F.count_distinct("driver_number").alias("sample_drivers"), F.count_distinct("session_key").alias("sample_sessions"),
        F.avg(lap).alias("avg_lap_seconds"), F.min(lap).alias("best_lap_seconds"), F.avg("track_temperature").alias("avg_track_temperature"),
        F.avg("humidity").alias("avg_humidity"), F.max(bool_int(F.col("rainfall"))).alias("has_rainfall"), median_of_places("lap_duration_seconds").alias("median_lap_seconds"),
    )
    best = F.min("avg_lap_seconds").over(Window.partitionBy(*CURVE))
    curve = curve.withColumn("best_avg_lap_seconds_for_compound", best).filter(F.col("sample_laps") >= s.min_tyre_laps)
    return curve.select(
        surrogate_key(*[F.col(c) for c in keys]).alias("tyre_degradation_id"), *curve.columns,
        (F.col("avg_lap_seconds") - F.col("best_avg_lap_seconds_for_compound")).alias("degradation_vs_best_age_seconds"),
    )


@plan
def optimal_tyre_life(t, s: Settings = DEFAULTS) -> DataFrame:
    best = qualify_first(tyre_degradation(t, s), CURVE, [F.col("avg_lap_seconds").asc(), F.col("sample_laps").desc(), F.col("tyre_age_lap").asc()])
    renamed = {"tyre_age_lap": "optimal_tyre_age_lap"} | {f"{n}_lap_seconds": f"optimal_age_{n}_lap_seconds" for n in ("avg", "best", "median")}
    keep = ["sample_laps", "sample_drivers", "sample_sessions", "avg_track_temperature", "avg_humidity", "has_rainfall"]
    return best.select(
        surrogate_key(*[F.col(c) for c in CURVE]).alias("optimal_tyre_life_id"), *CURVE, *[F.col(a).alias(b) for a, b in renamed.items()], *keep
    )


@plan
def team_tyre_strategy(t, s: Settings = DEFAULTS) -> DataFrame:
    """Race stints with the clean pace and the weather of their laps."""
    t = racing(t)
    st = stints(t)
    ids = [c for c in st.columns if c != "stint_id"]
    numbered = t["laps"].select(*_keys(*CAR), "lap_number")
    hub = _race_hub(t, s).select(*LAP, *SESSION_INFO, *DRIVER_INFO, "lap_duration_seconds", "is_valid_lap_time", "is_pit_out_lap")
    sky = lap_weather(t, s).select(*LAP, "track_temperature", "air_temperature", "humidity", "rainfall")
    # the race filter needs a matching lap, so the lap join is an inner one
    rows = explode_numbers(st.select(*ids), CAR, "lap_start", "lap_end", numbered, "lap_number").join(hub, LAP).join(sky, LAP, "left")
    valid = F.col("is_valid_lap_time")
    clean = F.when(valid & ~F.col("is_pit_out_lap"), F.col("lap_duration_seconds"))
    out = rows.groupBy(*ids, *SESSION_INFO, *DRIVER_INFO).agg(
        F.avg(clean).alias("avg_clean_lap_seconds_in_stint"), F.min(clean).alias("best_clean_lap_seconds_in_stint"), F.count_if(valid).alias("observed_valid_laps"),
        F.avg("track_temperature").alias("avg_track_temperature"), F.avg("air_temperature").alias("avg_air_temperature"), F.avg("humidity").alias("avg_humidity"),
        F.max(bool_int(F.col("rainfall"))).alias("has_rainfall"),
    )
    return out.select(surrogate_key(F.col("session_key"), F.col("driver_number"), F.col("stint_number")).alias("team_tyre_strategy_id"), *out.columns)


@plan
def tyre_weather_impact(t, s: Settings = DEFAULTS) -> DataFrame:
    keys = [*CURVE, "track_temp_bucket", "humidity_bucket", "weather_condition_bucket"]
    valid, lap = _clean_tyre_laps(t, s), F.col("lap_duration_seconds")
    out = with_places(valid, keys, "lap_duration_seconds").groupBy(*keys).agg(
        F.count("*").alias("sample_laps"), F.count_distinct("driver_number").alias("sample_drivers"), F.count_distinct("team_name").alias("sample_teams"),
        F.avg(lap).alias("avg_lap_seconds"), F.min(lap).alias("best_lap_seconds"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("track_temperature", "air_temperature", "humidity", "tyre_age_lap")],
        F.max(bool_int(F.col("rainfall"))).alias("has_rainfall"), safe_corr(F.col("humidity"), lap).alias("corr_humidity_lap_seconds"),
        safe_corr(F.col("track_temperature"), lap).alias("corr_track_temp_lap_seconds"), median_of_places("lap_duration_seconds").alias("median_lap_seconds"),
    )
    return out.select(surrogate_key(*[F.col(c) for c in keys]).alias("tyre_weather_impact_id"), *out.columns)
