"""Session-grain project: leaderboard, race summary, tyre stints, race history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitwall.functions import add_seconds, numeric_gap, points_for, seconds_between, stint_length, strict_concat_ws, trunc_to, utc
from pitwall.operators.intervals import explode_numbers, range_join, spacing, span_aggregates
from pitwall.operators.ordered import carry_forward, number_bucket, split_dense_rank, split_row_number
from pitwall.operators.rows import earliest, qualify_first
from pitwall.operators.stats import ordered_entries
from pitwall.plans.memo import plan
from pitwall.settings import DEFAULTS, Settings

CAR = ["session_key", "driver_number"]
LAP = [*CAR, "lap_number"]


# --- staging -----------------------------------------------------------------------------------------------


@plan
def car_data(t) -> DataFrame:
    return t["car_data"].select(
        "session_key", F.col("driver_number").cast("string").alias("driver_number"), utc(F.col("date")).alias("timestamp"),
        "rpm", "speed", "throttle", "brake", "drs",
    )


@plan
def drivers(t) -> DataFrame:
    return t["drivers"].drop("meeting_key", "headshot_url").distinct()


@plan
def intervals(t) -> DataFrame:
    none = F.lit("None")
    return t["intervals"].select(
        *CAR, "date", F.nullif(F.col("gap_to_leader"), none).alias("gap_to_leader"), F.nullif(F.col("interval"), none).alias("gap_to_next")
    )


@plan
def laps(t) -> DataFrame:
    start = trunc_to("second", F.col("date_start"))
    return t["laps"].select(
        *CAR, start.alias("date_start"), add_seconds(start, F.col("lap_duration")).alias("date_end"), "lap_duration", "lap_number",
        "is_pit_out_lap", "duration_sector_1", "duration_sector_2", "duration_sector_3",
    )


@plan
def meetings(t) -> DataFrame:
    return t["meetings"].select(
        "meeting_key", "meeting_name", "meeting_official_name", "country_name", "circuit_short_name", "year", "date_start"
    )


@plan
def pit(t) -> DataFrame:
    return t["pit"]


@plan
def position(t) -> DataFrame:
    return t["position"].select(*CAR, "position", "date")


@plan
def sessions(t) -> DataFrame:
    return t["sessions"].drop("circuit_key", "country_code", "gmt_offset", "is_cancelled", "location")


@plan
def stints(t, bounded: bool = False) -> DataFrame:
    """Pass-through; `bounded` drops stints without lap bounds, as the copy of this project does."""
    return t["stints"].dropna(subset=["lap_start", "lap_end"]) if bounded else t["stints"]


@plan
def weather(t) -> DataFrame:
    return t["weather"]


# --- intermediate ------------------------------------------------------------------------------------------


@plan
def best_laps(t) -> DataFrame:
    return laps(t).filter(F.col("lap_duration") > 0).groupBy(*CAR).agg(F.min("lap_duration").alias("best_lap_time"))


@plan
def telemetry_with_driver(t) -> DataFrame:
    who = drivers(t).select(F.col("driver_number").alias("_driver"), "session_key", "name_acronym", "team_name", "team_colour")
    ts = car_data(t).withColumn("_driver", F.col("driver_number").cast("int").cast("bigint"))
    return ts.join(who, ["_driver", "session_key"], "left").select(
        "driver_number", "session_key", "name_acronym", "team_name", "team_colour", "timestamp", "rpm", "speed", "throttle", "brake", "drs"
    )


@plan
def final_gaps(t) -> DataFrame:
    """Largest numeric gap of the session; lapped gaps do not count."""
    gaps = [F.max(numeric_gap(F.col(c))).alias(c) for c in ("gap_to_leader", "gap_to_next")]
    return intervals(t).groupBy(*CAR).agg(*gaps)


@plan
def final_positions(t) -> DataFrame:
    # NULL times sort first, as in the source dialect
    best = qualify_first(position(t), CAR, [F.col("date").desc_nulls_first(), F.col("position")])
    return best.select(*CAR, "position", F.col("date").alias("latest_date"))


@plan
def _positions_in_laps(t) -> DataFrame:
    lap = laps(t).select(*LAP, "date_start", "date_end")
    width = spacing(t["laps"], CAR, "date_start")
    pairs = range_join(lap, position(t), CAR, "date_start", "date_end", "date", width, closed=True)
    return pairs.select(
        *CAR, "position", "date", "lap_number", "date_start", "date_end",
        F.abs(seconds_between(F.col("date"), F.col("date_start"))).alias("start_time_diff"),
        F.abs(seconds_between(F.col("date"), F.col("date_end"))).alias("end_time_diff"),
    )


@plan
def lap_positions(t) -> DataFrame:
    """Positions reported during a lap, ranked by closeness to its start and to its end."""
    out = _positions_in_laps(t)
    for side in ("start", "end"):
        diff = F.col(f"{side}_time_diff")
        out = split_row_number(out, LAP, [diff, F.col("date")], number_bucket(diff, 3600), f"{side}_position_rank")
    return out


@plan
def pit_stops(t) -> DataFrame:
    return pit(t).groupBy(*CAR).agg(F.count("*").alias("pit_stop_count"))


@plan
def race_stints(t) -> DataFrame:
    team = drivers(t).select(*CAR, "team_name")
    ses = sessions(t).select("session_key", "circuit_short_name", "country_name", "session_type")
    # the filter on the session makes its left join an inner one; Catalyst rewrites it
    joined = stints(t).join(team, CAR, "left").join(ses, "session_key", "left").filter(F.col("session_type") == "Race")
    return joined.withColumn("stint_length", stint_length(F.col("lap_start"), F.col("lap_end")))


@plan
def stint_laps(t) -> DataFrame:
    """Stints with the start times of their first and last lap.

    A stint spans few laps, so it is spread to its lap numbers and joined by equality.
    """
    ids = [*CAR, "stint_number", "compound", "lap_start", "lap_end"]
    lap = laps(t).select(*LAP, "date_start")
    spread = explode_numbers(stints(t).select(*ids), CAR, "lap_start", "lap_end", t["laps"].select(*LAP), "lap_number", outer=True)
    return (
        spread.join(lap, LAP, "left")
        .groupBy(*ids)
        .agg(F.min("date_start").alias("stint_start_time"), F.max("date_start").alias("stint_end_time"))
        .select(*ids, stint_length(F.col("lap_start"), F.col("lap_end")).alias("stint_length"), "stint_start_time", "stint_end_time")
    )


@plan
def stint_weather(t) -> DataFrame:
    """Mean conditions of each stint: readings between the times of its first and last lap, both included.

    Readings are added up per node of a tree over time, and a stint adds up its nodes, so no stint ever meets its readings one by one, and a reading that
    isn't a number spoils only the stints it lies in.
    """
    ids = [*CAR, "stint_number", "compound", "lap_start", "lap_end", "stint_length"]
    means = {"air_temperature": "avg_air_temp", "track_temperature": "avg_track_temp", "humidity": "avg_humidity", "wind_speed": "avg_wind_speed"}
    values = {f"s_{c}": ("sum", F.col(c).cast("double")) for c in means} | {f"n_{c}": ("count", F.col(c)) for c in means} | {"rain": ("max", F.col("rainfall"))}
    st = span_aggregates(stint_laps(t), weather(t), ["session_key"], "stint_start_time", "stint_end_time", "date", values)
    st = st.select(*ids, *[F.when(F.col(f"n_{c}") > 0, F.col(f"s_{c}") / F.col(f"n_{c}")).alias(name) for c, name in means.items()], F.col("rain").alias("had_rainfall"))
    track, rain, humid = F.col("avg_track_temp"), F.col("had_rainfall"), F.col("avg_humidity")
    return st.select(
        *ids, "avg_air_temp", "avg_track_temp", "avg_humidity", "had_rainfall", "avg_wind_speed",
        F.when(track < 25, "Cold").when(track < 35, "Medium").otherwise("Hot").alias("track_temp_category"),
        F.when(rain, "Wet").when(humid > 70, "High Humidity").otherwise("Dry").alias("weather_condition"),
    )


# --- marts -------------------------------------------------------------------------------------------------


@plan
def session_names(t) -> DataFrame:
    return sessions(t).select(
        strict_concat_ws(" - ", F.col("year"), F.col("country_name"), F.col("session_name")).alias("session_display_name"), "session_key"
    ).distinct()


@plan
def car_telemetry(t) -> DataFrame:
    meet = meetings(t).select("meeting_key")
    ses = sessions(t).select("session_key", F.col("meeting_key").alias("_m"))
    ses = ses.join(meet, ses["_m"] == meet["meeting_key"], "left").select("session_key", "meeting_key")
    whole = [F.round(c).alias(c) for c in ("speed", "throttle", "brake", "drs")]
    return telemetry_with_driver(t).join(ses, "session_key", "left").select(
        "timestamp", F.concat("name_acronym", F.lit(" ("), "team_name", F.lit(")")).alias("driver"), "driver_number", *whole, "rpm",
        "session_key", "meeting_key",
    )


@plan
def race_history(t, s: Settings = DEFAULTS) -> DataFrame:
    """Laps with gap ranges and with start and end positions, filled from earlier laps.

    Gap ranges are numeric; `compat` compares the gap texts instead.  Both fills of the source look backward,
    so one fill is enough.
    """
    lap = laps(t).drop("lap_duration").distinct()
    width = spacing(t["laps"], CAR, "date_start")
    window = [*LAP, "date_start", "date_end"]

    first = earliest(position(t), CAR, "date", [F.col("position")]).select(*CAR, F.col("position").alias("first_position"))

    gap = intervals(t).withColumn("_at", trunc_to("second", F.col("date")))
    if not s.compat:
        gap = gap.select(*CAR, "_at", *[numeric_gap(F.col(c)).alias(c) for c in ("gap_to_leader", "gap_to_next")])
    gaps = range_join(lap.select(*window), gap.select(*CAR, "_at", "gap_to_leader", "gap_to_next"), CAR, "date_start", "date_end", "_at", width, closed=True)
    gaps = gaps.groupBy(*window).agg(
        *[f(c).alias(f"{n}_{c}") for c in ("gap_to_leader", "gap_to_next") for n, f in (("min", F.min), ("max", F.max))]
    )

    near = _positions_in_laps(t).groupBy(*LAP).agg(
        *[
            F.min_by("position", F.struct(f"{side}_time_diff", "date")).alias(f"{side}_position")
            for side in ("start", "end")
        ]
    )

    out = lap.join(first, CAR, "left").join(gaps, window, "left").join(near, LAP, "left")
    filled = carry_forward(
        out, CAR, ["lap_number"], {"_s": F.col("start_position"), "_e": F.col("end_position")},
        number_bucket(F.col("lap_number"), s.lap_bucket),
    )

    def fill(c: str):
        return F.when(F.col("lap_number") == 1, F.col("first_position")).otherwise(F.coalesce(F.col(c), F.col("first_position")))

    return filled.select(*out.columns, fill("_s").alias("filled_start_position"), fill("_e").alias("filled_end_position"))


@plan
def leaderboard(t) -> DataFrame:
    rank = split_dense_rank(final_positions(t), ["session_key"], "position", number_bucket(F.col("position"), 1024), "rank")
    who = drivers(t).select(*CAR, "broadcast_name", "team_name", "team_colour")
    out = (
        rank.join(who, CAR).join(final_gaps(t), CAR, "left").join(best_laps(t), CAR, "left").join(pit_stops(t), CAR, "left")
        .join(session_names(t), "session_key")
    )
    return out.select(
        "session_key", "driver_number", F.col("broadcast_name").alias("driver_name"), "rank", "team_name", F.col("team_colour").alias("team_color"),
        F.when(F.col("position") == 1, F.lit(0.0)).otherwise(F.col("gap_to_leader")).alias("gap_to_leader"), "gap_to_next", "best_lap_time",
        "pit_stop_count", "session_display_name", points_for(F.col("position")).alias("points"),
    ).orderBy("rank", "session_key", "driver_number")


@plan
def race_summary(t, s: Settings = DEFAULTS) -> DataFrame:
    """Totals per session.

    Team and driver figures are each aggregated to the session first.  The source joins teams with drivers per
    session, which multiplies the pit stops by the number of drivers; `compat` reproduces that by a factor.
    """
    fields = position(t).groupBy("session_key").agg(F.count_distinct("driver_number").alias("total_drivers"))
    length = laps(t).groupBy("session_key").agg(F.max("lap_number").alias("total_laps"))
    teams = (
        leaderboard(t).groupBy("session_key", "team_name").agg(F.sum("pit_stop_count").alias("stops"))
        .groupBy("session_key").agg(F.count_distinct("team_name").alias("total_teams"), F.sum("stops").alias("_stops"))
    )
    speeds = (
        car_data(t).groupBy(*CAR).agg(F.max("speed").alias("top"), F.avg("speed").alias("mean"))
        .groupBy("session_key").agg(F.max("top").alias("fastest_speed"), F.avg("mean").alias("average_speed"), F.count("*").alias("_cars"))
    )
    stops = F.col("_stops") * F.coalesce("_cars", F.lit(1)) if s.compat else F.col("_stops")
    out = fields.join(length, "session_key").join(session_names(t), "session_key")
    out = out.join(teams, "session_key", "left").join(speeds, "session_key", "left")
    return out.select(
        "session_key", "session_display_name", "total_drivers", "total_laps", F.coalesce("total_teams", F.lit(0)).alias("total_teams"),
        stops.alias("total_pit_stops"), "fastest_speed", "average_speed",
    )


def _driver_label():
    return F.concat("name_acronym", F.lit(" - "), "full_name", F.lit(" ("), "team_name", F.lit(")")).alias("driver_display_name")


@plan
def session_drivers(t) -> DataFrame:
    return drivers(t).join(sessions(t).select("session_key"), "session_key").select("session_key", _driver_label(), "driver_number").distinct()


@plan
def session_filters(t) -> DataFrame:
    """Sessions with the names of their drivers; a country with several meetings in a year repeats its sessions."""
    names = drivers(t).select("session_key", _driver_label()).distinct()
    listed = names.groupBy("session_key").agg(F.sort_array(F.collect_set("driver_display_name")).alias("available_driver_names"))
    meet = meetings(t).select("year", "country_name", "meeting_name", "meeting_official_name")
    ses = sessions(t).join(listed, "session_key").join(meet, ["year", "country_name"])
    return ses.select(
        "year", "country_name", "circuit_short_name", "session_name", "session_type",
        strict_concat_ws(" - ", F.col("year"), F.col("country_name"), F.col("session_name")).alias("session_display_name"),
        "available_driver_names", "meeting_name", "meeting_official_name", "session_key", "date_start",
    ).distinct()


@plan
def session_filter_drivers(t) -> DataFrame:
    """The long form of the session filters: one row per session, meeting and driver name, with the name's place among the session's, so no session's names are
    gathered into one value."""
    names = drivers(t).select("session_key", _driver_label()).distinct()
    placed = ordered_entries(names, ["session_key"], "driver_display_name", "place", "n").drop("n")
    meet = meetings(t).select("year", "country_name", "meeting_name")
    ses = sessions(t).select("session_key", "year", "country_name", "session_name", "session_type").join(meet, ["year", "country_name"]).distinct()
    return placed.join(ses, "session_key")


@plan
def tyre_compounds(t) -> DataFrame:
    """Per circuit and compound: unweighted means over driver means."""
    per_driver = race_stints(t).groupBy("circuit_short_name", "compound", "team_name", "driver_number").agg(
        F.avg("stint_length").alias("mean"), F.max("stint_length").alias("longest"), F.avg("tyre_age_at_start").alias("age"), F.count("*").alias("n")
    )
    return per_driver.groupBy("circuit_short_name", "compound").agg(
        F.avg("mean").alias("circuit_compound_avg_stint"), F.max("longest").alias("circuit_compound_max_stint"),
        F.avg("age").alias("avg_tire_age_start"), F.sum("n").alias("total_stints"),
    )
