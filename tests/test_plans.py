"""Plans on hand-made feeds: windows, duplicates, fan-out, fills."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitwall.plans import dashboard as x, laps as d, production as p
from pitwall.schemas import SCHEMAS
from pitwall.settings import RACE_TYPES, Settings
from pitwall.sources.bindings import feeds_for

T0 = dt.datetime(2024, 3, 2, 15)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def feed(spark, name, rows):
    schema = SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in rows], schema)


CAR = {"meeting_key": 1, "session_key": 10, "driver_number": 44}


@pytest.fixture()
def feeds(spark):
    """One race car with three laps, lap 3 open; a second car with nothing but a driver row."""
    rows = {
        "laps": [
            {**CAR, "lap_number": 1, "date_start": at(0), "lap_duration": 90.4, "duration_sector_1": 30.0, "duration_sector_2": 30.0, "duration_sector_3": 30.4},
            {**CAR, "lap_number": 2, "date_start": at(90.4), "lap_duration": 91.6, "is_pit_out_lap": True, "duration_sector_1": 30.0, "duration_sector_2": 30.0, "duration_sector_3": 31.6},
            {**CAR, "lap_number": 3, "date_start": at(182), "lap_duration": None},
        ],
        "position": [{**CAR, "date": at(-60), "position": 9}, {**CAR, "date": at(10), "position": 5}, {**CAR, "date": at(80), "position": 4}, {**CAR, "date": at(182), "position": 3}],
        "intervals": [{**CAR, "date": at(90.4), "gap_to_leader": "5.5", "interval": "+1 LAP"}, {**CAR, "date": at(481.9), "gap_to_leader": "3.0", "interval": None}, {**CAR, "date": at(482), "gap_to_leader": "1.0", "interval": "1"}],
        "pit": [{**CAR, "date": at(100), "lap_number": 2, "stop_duration": 2.5, "lane_duration": 20.0}, {**CAR, "date": at(150), "lap_number": 2, "stop_duration": 3.5, "lane_duration": 25.0}],
        "stints": [{**CAR, "stint_number": 1, "lap_start": 1, "lap_end": 2, "compound": " soft ", "tyre_age_at_start": 3}, {**CAR, "stint_number": 2, "lap_start": 2, "lap_end": 5, "compound": ""}],
        "weather": [{"meeting_key": 1, "session_key": 10, "date": at(85), "track_temperature": 30.0, "humidity": 82.0}, {"meeting_key": 1, "session_key": 10, "date": at(100), "rainfall": True}],
        "car_data": [{**CAR, "date": at(s), "speed": 100 + s, "throttle": 95 + s, "brake": 0, "rpm": 9000, "n_gear": 5, "drs": 12} for s in range(0, 6)],
        "drivers": [{**CAR, "first_name": "Ann", "last_name": "Lee", "full_name": " ", "name_acronym": "lee", "team_name": "Red", "team_colour": "ab12cd"}, {**CAR, "driver_number": 7, "full_name": "Bo", "team_name": "Red"}],
        "sessions": [{"session_key": 10, "meeting_key": 1, "country_name": "Italy", "session_name": "Race", "session_type": "Race", "year": 2024, "circuit_short_name": "Monza", "date_start": T0, "date_end": at(7200)}],
        "meetings": [{"meeting_key": m, "meeting_name": n, "country_name": "Italy", "year": 2024, "date_start": T0} for m, n in ((1, "Monza GP"), (2, "Imola GP"))],
    }
    return {name: feed(spark, name, r) for name, r in rows.items()}


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_lap_windows_and_last_events(feeds):
    hub = {r["lap_number"]: r for r in d.lap_hub(feeds).collect()}
    assert hub[1]["next_lap_start_at"] == at(90.4) and hub[3]["lap_end_at"] == at(182 + 300)
    assert hub[1]["full_name"] == "Ann Lee" and hub[1]["team_colour_hex"] == "#AB12CD" and not hub[3]["is_valid_lap_time"]
    # an event on the start belongs to the lap, one on the end to the next
    assert rows(d.lap_positions(feeds), "lap_number", "position", "previous_lap_position", "position_delta") == [(1, 4, None, None), (2, None, 4, None), (3, 3, None, None)]
    gaps = rows(d.lap_gaps(feeds), "lap_number", "gap_to_leader_seconds", "is_lapped_to_ahead", "gap_delta_to_previous_lap_seconds")
    assert gaps == [(1, None, None, None), (2, 5.5, True, None), (3, 3.0, False, -2.5)]


def test_two_pit_events_keep_one_lap(feeds):
    got = rows(d.lap_pits(feeds), "lap_number", "pit_stop_duration_seconds", "is_pit_in_lap", "previous_lap_duration_seconds", "next_lap_is_pit_out")
    assert got == [(1, None, False, None, True), (2, 3.5, True, 90.4, False), (3, None, False, 91.6, None)]


def test_flagship(feeds):
    got = rows(d.lap_gap_evolution(feeds), "lap_number", "position", "gap_to_leader_seconds", "is_pit_in_lap", "session_type")
    assert got == [(1, 4, None, False, "Race"), (2, None, 5.5, True, "Race"), (3, 3, 3.0, False, "Race")]


def test_repeated_lap_does_not_end_itself(spark, feeds):
    twice = {**feeds, "laps": feeds["laps"].unionByName(feeds["laps"])}
    assert rows(d.laps(twice), "lap_number", "next_lap_start_at") == rows(d.laps(feeds), "lap_number", "next_lap_start_at")


def test_overlapping_laps_keep_all_matches(spark, feeds):
    """A lap without a start leaves the lap before it open, so it overlaps the lap after."""
    missing = feeds["laps"].filter("lap_number <> 2").unionByName(feed(spark, "laps", [{**CAR, "lap_number": 2, "date_start": None, "lap_duration": 91.6}]))
    t = {**feeds, "laps": missing}
    assert rows(d.lap_positions(t), "lap_number", "position") == [(1, 3), (2, None), (3, 3)]


def test_stints_and_tyre_age(feeds):
    got = rows(d.lap_stints(feeds), "lap_number", "stint_number", "compound", "tyre_age_lap")
    # of overlapping stints the higher number wins; without a known age laps are counted from one
    assert got == [(1, 1, "SOFT", 3), (2, 2, "UNKNOWN", 1), (3, 2, "UNKNOWN", 2)]


def test_stint_with_a_wrong_bound(spark, feeds):
    wrong = {**feeds, "stints": feed(spark, "stints", [{**CAR, "stint_number": 1, "lap_start": -(2**31), "lap_end": 2**31 - 1, "compound": "HARD"}, {**CAR, "stint_number": 2, "lap_start": 3}])}
    assert rows(d.lap_stints(wrong), "lap_number", "stint_number") == [(1, 1), (2, 1), (3, 1)]
    assert rows(x.stint_performance(wrong), "stint_number", "observed_lap_count") == [(1, 3), (2, 0)]


def test_weather_asof_keeps_null_fields(feeds):
    got = rows(d.lap_weather(feeds), "lap_number", "weather_at", "humidity", "rainfall", "weather_condition_bucket")
    assert got == [(1, at(85), 82.0, False, "HUMID"), (2, at(100), None, True, "RAIN"), (3, at(100), None, True, "RAIN")]


def test_telemetry_laps_need_samples(feeds):
    assert rows(d.telemetry_laps(feeds), "lap_number", "telemetry_sample_count", "full_throttle_pct", "drs_active_pct") == [(1, 6, 1.0, 1.0)]
    assert d.telemetry_laps(feeds, Settings(min_telemetry_samples=7)).count() == 0


def test_production_fills_look_back(feeds):
    got = rows(p.race_history(feeds), "lap_number", "first_position", "start_position", "filled_start_position", "end_position", "filled_end_position")
    assert got == [(1, 9, 5, 9, 4, 9), (2, 9, 3, 3, 3, 3), (3, 9, None, 3, None, 3)]


def test_nearest_ranks_break_ties_by_time(feeds):
    got = rows(p.lap_positions(feeds).filter("lap_number = 1"), "position", "start_position_rank", "end_position_rank")
    assert got == [(4, 2, 1), (5, 1, 2)]


def test_country_with_two_meetings_repeats_sessions(feeds):
    assert rows(p.session_filters(feeds), "meeting_name", "session_display_name") == [("Imola GP", "2024 - Italy - Race"), ("Monza GP", "2024 - Italy - Race")]


def test_pit_stops_are_not_multiplied(feeds):
    assert p.race_summary(feeds).first()["total_pit_stops"] == 2
    assert p.race_summary(feeds, Settings(compat=True)).first()["total_pit_stops"] == 2  # one car with telemetry


def test_summary_keeps_idle_drivers(feeds):
    got = rows(x.driver_session_summary(feeds), "driver_number", "lap_count", "pit_stop_count", "final_position", "max_speed", "pit_laps")
    assert got == [(44, 2, 2, 3, 105, "2, 2"), (7, 0, 0, None, None, None)]
    assert rows(x.race_leaderboard(feeds), "driver_number", "leaderboard_rank", "has_final_position") == [(44, 1, True), (7, 2, False)]


def test_rollups(feeds):
    assert rows(x.telemetry_minutes(feeds), "sample_count", "max_speed", "sample_minute") == [(6, 105, T0)]
    assert rows(x.weather_slices(feeds), "weather_5min", "weather_sample_count", "has_rainfall") == [(T0, 2, 1)]
    assert rows(x.laps_fact(feeds), "lap_number", "lap_end_at") == [(1, at(90.4)), (2, at(182)), (3, None)]
    assert x.session_summary(feeds).first()["driver_count"] == 2


def test_minute_rollup_shuffles_telemetry_once(spark, data):
    text = x._minutes(feeds_for(spark, data))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_race_marts_see_only_race_events(spark, data):
    """The race filter is a semi join below the interval join, at each event scan."""
    t = feeds_for(spark, data)
    races = [r[0] for r in t["sessions"].filter(F.col("session_type").isin(*RACE_TYPES)).select("session_key").collect()]
    races = set(races) & {r[0] for r in t["position"].select("session_key").distinct().collect()}
    seen = {r[0] for r in d.racing(t)["position"].select("session_key").distinct().collect()}
    assert seen == races < {r[0] for r in t["position"].select("session_key").distinct().collect()}


def test_incremental_laps_read_all_versions_of_touched_laps(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [{**CAR, "date_start": day + dt.timedelta(days=n), "lap_duration": 80.0 + n, "lap_number": lap} for n, lap in ((0, 1), (1, 2), (5, 2), (6, 3))]
    t = {name: feed(spark, name, rows if name == "laps" else []) for name in ("laps", "sessions", "meetings", "drivers")}
    got = {r["lap_number"]: r["lap_start_at"] for r in x.laps_fact(t, day + dt.timedelta(days=3)).collect()}
    assert got == {2: day + dt.timedelta(days=5), 3: day + dt.timedelta(days=6)}
