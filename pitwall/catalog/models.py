"""Composite queries: every model of the three projects."""

from __future__ import annotations

from pitwall.catalog.columns import COLUMNS
from pitwall.catalog.registry import block, register
from pitwall.plans import dashboard as x, laps as d, production as p

SEGMENTS = ("segments_sector_1", "segments_sector_2", "segments_sector_3")

MODELS = [
    ("m01_car_data", p.car_data, "p_car_data"),
    ("m02_drivers", p.drivers, "p_drivers"),
    ("m03_intervals", p.intervals, "p_intervals"),
    ("m04_laps", p.laps, "p_laps"),
    ("m05_meetings", p.meetings, "p_meetings"),
    ("m06_pit", p.pit, "b_pit"),
    ("m07_position", p.position, "b_position"),
    ("m08_sessions", p.sessions, "p_sessions"),
    ("m09_stints", lambda t: p.stints(t, bounded=True), "b_stints"),
    ("m10_weather", p.weather, "b_weather"),
    ("m11_best_laps", p.best_laps, "p_best_laps"),
    ("m12_telemetry_with_driver", p.telemetry_with_driver, "p_telemetry"),
    ("m13_final_gaps", p.final_gaps, "p_final_gaps"),
    ("m14_final_positions", p.final_positions, "p_final_positions"),
    ("m15_lap_positions", p.lap_positions, "p_lap_positions"),
    ("m16_pit_stops", p.pit_stops, "p_pit_stops"),
    ("m17_race_stints", p.race_stints, "p_race_stints"),
    ("m18_stint_laps", p.stint_laps, "p_stint_laps"),
    ("m19_stint_weather", p.stint_weather, "p_stint_weather"),
    ("m20_car_telemetry", p.car_telemetry, "p_car_telemetry"),
    ("m21_race_history", p.race_history, "p_race_history"),
    ("m22_leaderboard", p.leaderboard, "p_leaderboard"),
    ("m23_race_summary", p.race_summary, "p_race_summary"),
    ("m24_session_drivers", p.session_drivers, "p_session_drivers"),
    ("m25_session_filters", p.session_filters, "p_session_filters"),
    ("m26_session_names", p.session_names, "p_session_names"),
    ("m27_tyre_compounds", p.tyre_compounds, "p_tyre_compounds"),
    ("d01_car_data", d.car_data, "d_car_data"),
    ("d02_drivers", d.drivers, "d_drivers"),
    ("d03_intervals", d.intervals, "d_intervals"),
    ("d04_laps", lambda t: d.laps(t).drop(*SEGMENTS), "d_laps"),
    ("d05_meetings", d.meetings, "d_meetings"),
    ("d06_pit", d.pit, "d_pit"),
    ("d07_position", d.position, "d_position"),
    ("d08_sessions", d.sessions, "d_sessions"),
    ("d09_stints", d.stints, "d_stints"),
    ("d10_weather", d.weather, "d_weather"),
    ("d11_lap_hub", d.lap_hub, "d_hub"),
    ("d12_lap_gaps", d.lap_gaps, "d_lap_gaps"),
    ("d13_lap_pits", d.lap_pits, "d_lap_pits"),
    ("d14_lap_positions", d.lap_positions, "d_lap_positions"),
    ("d15_lap_stints", d.lap_stints, "d_lap_stints"),
    ("d16_lap_telemetry", d.lap_telemetry, "d_lap_telemetry"),
    ("d17_lap_weather", d.lap_weather, "d_lap_weather"),
    ("d18_dim_drivers", d.drivers, "d_drivers"),
    ("d19_dim_meetings", d.meetings, "d_meetings"),
    ("d20_dim_sessions", d.sessions, "d_sessions"),
    ("d21_lap_gap_evolution", d.lap_gap_evolution, "d_gap_evolution"),
    ("d22_pit_out_impact", d.pit_out_impact, "d_pit_out"),
    ("d23_sector_pace", d.sector_pace, "d_sector_pace"),
    ("d24_sector_position_impact", d.sector_position_impact, "d_sector_impact"),
    ("d25_telemetry_laps", d.telemetry_laps, "d_telemetry_laps"),
    ("d26_telemetry_sessions", d.telemetry_sessions, "d_telemetry_sessions"),
    ("d27_optimal_tyre_life", d.optimal_tyre_life, "d_tyre_life"),
    ("d28_team_tyre_strategy", d.team_tyre_strategy, "d_strategy"),
    ("d29_tyre_degradation", d.tyre_degradation, "d_degradation"),
    ("d30_tyre_weather_impact", d.tyre_weather_impact, "d_impact"),
    ("d31_tyre_weather_laps", d.tyre_weather_laps, "d_tyre_weather"),
    ("x01_car_data", x.car_data, "x_car_data"),
    ("x02_drivers", x.drivers, "x_drivers"),
    ("x03_intervals", x.intervals, "x_intervals"),
    ("x04_laps", lambda t: x.laps(t).drop(*SEGMENTS), "x_laps"),
    ("x05_meetings", x.meetings, "x_meetings"),
    ("x06_pit", x.pit, "d_pit"),
    ("x07_position", x.position, "x_position"),
    ("x08_sessions", x.sessions, "x_sessions"),
    ("x09_stints", x.stints, "x_stints"),
    ("x10_weather", x.weather, "x_weather"),
    ("x11_lap_rollup", x.lap_rollup, "x_lap_rollup"),
    ("x12_latest_gaps", x.latest_gaps, "x_latest_gaps"),
    ("x13_latest_positions", x.latest_positions, "x_latest_positions"),
    ("x14_pit_rollup", x.pit_rollup, "x_pit_rollup"),
    ("x15_stint_rollup", x.stint_rollup, "x_stint_rollup"),
    ("x16_dim_drivers", x.dim_drivers, "x_dim_drivers"),
    ("x17_dim_meetings", x.dim_meetings, "x_meetings"),
    ("x18_dim_sessions", x.dim_sessions, "x_dim_sessions"),
    ("x19_telemetry_minutes", x.telemetry_minutes, "x_telemetry_minutes"),
    ("x20_driver_session_summary", x.driver_session_summary, "x_summary"),
    ("x21_laps_fact", x.laps_fact, "x_laps_fact"),
    ("x22_position_minutes", x.position_minutes, "x_position_minutes"),
    ("x23_race_leaderboard", x.race_leaderboard, "x_leaderboard"),
    ("x24_stint_performance", x.stint_performance, "x_stint_performance"),
    ("x25_weather_slices", x.weather_slices, "x_weather_slices"),
    ("x26_session_summary", x.session_summary, "x_session_summary"),
]

DROPPED = {"x17_dim_meetings": "gmt_offset", "m07_position": "meeting_key"}

for _name, _build, _block in MODELS:
    _doubles, _dates, _arrays = COLUMNS.get(_block, ("", "", ""))
    _sql = block(_block, _doubles, _dates, DROPPED.get(_name, ""))
    for _a in _arrays.split():
        _sql = _sql.replace("SELECT *", f"SELECT * REPLACE (array_to_string({_a}, '|') AS {_a})", 1)
    register(_name, _build, _sql)

register(
    "m25_session_filters_long", p.session_filter_drivers,
    """SELECT session_key, driver_display_name, row_number() OVER (PARTITION BY session_key, m.meeting_name ORDER BY driver_display_name) AS place, s.year, s.country_name, session_name, session_type, m.meeting_name
       FROM p_sessions s JOIN (SELECT DISTINCT session_key, driver_display_name FROM p_session_drivers WHERE driver_display_name IS NOT NULL) n USING (session_key)
       JOIN (SELECT DISTINCT year, country_name, meeting_name FROM p_meetings) m ON m.year = s.year AND m.country_name = s.country_name""",
)
