"""Columns of each comparison block that need a common form: doubles, dates, text arrays."""

COLUMNS = {
    "b_pit": ("pit_duration lane_duration stop_duration", "", ""),
    "b_weather": ("air_temperature track_temperature pressure humidity wind_speed", "", ""),
    "b_laps": ("lap_duration duration_sector_1 duration_sector_2 duration_sector_3", "", ""),
    "p_laps": ("lap_duration duration_sector_1 duration_sector_2 duration_sector_3", "", ""),
    "p_best_laps": ("best_lap_time", "", ""),
    "p_final_gaps": ("gap_to_leader gap_to_next", "", ""),
    "p_stint_weather": ("avg_air_temp avg_track_temp avg_humidity avg_wind_speed", "", ""),
    "p_race_history": ("duration_sector_1 duration_sector_2 duration_sector_3 min_gap_to_leader max_gap_to_leader min_gap_to_next max_gap_to_next", "", ""),
    "p_leaderboard": ("gap_to_leader gap_to_next best_lap_time", "", ""),
    "p_race_summary": ("average_speed", "", ""),
    "p_session_filters": ("", "", "available_driver_names"),
    "p_tyre_compounds": ("circuit_compound_avg_stint avg_tire_age_start", "", ""),
    "d_intervals": ("gap_to_leader_seconds interval_to_ahead_seconds", "", ""),
    "d_laps": ("lap_duration_seconds sector_1_seconds sector_2_seconds sector_3_seconds", "", ""),
    "d_pit": ("raw_pit_duration_seconds lane_duration_seconds stop_duration_seconds pit_stop_duration_seconds", "event_date", ""),
    "d_weather": ("air_temperature track_temperature pressure humidity wind_speed", "", ""),
    "d_hub": ("lap_duration_seconds sector_1_seconds sector_2_seconds sector_3_seconds", "", ""),
    "d_lap_gaps": ("gap_to_leader_seconds interval_to_ahead_seconds previous_lap_gap_to_leader_seconds gap_delta_to_previous_lap_seconds", "", ""),
    "d_lap_pits": ("lap_duration_seconds pit_stop_duration_seconds lane_duration_seconds raw_pit_duration_seconds previous_lap_duration_seconds next_lap_duration_seconds", "", ""),
    "d_lap_telemetry": ("avg_speed avg_throttle avg_rpm avg_gear brake_usage_pct full_throttle_pct drs_active_pct drs_detected_pct", "", ""),
    "d_lap_weather": ("air_temperature track_temperature pressure humidity wind_speed", "", ""),
    "d_gap_evolution": ("lap_duration_seconds pit_stop_duration_seconds lane_duration_seconds gap_to_leader_seconds interval_to_ahead_seconds gap_delta_to_previous_lap_seconds sector_1_seconds sector_2_seconds sector_3_seconds", "", ""),
    "d_pit_out": ("lap_duration_seconds pit_stop_duration_seconds lane_duration_seconds gap_to_leader_seconds gap_delta_to_previous_lap_seconds driver_clean_air_avg_lap_seconds field_clean_avg_lap_seconds pit_out_loss_vs_driver_avg_seconds pit_out_loss_vs_field_avg_seconds", "", ""),
    "d_sector_pace": ("race_avg_sector_seconds race_best_sector_seconds qualifying_avg_sector_seconds qualifying_best_sector_seconds avg_race_vs_best_qualifying_delta_seconds best_race_vs_best_qualifying_delta_seconds avg_race_vs_qualifying_delta_pct", "", ""),
    "d_sector_impact": ("lap_duration_seconds sector_1_seconds sector_2_seconds sector_3_seconds sector_1_delta_to_field_seconds sector_2_delta_to_field_seconds sector_3_delta_to_field_seconds lap_delta_to_field_seconds gap_to_leader_seconds gap_delta_to_previous_lap_seconds", "", ""),
    "d_telemetry_laps": ("lap_duration_seconds avg_speed avg_throttle avg_rpm avg_gear brake_usage_pct full_throttle_pct drs_active_pct drs_detected_pct", "", ""),
    "d_telemetry_sessions": ("session_avg_speed session_avg_throttle session_avg_brake_usage_pct session_avg_drs_active_pct session_avg_full_throttle_pct", "", ""),
    "d_tyre_weather": ("lap_duration_seconds air_temperature track_temperature pressure humidity wind_speed", "", ""),
    "d_tyre_clean": ("lap_duration_seconds air_temperature track_temperature pressure humidity wind_speed", "", ""),
    "d_degradation": ("avg_lap_seconds best_lap_seconds median_lap_seconds avg_track_temperature avg_humidity best_avg_lap_seconds_for_compound degradation_vs_best_age_seconds", "", ""),
    "d_tyre_life": ("optimal_age_avg_lap_seconds optimal_age_best_lap_seconds optimal_age_median_lap_seconds avg_track_temperature avg_humidity", "", ""),
    "d_strategy": ("avg_clean_lap_seconds_in_stint best_clean_lap_seconds_in_stint avg_track_temperature avg_air_temperature avg_humidity", "", ""),
    "d_impact": ("avg_lap_seconds best_lap_seconds median_lap_seconds avg_track_temperature avg_air_temperature avg_humidity avg_tyre_age_lap corr_humidity_lap_seconds corr_track_temp_lap_seconds", "", ""),
    "x_car_data": ("", "event_date", ""),
    "x_intervals": ("gap_to_leader_seconds interval_to_ahead_seconds", "event_date", ""),
    "x_laps": ("lap_duration_seconds sector_1_seconds sector_2_seconds sector_3_seconds", "event_date", ""),
    "x_position": ("", "event_date", ""),
    "x_weather": ("air_temperature track_temperature pressure humidity wind_speed", "event_date", ""),
    "x_lap_rollup": ("best_lap_seconds avg_lap_seconds slowest_lap_seconds avg_sector_1_seconds avg_sector_2_seconds avg_sector_3_seconds", "", ""),
    "x_latest_gaps": ("gap_to_leader_seconds interval_to_ahead_seconds", "", ""),
    "x_pit_rollup": ("avg_pit_duration_seconds fastest_pit_duration_seconds slowest_pit_duration_seconds avg_pit_lane_duration_seconds fastest_pit_lane_duration_seconds slowest_pit_lane_duration_seconds avg_raw_pit_duration_seconds", "", ""),
    "x_stint_rollup": ("avg_stint_lap_count", "", ""),
    "x_minutes": ("avg_speed avg_rpm avg_throttle avg_brake", "event_date", ""),
    "x_telemetry_minutes": ("avg_speed avg_rpm avg_throttle avg_brake", "event_date", ""),
    "x_summary": ("best_lap_seconds avg_lap_seconds slowest_lap_seconds avg_sector_1_seconds avg_sector_2_seconds avg_sector_3_seconds avg_speed avg_rpm avg_pit_duration_seconds fastest_pit_duration_seconds slowest_pit_duration_seconds avg_pit_lane_duration_seconds fastest_pit_lane_duration_seconds slowest_pit_lane_duration_seconds avg_raw_pit_duration_seconds gap_to_leader_seconds interval_to_ahead_seconds", "", ""),
    "x_laps_fact": ("lap_duration_seconds sector_1_seconds sector_2_seconds sector_3_seconds", "event_date", ""),
    "x_position_minutes": ("", "event_date", ""),
    "x_leaderboard": ("best_lap_seconds avg_lap_seconds slowest_lap_seconds avg_sector_1_seconds avg_sector_2_seconds avg_sector_3_seconds avg_speed avg_rpm avg_pit_duration_seconds fastest_pit_duration_seconds slowest_pit_duration_seconds avg_pit_lane_duration_seconds fastest_pit_lane_duration_seconds slowest_pit_lane_duration_seconds avg_raw_pit_duration_seconds gap_to_leader_seconds interval_to_ahead_seconds", "", ""),
    "x_stint_performance": ("avg_lap_seconds_in_stint best_lap_seconds_in_stint", "", ""),
    "x_slices": ("avg_air_temperature avg_track_temperature avg_pressure avg_humidity avg_wind_speed avg_wind_direction", "event_date", ""),
    "x_weather_slices": ("avg_air_temperature avg_track_temperature avg_pressure avg_humidity avg_wind_speed avg_wind_direction", "event_date", ""),
    "x_session_summary": ("fastest_lap_seconds avg_air_temperature avg_track_temperature", "", ""),
}
