"""Comparison SQL in DuckDB's dialect: named building blocks plus one statement per query.

A statement is assembled from the blocks whose names it mentions, so each block is written once.
"""

from __future__ import annotations

import re

from pitwall.functions.keys import NULL_PART

BLOCKS: dict[str, str] = {}


def key(*parts: str) -> str:
    texts = [f"coalesce(CAST({p} AS VARCHAR), '{NULL_PART}')" for p in parts]
    return f"md5(concat_ws('-', {', '.join(texts)}))"


def time(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def statement(body: str) -> str:
    """The body preceded by every block it needs, in definition order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        for word in set(re.findall(r"\b[bpdxe]_\w+\b", todo.pop())) & BLOCKS.keys() - needed:
            needed.add(word)
            todo.append(BLOCKS[word])
    ctes = [f"{name} AS ({BLOCKS[name]})" for name in BLOCKS if name in needed]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def rounded(block: str, doubles: str = "", dates: str = "", drop: str = "") -> str:
    """The block's rows with doubles rounded to six digits and dates as text, the same form as `registry.comparable`."""
    parts = [f"round({c} + 1e-9, 6) AS {c}" for c in doubles.split()] + [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    exclude = f" EXCLUDE ({', '.join(drop.split())})" if drop else ""
    replace = f" REPLACE ({', '.join(parts)})" if parts else ""
    return f"SELECT *{exclude}{replace} FROM {block}"


BLOCKS["e_all"] = """
SELECT event_id, ts, user_id, event_type, value, props, CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k,
       CAST(1 + (day(ts) - 1) // 10 AS BIGINT) AS session_key, user_id AS driver_number, CAST(1 + (day(ts) - 1) // 10 AS BIGINT) AS meeting_key
FROM events"""
BLOCKS["b_car"] = """
SELECT session_key, meeting_key, driver_number, ts AS date, 150 * k AS rpm, 3 * k AS speed, k AS throttle,
       CASE WHEN k % 4 = 0 THEN 100 ELSE 0 END AS brake, k % 9 AS n_gear, k % 16 AS drs FROM e_all WHERE event_type = 'view'"""
BLOCKS["b_position"] = """
SELECT session_key, driver_number, ts AS date, meeting_key, 1 + k % 20 AS position FROM e_all WHERE event_type = 'signup'"""
_GAP = "CASE {k} % 10 WHEN 0 THEN '+1 LAP' WHEN 1 THEN 'None' WHEN 2 THEN '1:23.4' WHEN 3 THEN '+2 LAPS' WHEN 4 THEN '' ELSE CAST(value AS VARCHAR) END"
BLOCKS["b_intervals"] = f"""
SELECT meeting_key, session_key, driver_number, ts AS date, {_GAP.format(k='k')} AS gap_to_leader, {_GAP.format(k='(k + 5)')} AS "interval"
FROM e_all WHERE event_type = 'purchase'"""
BLOCKS["b_pit"] = """
SELECT session_key, meeting_key, driver_number, ts AS date, 1 + k % 5 AS lap_number, value AS pit_duration, value AS lane_duration,
       CASE WHEN k % 6 <> 0 THEN value / 4 END AS stop_duration FROM e_all WHERE event_type = 'error'"""
BLOCKS["b_weather"] = """
SELECT meeting_key, session_key, ts AS date, 10 + value / 20 AS air_temperature, 15 + value / 10 AS track_temperature,
       CAST(1000 + k AS DOUBLE) AS pressure, CAST(k AS DOUBLE) AS humidity, k % 5 = 0 AS rainfall, k / 10 AS wind_speed, 3 * k AS wind_direction
FROM e_all WHERE user_id % 3 = 0"""
BLOCKS["b_laps"] = """
SELECT meeting_key, session_key, driver_number, ts AS date_start, 40 + value AS lap_duration,
       CAST(row_number() OVER (PARTITION BY session_key, driver_number ORDER BY ts) AS INTEGER) AS lap_number, k % 10 = 0 AS is_pit_out_lap,
       (40 + value) * 0.30::DOUBLE AS duration_sector_1, (40 + value) * 0.35::DOUBLE AS duration_sector_2, (40 + value) * 0.35::DOUBLE AS duration_sector_3,
       CASE WHEN k % 9 <> 0 THEN 200 + k END AS i1_speed, 210 + k AS i2_speed, CASE WHEN k % 7 <> 0 THEN 220 + k END AS st_speed
FROM e_all WHERE event_type = 'click'"""
BLOCKS["b_stints"] = """
SELECT meeting_key, session_key, driver_number, stint_number, lap_start, lap_end,
       (['SOFT', 'MEDIUM', 'HARD', NULL, 'WET'])[1 + (driver_number + stint_number) % 5] AS compound,
       CASE WHEN driver_number % 7 <> 0 THEN CAST(driver_number % 4 AS INTEGER) END AS tyre_age_at_start
FROM (SELECT meeting_key, session_key, driver_number, CAST(1 + (lap_number - 1) // 2 AS INTEGER) AS stint_number, min(lap_number) AS lap_start,
             max(lap_number) AS lap_end FROM b_laps GROUP BY ALL)"""
BLOCKS["b_sessions"] = """
SELECT CAST(1 + r_regionkey AS BIGINT) AS session_key, CAST(1 + r_regionkey AS BIGINT) AS meeting_key, r_name AS country_name,
       (['Race', 'Qualifying', 'Sprint', 'Practice', 'Sprint Qualifying'])[1 + r_regionkey] AS session_name, (['Race', 'Qualifying', 'Sprint', 'Practice', 'Sprint Qualifying'])[1 + r_regionkey] AS session_type,
       2024 AS year, CAST(r_regionkey AS BIGINT) AS circuit_key, r_name AS circuit_short_name, substr(r_name, 1, 3) AS country_code,
       TIMESTAMP '2024-01-01' + to_days(10 * r_regionkey) AS date_start, TIMESTAMP '2024-01-11' + to_days(10 * r_regionkey) AS date_end,
       '00:00:00' AS gmt_offset, CASE WHEN r_regionkey = 1 THEN false END AS is_cancelled, ' ' || r_name AS location
FROM region"""
BLOCKS["b_meetings"] = """
SELECT CAST(1 + r_regionkey AS BIGINT) AS meeting_key, r_name AS meeting_name, r_name || ' Grand Prix' AS meeting_official_name,
       r_name AS country_name, CAST(r_regionkey AS BIGINT) AS circuit_key, 'None' AS circuit_image, '' AS circuit_info_url,
       r_name AS circuit_short_name, 'Permanent' AS circuit_type, lower(substr(r_name, 1, 3)) AS circuit_code, 'null' AS circuit_flag, 2024 AS year,
       TIMESTAMP '2024-01-01' + to_days(10 * r_regionkey) AS date_start, TIMESTAMP '2024-01-11' + to_days(10 * r_regionkey) AS date_end,
       '00:00:00' AS gmt_offset, CAST(NULL AS BOOLEAN) AS is_cancelled, r_name AS location
FROM region"""
BLOCKS["b_drivers"] = """
SELECT s AS meeting_key, c_custkey AS driver_number, c_name AS broadcast_name, split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name, c_name AS full_name, upper(substr(c_mktsegment, 1, 3)) AS name_acronym, 'None' AS headshot_url,
       n_name AS team_name, lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS team_colour, lower(substr(n_name, 1, 3)) AS country_code,
       s AS session_key
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey, (SELECT session_key AS s FROM b_sessions)
WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'click')"""
BLOCKS["b_location"] = """
SELECT meeting_key, session_key, driver_number, ts AS date, k AS x, 2 * k AS y, k - 50 AS z FROM e_all WHERE event_type = 'error'"""

# --- session-grain models ----------------------------------------------------------------------------------

BLOCKS["p_car_data"] = "SELECT session_key, CAST(driver_number AS VARCHAR) AS driver_number, date AS timestamp, rpm, speed, throttle, brake, drs FROM b_car"
BLOCKS["p_drivers"] = "SELECT DISTINCT * EXCLUDE (meeting_key, headshot_url) FROM b_drivers"
BLOCKS["p_intervals"] = """
SELECT session_key, driver_number, date, nullif(gap_to_leader, 'None') AS gap_to_leader, nullif("interval", 'None') AS gap_to_next FROM b_intervals"""
BLOCKS["p_laps"] = """
SELECT session_key, driver_number, date_trunc('second', date_start) AS date_start,
       date_trunc('second', date_start) + to_seconds(CAST(round(lap_duration) AS BIGINT)) AS date_end, lap_duration, lap_number, is_pit_out_lap,
       duration_sector_1, duration_sector_2, duration_sector_3 FROM b_laps"""
BLOCKS["p_meetings"] = "SELECT meeting_key, meeting_name, meeting_official_name, country_name, circuit_short_name, year, date_start FROM b_meetings"
BLOCKS["p_sessions"] = "SELECT session_key, meeting_key, country_name, session_name, session_type, year, circuit_short_name, date_start, date_end FROM b_sessions"
BLOCKS["p_best_laps"] = "SELECT session_key, driver_number, min(lap_duration) AS best_lap_time FROM p_laps WHERE lap_duration > 0 GROUP BY ALL"
BLOCKS["p_telemetry"] = """
SELECT c.driver_number, c.session_key, name_acronym, team_name, team_colour, timestamp, rpm, speed, throttle, brake, drs
FROM p_car_data c LEFT JOIN p_drivers d ON CAST(c.driver_number AS BIGINT) = d.driver_number AND c.session_key = d.session_key"""
BLOCKS["p_final_gaps"] = """
SELECT session_key, driver_number, max(TRY_CAST(gap_to_leader AS DOUBLE)) FILTER (NOT contains(gap_to_leader, 'L')) AS gap_to_leader,
       max(TRY_CAST(gap_to_next AS DOUBLE)) FILTER (NOT contains(gap_to_next, 'L')) AS gap_to_next FROM p_intervals GROUP BY ALL"""
BLOCKS["p_final_positions"] = """
SELECT session_key, driver_number, position, date AS latest_date FROM b_position
QUALIFY row_number() OVER (PARTITION BY session_key, driver_number ORDER BY date DESC NULLS FIRST) = 1"""
BLOCKS["p_lap_positions"] = """
SELECT *, row_number() OVER (lap ORDER BY start_time_diff, date) AS start_position_rank, row_number() OVER (lap ORDER BY end_time_diff, date) AS end_position_rank
FROM (SELECT session_key, driver_number, p.position, p.date, l.lap_number, l.date_start, l.date_end,
             abs(date_diff('second', p.date, l.date_start)) AS start_time_diff, abs(date_diff('second', p.date, l.date_end)) AS end_time_diff
      FROM b_position p JOIN p_laps l USING (session_key, driver_number) WHERE p.date BETWEEN l.date_start AND l.date_end)
WINDOW lap AS (PARTITION BY session_key, driver_number, lap_number)"""
BLOCKS["p_pit_stops"] = "SELECT session_key, driver_number, count(*) AS pit_stop_count FROM b_pit GROUP BY ALL"
BLOCKS["p_race_stints"] = """
SELECT st.*, d.team_name, s.circuit_short_name, s.country_name, s.session_type, lap_end - lap_start + 1 AS stint_length
FROM b_stints st LEFT JOIN p_drivers d USING (session_key, driver_number) JOIN p_sessions s ON s.session_key = st.session_key AND s.session_type = 'Race'"""
BLOCKS["p_stint_laps"] = """
SELECT st.session_key, st.driver_number, stint_number, compound, lap_start, lap_end, lap_end - lap_start + 1 AS stint_length,
       min(l.date_start) AS stint_start_time, max(l.date_start) AS stint_end_time
FROM b_stints st LEFT JOIN p_laps l ON l.session_key = st.session_key AND l.driver_number = st.driver_number AND l.lap_number BETWEEN lap_start AND lap_end
GROUP BY ALL"""
BLOCKS["p_stint_weather"] = """
SELECT *, CASE WHEN avg_track_temp < 25 THEN 'Cold' WHEN avg_track_temp < 35 THEN 'Medium' ELSE 'Hot' END AS track_temp_category,
       CASE WHEN had_rainfall THEN 'Wet' WHEN avg_humidity > 70 THEN 'High Humidity' ELSE 'Dry' END AS weather_condition
FROM (SELECT st.session_key, st.driver_number, stint_number, compound, lap_start, lap_end, stint_length, avg(air_temperature) AS avg_air_temp,
             avg(track_temperature) AS avg_track_temp, avg(humidity) AS avg_humidity, bool_or(rainfall) AS had_rainfall, avg(wind_speed) AS avg_wind_speed
      FROM p_stint_laps st LEFT JOIN b_weather w ON w.session_key = st.session_key AND w.date BETWEEN stint_start_time AND stint_end_time GROUP BY ALL)"""
BLOCKS["p_session_names"] = "SELECT DISTINCT year || ' - ' || country_name || ' - ' || session_name AS session_display_name, session_key FROM p_sessions"
BLOCKS["p_car_telemetry"] = """
SELECT timestamp, name_acronym || ' (' || team_name || ')' AS driver, driver_number, round(speed) AS speed, round(throttle) AS throttle, round(brake) AS brake,
       round(drs) AS drs, rpm, t.session_key, m.meeting_key
FROM p_telemetry t LEFT JOIN p_sessions s ON s.session_key = t.session_key LEFT JOIN p_meetings m ON m.meeting_key = s.meeting_key"""
_FILL = """CASE WHEN lap_number = 1 THEN first_position ELSE coalesce(last_value({c} IGNORE NULLS) OVER (
       PARTITION BY session_key, driver_number ORDER BY lap_number ROWS UNBOUNDED PRECEDING), first_position) END AS filled_{c}"""
BLOCKS["p_race_history"] = f"""
SELECT *, {_FILL.format(c='start_position')}, {_FILL.format(c='end_position')} FROM (
  SELECT l.* EXCLUDE (lap_duration), f.position AS first_position, g.* EXCLUDE (session_key, driver_number, lap_number),
         sp.position AS start_position, ep.position AS end_position
  FROM p_laps l
  LEFT JOIN (SELECT * FROM b_position QUALIFY row_number() OVER (PARTITION BY session_key, driver_number ORDER BY date) = 1) f USING (session_key, driver_number)
  LEFT JOIN (SELECT x.session_key, x.driver_number, x.lap_number, min(v) AS min_gap_to_leader, max(v) AS max_gap_to_leader, min(u) AS min_gap_to_next, max(u) AS max_gap_to_next
             FROM p_laps x JOIN (SELECT session_key, driver_number, date_trunc('second', date) AS at,
                                        CASE WHEN NOT contains(gap_to_leader, 'L') THEN TRY_CAST(gap_to_leader AS DOUBLE) END AS v,
                                        CASE WHEN NOT contains(gap_to_next, 'L') THEN TRY_CAST(gap_to_next AS DOUBLE) END AS u FROM p_intervals) i
               ON i.session_key = x.session_key AND i.driver_number = x.driver_number AND i.at BETWEEN x.date_start AND x.date_end GROUP BY ALL) g
    ON g.session_key = l.session_key AND g.driver_number = l.driver_number AND g.lap_number = l.lap_number
  LEFT JOIN p_lap_positions sp ON sp.session_key = l.session_key AND sp.driver_number = l.driver_number AND sp.lap_number = l.lap_number AND sp.start_position_rank = 1
  LEFT JOIN p_lap_positions ep ON ep.session_key = l.session_key AND ep.driver_number = l.driver_number AND ep.lap_number = l.lap_number AND ep.end_position_rank = 1)"""
BLOCKS["p_leaderboard"] = """
SELECT f.session_key, f.driver_number, d.broadcast_name AS driver_name, f.rank, d.team_name, d.team_colour AS team_color,
       CASE WHEN f.position = 1 THEN 0 ELSE g.gap_to_leader END AS gap_to_leader, g.gap_to_next, b.best_lap_time, s.pit_stop_count, n.session_display_name,
       CAST(coalesce((MAP {1: 25, 2: 18, 3: 15, 4: 12, 5: 10, 6: 8, 7: 6, 8: 4, 9: 2, 10: 1})[f.position], 0) AS INTEGER) AS points
FROM (SELECT *, dense_rank() OVER (PARTITION BY session_key ORDER BY position) AS rank FROM p_final_positions) f
JOIN p_drivers d USING (session_key, driver_number) LEFT JOIN p_final_gaps g USING (session_key, driver_number)
LEFT JOIN p_best_laps b USING (session_key, driver_number) LEFT JOIN p_pit_stops s USING (session_key, driver_number)
JOIN p_session_names n USING (session_key)"""
BLOCKS["p_race_summary"] = """
SELECT session_key, session_display_name, total_drivers, total_laps, coalesce(total_teams, 0) AS total_teams, total_pit_stops, fastest_speed, average_speed
FROM (SELECT session_key, count(DISTINCT driver_number) AS total_drivers FROM b_position GROUP BY 1)
JOIN (SELECT session_key, max(lap_number) AS total_laps FROM p_laps GROUP BY 1) USING (session_key)
JOIN p_session_names USING (session_key)
LEFT JOIN (SELECT session_key, count(DISTINCT team_name) AS total_teams, CAST(sum(pit_stop_count) AS BIGINT) AS total_pit_stops FROM p_leaderboard GROUP BY 1) USING (session_key)
LEFT JOIN (SELECT session_key, max(top) AS fastest_speed, avg(mean) AS average_speed
           FROM (SELECT session_key, driver_number, max(speed) AS top, avg(speed) AS mean FROM p_car_data GROUP BY ALL) GROUP BY 1) USING (session_key)"""
_LABEL = "d.name_acronym || ' - ' || d.full_name || ' (' || d.team_name || ')'"
BLOCKS["p_session_drivers"] = f"""
SELECT DISTINCT session_key, {_LABEL} AS driver_display_name, driver_number FROM p_drivers d JOIN p_sessions USING (session_key)"""
BLOCKS["p_session_filters"] = """
SELECT s.year, s.country_name, s.circuit_short_name, s.session_name, s.session_type, s.year || ' - ' || s.country_name || ' - ' || s.session_name AS session_display_name,
       list_sort(array_agg(DISTINCT n.driver_display_name)) AS available_driver_names, m.meeting_name, m.meeting_official_name, s.session_key, s.date_start
FROM p_sessions s JOIN p_session_drivers n USING (session_key) JOIN p_meetings m ON m.year = s.year AND m.country_name = s.country_name
GROUP BY ALL"""
BLOCKS["p_tyre_compounds"] = """
SELECT circuit_short_name, compound, avg(mean) AS circuit_compound_avg_stint, max(longest) AS circuit_compound_max_stint, avg(age) AS avg_tire_age_start, CAST(sum(n) AS BIGINT) AS total_stints
FROM (SELECT circuit_short_name, compound, team_name, driver_number, avg(stint_length) AS mean, max(stint_length) AS longest, avg(tyre_age_at_start) AS age, count(*) AS n
      FROM p_race_stints GROUP BY ALL) GROUP BY ALL"""

# --- lap-grain models --------------------------------------------------------------------------------------


def _clean(c: str) -> str:
    return f"nullif(trim({c}), '')"


def _newest(by: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {by} DESC NULLS LAST) = 1"


_CAR = "session_key, driver_number"
BLOCKS["d_car_data"] = f"""
SELECT {key('session_key', 'driver_number', time('date'))} AS car_data_id, meeting_key, session_key, driver_number, date AS telemetry_at, rpm, speed, throttle, brake, n_gear, drs,
       CAST(drs IN (10, 12, 14) AS INTEGER) AS is_drs_active, CAST(drs IN (8, 10, 12, 14) AS INTEGER) AS is_drs_detected, CAST(brake > 0 AS INTEGER) AS is_braking,
       CAST(throttle >= 95 AS INTEGER) AS is_full_throttle FROM b_car {_newest('car_data_id ORDER BY telemetry_at')}"""
BLOCKS["d_drivers"] = f"""
SELECT {key('session_key', 'driver_number')} AS session_driver_id, meeting_key, session_key, driver_number, {_clean('broadcast_name')} AS broadcast_name,
       {_clean('first_name')} AS first_name, {_clean('last_name')} AS last_name, {_clean('full_name')} AS full_name, upper({_clean('name_acronym')}) AS name_acronym,
       {_clean('headshot_url')} AS headshot_url, {_clean('team_name')} AS team_name, '#' || replace(upper({_clean('team_colour')}), '#', '') AS team_colour_hex,
       upper({_clean('country_code')}) AS country_code FROM b_drivers"""
_DGAP = "CASE WHEN regexp_full_match(upper(trim({c})), '\\+[0-9]+\\s*LAP') THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END"
_DLAP = "coalesce(regexp_full_match(upper(trim({c})), '\\+[0-9]+\\s*LAP'), false)"
BLOCKS["d_intervals"] = f"""
SELECT {key('session_key', 'driver_number', time('date'))} AS interval_id, meeting_key, session_key, driver_number, date AS interval_at, g AS gap_to_leader_raw, i AS interval_to_ahead_raw,
       {_DGAP.format(c='g')} AS gap_to_leader_seconds, {_DGAP.format(c='i')} AS interval_to_ahead_seconds, {_DLAP.format(c='g')} AS is_lapped_to_leader, {_DLAP.format(c='i')} AS is_lapped_to_ahead
FROM (SELECT *, {_clean('gap_to_leader')} AS g, {_clean('"interval"')} AS i FROM b_intervals) {_newest('interval_id ORDER BY interval_at')}"""
BLOCKS["d_laps"] = f"""
SELECT {key('session_key', 'driver_number', 'lap_number')} AS lap_id, meeting_key, session_key, driver_number, date_start AS lap_start_at,
       lead(date_start) OVER (PARTITION BY {_CAR} ORDER BY lap_number) AS next_lap_start_at, lap_duration AS lap_duration_seconds, lap_number, coalesce(is_pit_out_lap, false) AS is_pit_out_lap,
       duration_sector_1 AS sector_1_seconds, duration_sector_2 AS sector_2_seconds, duration_sector_3 AS sector_3_seconds, i1_speed, i2_speed, st_speed,
       greatest(i1_speed, i2_speed, st_speed) AS max_lap_speed, lap_duration BETWEEN 40 AND 300 AS is_valid_lap_time,
       duration_sector_1 BETWEEN 5 AND 120 AND duration_sector_2 BETWEEN 5 AND 120 AND duration_sector_3 BETWEEN 5 AND 120 AS is_valid_sector_time FROM b_laps"""
BLOCKS["d_meetings"] = """
SELECT meeting_key, meeting_name, meeting_official_name, country_name, circuit_key, circuit_short_name, circuit_type, circuit_code, year AS season_year, date_start AS meeting_start_at,
       date_end AS meeting_end_at, location, coalesce(is_cancelled, false) AS is_cancelled FROM b_meetings"""
BLOCKS["d_pit"] = f"""
SELECT {key('session_key', 'driver_number', time('date'), 'lap_number')} AS pit_stop_id, meeting_key, session_key, driver_number, date AS pit_at, CAST(date AS DATE) AS event_date, lap_number,
       pit_duration AS raw_pit_duration_seconds, lane_duration AS lane_duration_seconds, stop_duration AS stop_duration_seconds, stop_duration AS pit_stop_duration_seconds,
       stop_duration IS NOT NULL AS has_stationary_stop_duration, coalesce(stop_duration BETWEEN 0 AND 120, false) AS is_valid_stationary_stop_duration,
       coalesce(lane_duration BETWEEN 0 AND 1800, false) AS is_valid_lane_duration FROM b_pit {_newest('pit_stop_id ORDER BY pit_at')}"""
BLOCKS["d_position"] = f"""
SELECT {key('session_key', 'driver_number', time('date'))} AS position_id, meeting_key, session_key, driver_number, date AS position_at, position
FROM b_position {_newest('position_id ORDER BY position_at')}"""
BLOCKS["d_sessions"] = """
SELECT session_key, meeting_key, country_name, country_code, session_name, session_type, year AS season_year, circuit_key, circuit_short_name, date_start AS session_start_at,
       date_end AS session_end_at, trim(location) AS location, coalesce(is_cancelled, false) AS is_cancelled, year || ' - ' || country_name || ' - ' || session_name AS session_display_name
FROM b_sessions"""
BLOCKS["d_stints"] = f"""
SELECT {key('session_key', 'driver_number', 'stint_number')} AS stint_id, meeting_key, session_key, driver_number, stint_number, lap_start, lap_end,
       CASE WHEN lap_end >= lap_start THEN lap_end - lap_start + 1 END AS stint_lap_count, coalesce(upper({_clean('compound')}), 'UNKNOWN') AS compound, tyre_age_at_start FROM b_stints"""
BLOCKS["d_weather"] = f"""
SELECT {key('session_key', time('date'))} AS weather_id, meeting_key, session_key, date AS weather_at, air_temperature, track_temperature, pressure, humidity,
       coalesce(rainfall, false) AS rainfall, wind_speed, wind_direction,
       CASE WHEN rainfall THEN 'RAIN' WHEN humidity >= 80 THEN 'HUMID' WHEN humidity >= 60 THEN 'MODERATE_HUMIDITY' ELSE 'DRY' END AS weather_condition_bucket
FROM b_weather {_newest('weather_id ORDER BY weather_at')}"""
BLOCKS["d_hub"] = """
SELECT l.*, coalesce(next_lap_start_at, lap_start_at + INTERVAL 5 MINUTE) AS lap_end_at, s.season_year, s.country_name, s.circuit_short_name, s.session_name, s.session_type,
       s.session_start_at, s.session_end_at, d.session_driver_id, d.full_name, d.name_acronym, d.team_name, d.team_colour_hex
FROM d_laps l LEFT JOIN d_sessions s ON s.session_key = l.session_key LEFT JOIN d_drivers d ON d.session_key = l.session_key AND d.driver_number = l.driver_number"""
_IN_LAP = "{a}.session_key = l.session_key AND {a}.driver_number = l.driver_number AND {a}.{t} >= l.lap_start_at AND {a}.{t} < l.lap_end_at"
_BY_LAP = f"OVER (PARTITION BY {_CAR} ORDER BY lap_number)"
_WIN = "l.lap_id, l.meeting_key, l.session_key, l.driver_number, l.lap_number, l.lap_start_at, l.lap_end_at"
BLOCKS["d_lap_gaps"] = f"""
SELECT *, lag(gap_to_leader_seconds) {_BY_LAP} AS previous_lap_gap_to_leader_seconds, gap_to_leader_seconds - lag(gap_to_leader_seconds) {_BY_LAP} AS gap_delta_to_previous_lap_seconds
FROM (SELECT {_WIN}, i.* EXCLUDE (interval_id, meeting_key, session_key, driver_number) FROM d_hub l LEFT JOIN d_intervals i ON {_IN_LAP.format(a='i', t='interval_at')}
      {_newest('l.lap_id ORDER BY i.interval_at')})"""
BLOCKS["d_lap_positions"] = f"""
SELECT *, lag(position) {_BY_LAP} AS previous_lap_position, lag(position) {_BY_LAP} - position AS position_delta
FROM (SELECT {_WIN}, p.position_at, p.position FROM d_hub l LEFT JOIN d_position p ON {_IN_LAP.format(a='p', t='position_at')} {_newest('l.lap_id ORDER BY p.position_at')})"""
BLOCKS["d_lap_pits"] = f"""
SELECT l.lap_id, l.meeting_key, l.session_key, l.driver_number, l.lap_number, l.lap_start_at, l.lap_duration_seconds, l.is_pit_out_lap, p.pit_stop_id, p.pit_at, p.lap_number AS pit_lap_number,
       p.pit_stop_duration_seconds, p.lane_duration_seconds, p.raw_pit_duration_seconds, p.pit_stop_id IS NOT NULL AS is_pit_in_lap, lead(l.is_pit_out_lap) OVER w AS next_lap_is_pit_out,
       lag(l.lap_duration_seconds) OVER w AS previous_lap_duration_seconds, lead(l.lap_duration_seconds) OVER w AS next_lap_duration_seconds
FROM d_hub l LEFT JOIN (SELECT * FROM d_pit {_newest('session_key, driver_number, lap_number ORDER BY pit_at')}) p
  ON p.session_key = l.session_key AND p.driver_number = l.driver_number AND p.lap_number = l.lap_number
WINDOW w AS (PARTITION BY l.session_key, l.driver_number ORDER BY l.lap_number)"""
BLOCKS["d_lap_stints"] = f"""
SELECT l.lap_id, l.meeting_key, l.session_key, l.driver_number, l.lap_number, s.stint_id, s.stint_number, s.lap_start AS stint_lap_start, s.lap_end AS stint_lap_end, s.stint_lap_count, s.compound,
       s.tyre_age_at_start, coalesce(s.tyre_age_at_start + l.lap_number - s.lap_start, l.lap_number - s.lap_start + 1) AS tyre_age_lap
FROM d_hub l LEFT JOIN d_stints s ON s.session_key = l.session_key AND s.driver_number = l.driver_number AND l.lap_number BETWEEN s.lap_start AND s.lap_end
{_newest('l.lap_id ORDER BY s.stint_number')}"""
_SHARE = ", ".join(
    f"CASE WHEN count(c.car_data_id) > 0 THEN sum(c.{f}) / count(c.car_data_id) END AS {n}"
    for f, n in (("is_braking", "brake_usage_pct"), ("is_full_throttle", "full_throttle_pct"), ("is_drs_active", "drs_active_pct"), ("is_drs_detected", "drs_detected_pct"))
)
_SUMS = ", ".join(
    f"CAST(sum(c.{f}) AS BIGINT) AS {n}_sample_count"
    for f, n in (("is_braking", "brake"), ("is_full_throttle", "full_throttle"), ("is_drs_active", "drs_active"), ("is_drs_detected", "drs_detected"))
)
BLOCKS["d_lap_telemetry"] = f"""
SELECT {_WIN}, count(c.car_data_id) AS telemetry_sample_count, avg(speed) AS avg_speed, max(speed) AS max_speed, avg(throttle) AS avg_throttle, max(throttle) AS max_throttle,
       avg(rpm) AS avg_rpm, max(rpm) AS max_rpm, avg(n_gear) AS avg_gear, {_SUMS}, {_SHARE}
FROM d_hub l LEFT JOIN d_car_data c ON {_IN_LAP.format(a='c', t='telemetry_at')} GROUP BY ALL"""
BLOCKS["d_lap_weather"] = """
SELECT l.lap_id, l.meeting_key, l.session_key, l.driver_number, l.lap_number, w.* EXCLUDE (weather_id, meeting_key, session_key)
FROM d_hub l ASOF LEFT JOIN d_weather w ON w.session_key = l.session_key AND w.weather_at <= l.lap_end_at"""
_INFO = "l.season_year, l.country_name, l.circuit_short_name, l.session_name, l.session_type, l.full_name, l.name_acronym, l.team_name"
_HEAD = f"l.lap_id, l.meeting_key, l.session_key, l.driver_number, {_INFO}"
BLOCKS["d_gap_evolution"] = f"""
SELECT {_HEAD}, l.team_colour_hex, l.lap_number, l.lap_start_at, l.lap_end_at, l.lap_duration_seconds, l.is_valid_lap_time, l.is_pit_out_lap, t.is_pit_in_lap, t.pit_stop_duration_seconds,
       t.lane_duration_seconds, p.position, p.previous_lap_position, p.position_delta, g.gap_to_leader_seconds, g.interval_to_ahead_seconds, g.gap_delta_to_previous_lap_seconds,
       g.is_lapped_to_leader, g.is_lapped_to_ahead, l.sector_1_seconds, l.sector_2_seconds, l.sector_3_seconds, l.max_lap_speed
FROM d_hub l LEFT JOIN d_lap_positions p USING (lap_id) LEFT JOIN d_lap_gaps g USING (lap_id) LEFT JOIN d_lap_pits t USING (lap_id) WHERE l.session_type IN ('Race', 'Sprint')"""
BLOCKS["d_pit_out"] = f"""
SELECT {_HEAD}, lap_number, lap_start_at, lap_duration_seconds, is_pit_in_lap, is_pit_out_lap, pit_stop_duration_seconds, lane_duration_seconds, position, previous_lap_position, position_delta,
       gap_to_leader_seconds, gap_delta_to_previous_lap_seconds, driver_clean_air_avg_lap_seconds, field_clean_avg_lap_seconds,
       CASE WHEN is_pit_out_lap THEN lap_duration_seconds - driver_clean_air_avg_lap_seconds END AS pit_out_loss_vs_driver_avg_seconds,
       CASE WHEN is_pit_out_lap THEN lap_duration_seconds - field_clean_avg_lap_seconds END AS pit_out_loss_vs_field_avg_seconds
FROM (SELECT *, avg(clean) OVER (PARTITION BY session_key, driver_number) AS driver_clean_air_avg_lap_seconds, avg(clean) OVER (PARTITION BY session_key, lap_number) AS field_clean_avg_lap_seconds
      FROM (SELECT *, CASE WHEN is_valid_lap_time AND NOT is_pit_out_lap AND NOT is_pit_in_lap THEN lap_duration_seconds END AS clean FROM d_gap_evolution)) l
WHERE is_pit_out_lap OR is_pit_in_lap"""
BLOCKS["d_sector_pace"] = f"""
WITH s AS (UNPIVOT (SELECT * FROM d_hub WHERE is_valid_sector_time) ON sector_1_seconds, sector_2_seconds, sector_3_seconds INTO NAME sector VALUE sec),
n AS (SELECT *, CAST(sector[8] AS INTEGER) AS sector_number FROM s),
r AS (SELECT meeting_key, season_year, country_name, circuit_short_name, driver_number, full_name, name_acronym, team_name, sector_number, avg(sec) AS race_avg_sector_seconds,
             min(sec) AS race_best_sector_seconds, count(*) AS race_sector_lap_count FROM n WHERE session_type IN ('Race', 'Sprint') GROUP BY ALL),
q AS (SELECT meeting_key, driver_number, sector_number, avg(sec) AS qualifying_avg_sector_seconds, min(sec) AS qualifying_best_sector_seconds, count(*) AS qualifying_sector_lap_count
      FROM n WHERE session_type IN ('Qualifying', 'Sprint Qualifying', 'Sprint Shootout') GROUP BY ALL)
SELECT {key('meeting_key', 'driver_number', 'sector_number')} AS race_qualifying_sector_id, *,
       race_avg_sector_seconds - qualifying_best_sector_seconds AS avg_race_vs_best_qualifying_delta_seconds,
       race_best_sector_seconds - qualifying_best_sector_seconds AS best_race_vs_best_qualifying_delta_seconds,
       (race_avg_sector_seconds - qualifying_best_sector_seconds) / nullif(qualifying_best_sector_seconds, 0) AS avg_race_vs_qualifying_delta_pct
FROM r LEFT JOIN q USING (meeting_key, driver_number, sector_number)"""
_FIELD = ", ".join(f"{c} - avg({c}) OVER (PARTITION BY session_key, lap_number) AS {n}_delta_to_field_seconds" for n, c in (
    ("sector_1", "sector_1_seconds"), ("sector_2", "sector_2_seconds"), ("sector_3", "sector_3_seconds"), ("lap", "lap_duration_seconds")))
BLOCKS["d_sector_impact"] = f"""
SELECT {_HEAD}, lap_number, lap_start_at, lap_duration_seconds, sector_1_seconds, sector_2_seconds, sector_3_seconds, {_FIELD},
       position, previous_lap_position, position_delta, gap_to_leader_seconds, gap_delta_to_previous_lap_seconds
FROM d_gap_evolution l WHERE is_valid_lap_time"""
BLOCKS["d_telemetry_laps"] = f"""
SELECT {_HEAD}, l.team_colour_hex, l.lap_number, l.lap_start_at, l.lap_end_at, l.lap_duration_seconds, l.is_pit_out_lap,
       t.* EXCLUDE (lap_id, meeting_key, session_key, driver_number, lap_number, lap_start_at, lap_end_at)
FROM d_lap_telemetry t LEFT JOIN d_hub l USING (lap_id) WHERE t.telemetry_sample_count >= {{min_samples}}"""
BLOCKS["d_telemetry_laps"] = BLOCKS["d_telemetry_laps"].replace("{min_samples}", "3")
BLOCKS["d_telemetry_sessions"] = f"""
SELECT {key('session_key', 'driver_number')} AS telemetry_driver_session_id, meeting_key, session_key, driver_number, {_INFO}, count(*) AS observed_laps, avg(avg_speed) AS session_avg_speed,
       max(max_speed) AS session_max_speed, avg(avg_throttle) AS session_avg_throttle, avg(brake_usage_pct) AS session_avg_brake_usage_pct, avg(drs_active_pct) AS session_avg_drs_active_pct,
       avg(full_throttle_pct) AS session_avg_full_throttle_pct, CAST(sum(telemetry_sample_count) AS BIGINT) AS telemetry_sample_count
FROM d_telemetry_laps l GROUP BY ALL"""
_TYRE = "s.stint_id, s.stint_number, s.stint_lap_start, s.stint_lap_end, s.stint_lap_count, s.compound, s.tyre_age_at_start, s.tyre_age_lap"
BLOCKS["d_tyre_weather"] = f"""
SELECT {_HEAD}, l.team_colour_hex, l.lap_number, l.lap_start_at, l.lap_duration_seconds, l.is_valid_lap_time, l.is_pit_out_lap, {_TYRE},
       w.* EXCLUDE (lap_id, meeting_key, session_key, driver_number, lap_number),
       CASE WHEN track_temperature < 25 THEN 'TRACK_COLD' WHEN track_temperature < 35 THEN 'TRACK_MODERATE' WHEN track_temperature < 45 THEN 'TRACK_HOT'
            WHEN track_temperature >= 45 THEN 'TRACK_VERY_HOT' ELSE 'UNKNOWN' END AS track_temp_bucket,
       CASE WHEN humidity < 40 THEN 'HUMIDITY_LOW' WHEN humidity < 70 THEN 'HUMIDITY_MEDIUM' WHEN humidity >= 70 THEN 'HUMIDITY_HIGH' ELSE 'UNKNOWN' END AS humidity_bucket
FROM d_hub l LEFT JOIN d_lap_stints s USING (lap_id) LEFT JOIN d_lap_weather w USING (lap_id) WHERE l.session_type IN ('Race', 'Sprint')"""
BLOCKS["d_tyre_clean"] = "SELECT * FROM d_tyre_weather WHERE is_valid_lap_time AND NOT is_pit_out_lap AND compound IS NOT NULL"
BLOCKS["d_degradation"] = f"""
SELECT {key('season_year', 'circuit_short_name', 'compound', 'tyre_age_lap')} AS tyre_degradation_id, *, avg_lap_seconds - best_avg_lap_seconds_for_compound AS degradation_vs_best_age_seconds
FROM (SELECT *, min(avg_lap_seconds) OVER (PARTITION BY season_year, circuit_short_name, compound) AS best_avg_lap_seconds_for_compound
      FROM (SELECT season_year, circuit_short_name, compound, tyre_age_lap, count(*) AS sample_laps, count(DISTINCT driver_number) AS sample_drivers, count(DISTINCT session_key) AS sample_sessions,
                   avg(lap_duration_seconds) AS avg_lap_seconds, min(lap_duration_seconds) AS best_lap_seconds, median(lap_duration_seconds) AS median_lap_seconds,
                   avg(track_temperature) AS avg_track_temperature, avg(humidity) AS avg_humidity, max(CASE WHEN rainfall THEN 1 ELSE 0 END) AS has_rainfall
            FROM d_tyre_clean WHERE tyre_age_lap IS NOT NULL GROUP BY ALL)) WHERE sample_laps >= 5"""
BLOCKS["d_tyre_life"] = f"""
SELECT {key('season_year', 'circuit_short_name', 'compound')} AS optimal_tyre_life_id, season_year, circuit_short_name, compound, tyre_age_lap AS optimal_tyre_age_lap, sample_laps, sample_drivers,
       sample_sessions, avg_lap_seconds AS optimal_age_avg_lap_seconds, best_lap_seconds AS optimal_age_best_lap_seconds, median_lap_seconds AS optimal_age_median_lap_seconds,
       avg_track_temperature, avg_humidity, has_rainfall
FROM d_degradation QUALIFY row_number() OVER (PARTITION BY season_year, circuit_short_name, compound ORDER BY avg_lap_seconds, sample_laps DESC, tyre_age_lap) = 1"""
_CLEANLAP = "CASE WHEN l.is_valid_lap_time AND NOT l.is_pit_out_lap THEN l.lap_duration_seconds END"
BLOCKS["d_strategy"] = f"""
SELECT {key('s.session_key', 's.driver_number', 's.stint_number')} AS team_tyre_strategy_id, s.* EXCLUDE (stint_id), {_INFO}, avg({_CLEANLAP}) AS avg_clean_lap_seconds_in_stint,
       min({_CLEANLAP}) AS best_clean_lap_seconds_in_stint, CAST(count_if(l.is_valid_lap_time) AS BIGINT) AS observed_valid_laps, avg(w.track_temperature) AS avg_track_temperature,
       avg(w.air_temperature) AS avg_air_temperature, avg(w.humidity) AS avg_humidity, max(CASE WHEN w.rainfall THEN 1 ELSE 0 END) AS has_rainfall
FROM d_stints s JOIN d_hub l ON l.session_key = s.session_key AND l.driver_number = s.driver_number AND l.lap_number BETWEEN s.lap_start AND s.lap_end
LEFT JOIN d_lap_weather w ON w.lap_id = l.lap_id WHERE l.session_type IN ('Race', 'Sprint') GROUP BY ALL"""
_IMP = "season_year, circuit_short_name, compound, track_temp_bucket, humidity_bucket, weather_condition_bucket"


def corr(x: str, y: str) -> str:
    """Correlation with NULL instead of NaN."""
    return f"(CASE WHEN isnan(corr({y}, {x})) THEN NULL ELSE corr({y}, {x}) END)"


BLOCKS["d_impact"] = f"""
SELECT {key(*_IMP.split(', '))} AS tyre_weather_impact_id, {_IMP}, count(*) AS sample_laps, count(DISTINCT driver_number) AS sample_drivers, count(DISTINCT team_name) AS sample_teams,
       avg(lap_duration_seconds) AS avg_lap_seconds, min(lap_duration_seconds) AS best_lap_seconds, median(lap_duration_seconds) AS median_lap_seconds, avg(track_temperature) AS avg_track_temperature,
       avg(air_temperature) AS avg_air_temperature, avg(humidity) AS avg_humidity, avg(tyre_age_lap) AS avg_tyre_age_lap, max(CASE WHEN rainfall THEN 1 ELSE 0 END) AS has_rainfall,
       {corr('humidity', 'lap_duration_seconds')} AS corr_humidity_lap_seconds, {corr('track_temperature', 'lap_duration_seconds')} AS corr_track_temp_lap_seconds
FROM d_tyre_clean GROUP BY ALL"""

# --- dashboard-grain models --------------------------------------------------------------------------------


def _tok(c: str) -> str:
    return f"nullif(nullif(nullif(trim({c}), ''), 'None'), 'null')"


def _xsec(c: str) -> str:
    return f"""CASE WHEN lower(trim({c})) IN ('', 'none', 'null', 'nan') THEN NULL
       WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+(\\.[0-9]+)?') THEN TRY_CAST({c} AS DOUBLE)
       WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+:[0-9]{{2}}(\\.[0-9]+)?') THEN TRY_CAST(split_part({c}, ':', 1) AS DOUBLE) * 60 + TRY_CAST(split_part({c}, ':', 2) AS DOUBLE) END"""


_TS = "date AS timestamp_utc, CAST(date AS DATE) AS event_date"
BLOCKS["x_car_data"] = f"""
SELECT {key('meeting_key', 'session_key', 'driver_number', time('date'), 'rpm', 'speed', 'throttle', 'brake', 'n_gear', 'drs')} AS car_data_id, meeting_key, session_key, driver_number, {_TS},
       rpm, speed, throttle, brake, n_gear, drs FROM b_car {_newest('car_data_id ORDER BY timestamp_utc')}"""
BLOCKS["x_drivers"] = f"""
SELECT {key('session_key', 'driver_number')} AS session_driver_id, meeting_key, session_key, driver_number, {_tok('broadcast_name')} AS broadcast_name, {_tok('first_name')} AS first_name,
       {_tok('last_name')} AS last_name, {_tok('full_name')} AS full_name, {_tok('name_acronym')} AS name_acronym, {_tok('headshot_url')} AS headshot_url, {_tok('team_name')} AS team_name,
       CASE WHEN trim(team_colour) <> '' THEN '#' || ltrim(upper(trim(team_colour)), '#') END AS team_colour_hex, {_tok('country_code')} AS country_code FROM b_drivers"""
BLOCKS["x_intervals"] = f"""
SELECT {key('meeting_key', 'session_key', 'driver_number', time('date'))} AS interval_id, meeting_key, session_key, driver_number, {_TS}, g AS gap_to_leader_raw, {_xsec('g')} AS gap_to_leader_seconds,
       i AS interval_to_ahead_raw, {_xsec('i')} AS interval_to_ahead_seconds
FROM (SELECT *, {_tok('gap_to_leader')} AS g, {_tok('"interval"')} AS i FROM b_intervals) {_newest('interval_id ORDER BY timestamp_utc')}"""
BLOCKS["x_laps"] = f"""
SELECT {key('session_key', 'driver_number', 'lap_number')} AS lap_id, meeting_key, session_key, driver_number, lap_number, date_start AS lap_start_at,
       date_start + to_milliseconds(CAST(round(lap_duration * 1000) AS BIGINT)) AS lap_end_at, CAST(date_start AS DATE) AS event_date, lap_duration AS lap_duration_seconds,
       duration_sector_1 AS sector_1_seconds, duration_sector_2 AS sector_2_seconds, duration_sector_3 AS sector_3_seconds, i1_speed, i2_speed, st_speed AS speed_trap, is_pit_out_lap FROM b_laps"""
BLOCKS["x_meetings"] = f"""
SELECT meeting_key, circuit_key, {', '.join(f'{_tok(c)} AS {c}' for c in 'meeting_name meeting_official_name country_name circuit_image circuit_info_url circuit_short_name circuit_type circuit_code circuit_flag gmt_offset location'.split())},
       year AS season_year, date_start AS meeting_start_at, date_end AS meeting_end_at, is_cancelled FROM b_meetings"""
BLOCKS["x_position"] = f"""
SELECT {key('meeting_key', 'session_key', 'driver_number', time('date'), 'position')} AS position_id, meeting_key, session_key, driver_number, {_TS}, position
FROM b_position {_newest('position_id ORDER BY timestamp_utc')}"""
BLOCKS["x_sessions"] = f"""
SELECT session_key, meeting_key, circuit_key, {', '.join(f'{_tok(c)} AS {c}' for c in 'country_name session_name session_type circuit_short_name country_code gmt_offset location'.split())},
       year AS season_year, date_start AS session_start_at, date_end AS session_end_at, is_cancelled FROM b_sessions"""
BLOCKS["x_stints"] = f"""
SELECT {key('session_key', 'driver_number', 'stint_number')} AS stint_id, meeting_key, session_key, driver_number, stint_number, lap_start, lap_end,
       CASE WHEN lap_end >= lap_start THEN lap_end - lap_start + 1 END AS stint_lap_count, coalesce(upper({_tok('compound')}), 'UNKNOWN') AS compound, tyre_age_at_start FROM b_stints"""
BLOCKS["x_weather"] = f"""
SELECT {key('meeting_key', 'session_key', time('date'))} AS weather_id, meeting_key, session_key, {_TS}, air_temperature, track_temperature, pressure, humidity, rainfall, wind_speed, wind_direction
FROM b_weather {_newest('weather_id ORDER BY timestamp_utc')}"""
_TOP = "greatest(coalesce(i1_speed, 0), coalesce(i2_speed, 0), coalesce(speed_trap, 0))"
BLOCKS["x_lap_rollup"] = f"""
SELECT meeting_key, session_key, driver_number, count(*) AS lap_count, min(lap_duration_seconds) AS best_lap_seconds, avg(lap_duration_seconds) AS avg_lap_seconds,
       max(lap_duration_seconds) AS slowest_lap_seconds, first(lap_number ORDER BY lap_duration_seconds, lap_number) AS best_lap_number, avg(sector_1_seconds) AS avg_sector_1_seconds,
       avg(sector_2_seconds) AS avg_sector_2_seconds, avg(sector_3_seconds) AS avg_sector_3_seconds, max({_TOP}) AS max_lap_speed FROM x_laps WHERE lap_duration_seconds > 0 GROUP BY ALL"""
BLOCKS["x_latest_gaps"] = f"""
SELECT meeting_key, session_key, driver_number, gap_to_leader_raw, gap_to_leader_seconds, interval_to_ahead_raw, interval_to_ahead_seconds, timestamp_utc AS latest_interval_at
FROM x_intervals {_newest('session_key, driver_number ORDER BY timestamp_utc')}"""
BLOCKS["x_latest_positions"] = f"""
SELECT meeting_key, session_key, driver_number, position AS final_position, timestamp_utc AS final_position_at FROM x_position {_newest('session_key, driver_number ORDER BY timestamp_utc')}"""
_STOP = "FILTER (is_valid_stationary_stop_duration)"
_LANE = "FILTER (is_valid_lane_duration)"
BLOCKS["x_pit_rollup"] = f"""
SELECT meeting_key, session_key, driver_number, count(*) AS pit_event_count, CAST(count_if(has_stationary_stop_duration) AS BIGINT) AS pit_stop_count,
       avg(pit_stop_duration_seconds) {_STOP} AS avg_pit_duration_seconds, min(pit_stop_duration_seconds) {_STOP} AS fastest_pit_duration_seconds,
       max(pit_stop_duration_seconds) {_STOP} AS slowest_pit_duration_seconds, avg(lane_duration_seconds) {_LANE} AS avg_pit_lane_duration_seconds,
       min(lane_duration_seconds) {_LANE} AS fastest_pit_lane_duration_seconds, max(lane_duration_seconds) {_LANE} AS slowest_pit_lane_duration_seconds,
       avg(raw_pit_duration_seconds) AS avg_raw_pit_duration_seconds, string_agg(CAST(lap_number AS VARCHAR), ', ' ORDER BY lap_number) AS pit_laps,
       min(pit_at) AS first_pit_at, max(pit_at) AS last_pit_at FROM d_pit GROUP BY ALL"""
BLOCKS["x_stint_rollup"] = """
SELECT meeting_key, session_key, driver_number, count(*) AS stint_count, CAST(sum(stint_lap_count) AS BIGINT) AS stint_lap_count_total, avg(stint_lap_count) AS avg_stint_lap_count,
       string_agg(DISTINCT compound, ', ' ORDER BY compound) AS compounds_used FROM x_stints GROUP BY ALL"""
BLOCKS["x_dim_sessions"] = """
SELECT s.session_key, s.meeting_key, s.season_year, coalesce(s.country_name, m.country_name) AS country_name, coalesce(s.circuit_short_name, m.circuit_short_name) AS circuit_short_name,
       s.session_name, s.session_type, s.session_start_at, s.session_end_at, s.gmt_offset, s.is_cancelled, s.location, m.meeting_name, m.meeting_official_name,
       s.season_year || ' - ' || coalesce(s.country_name, m.country_name) || ' - ' || s.session_name AS session_display_name FROM x_sessions s LEFT JOIN x_meetings m USING (meeting_key)"""
BLOCKS["x_dim_drivers"] = "SELECT d.*, s.season_year, s.session_type, s.session_display_name FROM x_drivers d LEFT JOIN x_dim_sessions s USING (session_key)"
_XD = "d.full_name, d.name_acronym, d.team_name, d.team_colour_hex"
_XS = "s.season_year, s.country_name, s.circuit_short_name, s.session_name, s.session_type"
_XJ = "LEFT JOIN x_drivers d ON d.session_key = r.session_key AND d.driver_number = r.driver_number LEFT JOIN x_dim_sessions s ON s.session_key = r.session_key"
BLOCKS["x_minutes"] = f"""
SELECT {key('session_key', 'driver_number', time('sample_minute'))} AS telemetry_minute_id, *, CAST(sample_minute AS DATE) AS event_date
FROM (SELECT meeting_key, session_key, driver_number, date_trunc('minute', timestamp_utc) AS sample_minute, count(*) AS sample_count, avg(speed) AS avg_speed, max(speed) AS max_speed,
             avg(rpm) AS avg_rpm, max(rpm) AS max_rpm, avg(throttle) AS avg_throttle, avg(brake) AS avg_brake, max(drs) AS max_drs_state, max(n_gear) AS max_gear, min(n_gear) AS min_gear
      FROM x_car_data GROUP BY ALL)"""
BLOCKS["x_telemetry_minutes"] = f"SELECT r.*, {_XD}, {_XS} FROM x_minutes r {_XJ}"
BLOCKS["x_summary"] = f"""
SELECT r.session_driver_id, r.meeting_key, r.session_key, r.driver_number, r.full_name, r.name_acronym, r.team_name, r.team_colour_hex, {_XS}, s.session_start_at, s.session_end_at,
       coalesce(l.lap_count, 0) AS lap_count, l.* EXCLUDE (meeting_key, session_key, driver_number, lap_count, max_lap_speed), greatest(l.max_lap_speed, t.top) AS max_speed, t.avg_speed, t.avg_rpm,
       coalesce(p.pit_event_count, 0) AS pit_event_count, coalesce(p.pit_stop_count, 0) AS pit_stop_count, p.* EXCLUDE (meeting_key, session_key, driver_number, pit_event_count, pit_stop_count),
       coalesce(st.stint_count, 0) AS stint_count, st.compounds_used, f.final_position, f.final_position_at, g.gap_to_leader_seconds, g.interval_to_ahead_seconds
FROM x_drivers r LEFT JOIN x_dim_sessions s ON s.session_key = r.session_key
LEFT JOIN x_lap_rollup l ON l.session_key = r.session_key AND l.driver_number = r.driver_number LEFT JOIN x_pit_rollup p ON p.session_key = r.session_key AND p.driver_number = r.driver_number
LEFT JOIN x_stint_rollup st ON st.session_key = r.session_key AND st.driver_number = r.driver_number
LEFT JOIN x_latest_positions f ON f.session_key = r.session_key AND f.driver_number = r.driver_number
LEFT JOIN x_latest_gaps g ON g.session_key = r.session_key AND g.driver_number = r.driver_number
LEFT JOIN (SELECT session_key, driver_number, max(max_speed) AS top, avg(avg_speed) AS avg_speed, avg(avg_rpm) AS avg_rpm FROM x_minutes GROUP BY ALL) t
  ON t.session_key = r.session_key AND t.driver_number = r.driver_number"""
BLOCKS["x_laps_fact"] = f"SELECT r.*, {_TOP} AS max_lap_speed, {_XD}, {_XS} FROM x_laps r {_XJ} WHERE lap_start_at IS NOT NULL"
BLOCKS["x_position_minutes"] = f"""
SELECT r.*, {_XD}, {_XS} FROM (
  SELECT {key('session_key', 'driver_number', time('position_minute'))} AS position_minute_id, meeting_key, session_key, driver_number, position_minute, CAST(position_minute AS DATE) AS event_date, position,
         timestamp_utc AS source_timestamp_utc FROM (SELECT *, date_trunc('minute', timestamp_utc) AS position_minute FROM x_position)
  {_newest('session_key, driver_number, position_minute ORDER BY timestamp_utc')}) r {_XJ}"""
BLOCKS["x_leaderboard"] = f"""
SELECT {key('session_key', 'driver_number')} AS leaderboard_id, * EXCLUDE (final_position_at), final_position IS NOT NULL AS has_final_position,
       row_number() OVER (PARTITION BY session_key ORDER BY final_position NULLS LAST, gap_to_leader_seconds NULLS LAST, best_lap_seconds NULLS LAST, driver_number) AS leaderboard_rank
FROM x_summary WHERE session_type IN ('Race', 'Sprint')"""
BLOCKS["x_stint_performance"] = f"""
SELECT r.*, {_XD}, {_XS} FROM (
  SELECT st.*, avg(l.lap_duration_seconds) AS avg_lap_seconds_in_stint, min(l.lap_duration_seconds) AS best_lap_seconds_in_stint, max(l.max_lap_speed) AS max_speed_in_stint,
         count(l.lap_id) AS observed_lap_count
  FROM x_stints st LEFT JOIN x_laps_fact l ON l.session_key = st.session_key AND l.driver_number = st.driver_number AND l.lap_number BETWEEN st.lap_start AND st.lap_end GROUP BY ALL) r {_XJ}"""
BLOCKS["x_slices"] = f"""
SELECT {key('session_key', time('weather_5min'))} AS weather_5min_id, *, CAST(weather_5min AS DATE) AS event_date
FROM (SELECT meeting_key, session_key, time_bucket(INTERVAL 5 MINUTE, timestamp_utc) AS weather_5min, avg(air_temperature) AS avg_air_temperature, avg(track_temperature) AS avg_track_temperature,
             avg(pressure) AS avg_pressure, avg(humidity) AS avg_humidity, max(CASE WHEN rainfall THEN 1 ELSE 0 END) AS has_rainfall, avg(wind_speed) AS avg_wind_speed,
             avg(wind_direction) AS avg_wind_direction, count(*) AS weather_sample_count FROM x_weather GROUP BY ALL)"""
BLOCKS["x_weather_slices"] = f"SELECT r.*, {_XS} FROM x_slices r LEFT JOIN x_dim_sessions s USING (session_key)"
BLOCKS["x_session_summary"] = """
SELECT s.session_key, s.meeting_key, s.season_year, s.country_name, s.circuit_short_name, s.meeting_name, s.session_name, s.session_type, s.session_display_name, s.session_start_at, s.session_end_at,
       coalesce(driver_count, 0) AS driver_count, coalesce(total_laps, 0) AS total_laps, fastest_lap_seconds, max_speed, coalesce(total_pit_stops, 0) AS total_pit_stops,
       avg_air_temperature, avg_track_temperature, coalesce(has_rainfall, 0) AS has_rainfall
FROM x_dim_sessions s
LEFT JOIN (SELECT session_key, count(DISTINCT driver_number) AS driver_count, CAST(sum(lap_count) AS BIGINT) AS total_laps, min(best_lap_seconds) AS fastest_lap_seconds, max(max_speed) AS max_speed,
                  CAST(sum(pit_stop_count) AS BIGINT) AS total_pit_stops FROM x_summary GROUP BY 1) USING (session_key)
LEFT JOIN (SELECT session_key, avg(avg_air_temperature) AS avg_air_temperature, avg(avg_track_temperature) AS avg_track_temperature, max(has_rainfall) AS has_rainfall FROM x_slices GROUP BY 1) USING (session_key)"""
