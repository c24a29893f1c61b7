"""Queries for joins (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall import functions as fx
from pitwall.catalog.registry import query, register
from pitwall.catalog.scalars import r
from pitwall.operators.intervals import asof_join, explode_numbers, last_in_interval, range_join, range_left_join, spacing
from pitwall.plans import dashboard as x, laps as d, production as p

CAR, LAP = p.CAR, p.LAP

register(
    "j01_inner",
    lambda t: t.table("orders").join(t.table("customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name"),
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
register(
    "j02_inner_two_keys", lambda t: t["laps"].join(t["drivers"].select(*CAR, "full_name"), CAR).select(*LAP, "full_name"),
    "SELECT session_key, driver_number, lap_number, full_name FROM b_laps JOIN b_drivers USING (session_key, driver_number)",
)
register(
    "j03_left_star",
    lambda t: t["drivers"].select(*CAR, "team_name").join(t["sessions"].select("session_key", "session_type"), "session_key", "left")
    .join(p.best_laps(t), CAR, "left").join(p.pit_stops(t), CAR, "left").join(p.final_positions(t).drop("latest_date"), CAR, "left"),
    f"""SELECT d.session_key, d.driver_number, d.team_name, s.session_type, {r('best_lap_time', 'best_lap_time')}, pit_stop_count, position FROM b_drivers d LEFT JOIN b_sessions s USING (session_key)
        LEFT JOIN p_best_laps USING (session_key, driver_number) LEFT JOIN p_pit_stops USING (session_key, driver_number) LEFT JOIN p_final_positions USING (session_key, driver_number)""",
)


@query("j04_cast_key", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def _(t):
    c = t.table("customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("code"))
    return c.join(t.table("nation"), F.col("code").cast("int") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")


@query("j05_fan_out", "SELECT session_key, m.meeting_key, meeting_name FROM b_sessions s JOIN b_meetings m ON m.country_name = s.country_name AND m.year = s.year")
def _(t):
    # a country with several meetings a year repeats its sessions; every match is part of the result
    meetings = t["meetings"].select("meeting_key", "meeting_name", "country_name", "year")
    return t["sessions"].select("session_key", "country_name", "year").join(meetings, ["country_name", "year"]).select("session_key", "meeting_key", "meeting_name")


@query(
    "j05_fan_out_meetings",
    """WITH held AS (SELECT DISTINCT o_custkey AS country, year(o_orderdate) AS year FROM orders),
            meetings AS (SELECT country, year, 1 AS part FROM held UNION ALL SELECT country, year, 2 FROM held WHERE country % 3 = 0)
       SELECT o_orderkey AS session_key, country, CAST(m.year AS INTEGER) AS year, part FROM orders JOIN meetings m ON m.country = o_custkey AND m.year = year(o_orderdate)""",
)
def _(t):
    """Sessions of countries of which every third has two meetings in a year: there each session is repeated, once per meeting."""
    ses = t.table("orders").select(F.col("o_orderkey").alias("session_key"), F.col("o_custkey").alias("country"), F.year("o_orderdate").alias("year"))
    parts = F.when(F.col("country") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    meetings = ses.select("country", "year").distinct().select("country", "year", F.explode(parts).alias("part"))
    return ses.join(meetings, ["country", "year"]).select("session_key", "country", "year", "part")


_MATCH = "session_key, driver_number, lap_number"
register(
    "j06_range_closed",
    lambda t: range_join(
        p.laps(t).select(*LAP, "date_start", "date_end"), t["position"].select(*CAR, "date", "position"), CAR, "date_start", "date_end", "date",
        spacing(t["laps"], CAR, "date_start"), closed=True,
    ).select(*LAP, "date", "position"),
    f"SELECT {_MATCH}, p.date, p.position FROM b_position p JOIN p_laps l USING (session_key, driver_number) WHERE p.date BETWEEN l.date_start AND l.date_end",
)


@query(
    "j07_interval_half_open",
    """SELECT l.session_key, l.driver_number, l.lap_number, c.date, c.speed FROM d_hub l
       LEFT JOIN b_car c ON c.session_key = l.session_key AND c.driver_number = l.driver_number AND c.date >= l.lap_start_at AND c.date < l.lap_end_at""",
)
def _(t):
    lap = d._windows(t, d.DEFAULTS).select(*LAP, "lap_start_at", "lap_end_at")
    hits = range_join(lap, t["car_data"].select(*CAR, "date", "speed"), CAR, "lap_start_at", "lap_end_at", "date", spacing(t["laps"], CAR, "date_start"))
    return lap.select(*LAP).join(hits.select(*LAP, "date", "speed"), LAP, "left")


@query(
    "j08_interval_truncated",
    """SELECT l.session_key, l.driver_number, l.lap_number, i.gap_to_leader FROM p_laps l LEFT JOIN b_intervals i
       ON i.session_key = l.session_key AND i.driver_number = l.driver_number AND date_trunc('second', i.date) BETWEEN l.date_start AND l.date_end""",
)
def _(t):
    lap = p.laps(t).select(*LAP, "date_start", "date_end")
    gaps = t["intervals"].select(*CAR, fx.trunc_to("second", F.col("date")).alias("at"), "gap_to_leader")
    hits = range_join(lap, gaps, CAR, "date_start", "date_end", "at", spacing(t["laps"], CAR, "date_start"), closed=True)
    return lap.select(*LAP).join(hits.select(*LAP, "gap_to_leader"), LAP, "left")


register(
    "j09_lap_in_stint",
    lambda t: t["laps"].select(*LAP).join(
        explode_numbers(t["stints"].select(*CAR, "stint_number", "lap_start", "lap_end"), CAR, "lap_start", "lap_end", t["laps"], "lap_number").select(*LAP, "stint_number"), LAP, "left"),
    "SELECT l.session_key, l.driver_number, l.lap_number, s.stint_number FROM b_laps l LEFT JOIN b_stints s ON s.session_key = l.session_key AND s.driver_number = l.driver_number AND l.lap_number BETWEEN lap_start AND lap_end",
)
register(
    "j10_session_range",
    lambda t: range_join(
        p.stint_laps(t).select(*CAR, "stint_number", "stint_start_time", "stint_end_time"), t["position"].select(*CAR, "date", "position"), CAR,
        "stint_start_time", "stint_end_time", "date", spacing(t["laps"], CAR, "date_start"), closed=True,
    ).select(*CAR, "stint_number", "date", "position"),
    "SELECT session_key, driver_number, stint_number, o.date, o.position FROM p_stint_laps JOIN b_position o USING (session_key, driver_number) WHERE o.date BETWEEN stint_start_time AND stint_end_time",
)


@query(
    "j10_session_weather",
    f"""SELECT s.session_key, s.driver_number, s.stint_number, w.date, {r('w.humidity', 'humidity')} FROM p_stint_laps s LEFT JOIN b_weather w
        ON w.session_key = s.session_key AND w.date BETWEEN s.stint_start_time AND s.stint_end_time""",
)
def _(t):
    """Every reading of the session during a stint, whatever the car; stints without any stay."""
    st = p.stint_laps(t).select(*CAR, "stint_number", "stint_start_time", "stint_end_time")
    return range_left_join(st, t["weather"].select("session_key", "date", "humidity"), ["session_key"], "stint_start_time", "stint_end_time", "date").drop("stint_start_time", "stint_end_time")


register(
    "j11_asof",
    lambda t: asof_join(
        t.events("click").select("event_id", "session_key", "ts"), t["weather"].select("session_key", F.col("date").alias("at"), "humidity", "rainfall"), ["session_key"], "ts", "at",
        ["humidity", "rainfall"],
    ),
    f"""SELECT e.event_id, e.session_key, e.ts, w.date AS at, {r('w.humidity', 'humidity')}, w.rainfall FROM (SELECT * FROM e_all WHERE event_type = 'click') e
        ASOF LEFT JOIN b_weather w ON w.session_key = e.session_key AND w.date <= e.ts""",
)


@query(
    "j12_last_in_interval",
    """SELECT l.session_key, l.driver_number, l.lap_number, p.date, p.position FROM d_hub l LEFT JOIN b_position p ON p.session_key = l.session_key AND p.driver_number = l.driver_number
       AND p.date >= l.lap_start_at AND p.date < l.lap_end_at QUALIFY row_number() OVER (PARTITION BY l.lap_id ORDER BY p.date DESC NULLS LAST) = 1""",
)
def _(t):
    lap = d._windows(t, d.DEFAULTS).select(*LAP, "lap_start_at", "lap_end_at")
    width = spacing(t["laps"], CAR, "date_start")
    hit = last_in_interval(lap, {"position": t["position"].select(*CAR, "date", "position")}, CAR, LAP, "lap_start_at", "lap_end_at", width)
    return lap.select(*LAP).join(hit, LAP, "left")


@query(
    "j13_nearest",
    f"""SELECT {_MATCH}, first(position ORDER BY start_time_diff, date) AS at_start, first(date ORDER BY end_time_diff, date) AS end_date FROM p_lap_positions GROUP BY ALL""",
)
def _(t):
    return p._positions_in_laps(t).groupBy(*LAP).agg(
        F.min_by("position", F.struct("start_time_diff", "date")).alias("at_start"), F.min_by("date", F.struct("end_time_diff", "date")).alias("end_date")
    )


register(
    "j14_left_made_inner",
    lambda t: t.table("orders").join(t.table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left").filter(F.col("c_mktsegment") == "BUILDING").select("o_orderkey", "c_mktsegment"),
    "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'",
)


@query(
    "j15_two_branch_totals",
    f"""SELECT session_key, teams, laps, {r('top', 'top')} FROM (SELECT session_key, count(DISTINCT team_name) AS teams FROM b_drivers GROUP BY 1)
        JOIN (SELECT session_key, count(*) AS laps, max(lap_duration) AS top FROM b_laps GROUP BY 1) USING (session_key)""",
)
def _(t):
    teams = t["drivers"].groupBy("session_key").agg(F.count_distinct("team_name").alias("teams"))
    cars = t["laps"].groupBy("session_key").agg(F.count("*").alias("laps"), F.max("lap_duration").alias("top"))
    return teams.join(cars, "session_key")


@query(
    "j16_self_derived",
    f"""SELECT a.driver_number, {r('a.m', 'race')}, {r('b.m', 'qualifying')} FROM (SELECT driver_number, avg(lap_duration) AS m FROM b_laps WHERE session_key IN (1, 3) GROUP BY 1) a
        LEFT JOIN (SELECT driver_number, min(lap_duration) AS m FROM b_laps WHERE session_key = 2 GROUP BY 1) b USING (driver_number)""",
)
def _(t):
    # one pass gives both aggregates: the groups are the same drivers, so no self-join is needed
    qualifying = F.col("session_key") == 2
    out = t["laps"].groupBy("driver_number").agg(
        F.avg(F.when(~qualifying, F.col("lap_duration"))).alias("race"), F.min(F.when(qualifying, F.col("lap_duration"))).alias("qualifying"), F.count_if(~qualifying).alias("n")
    )
    return out.filter(F.col("n") > 0).drop("n")


register(
    "j17_missing_parent",
    lambda t: t.table("lineitem").join(t.table("orders").filter(F.col("o_orderstatus") != "P"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("l_orderkey", "l_linenumber", "l_partkey"),
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')",
)
register(
    "j18_context_by_id",
    lambda t: t["laps"].select(*LAP, "lap_duration").join(x.lap_rollup(t).select(*CAR, "best_lap_seconds"), CAR, "left").join(d.lap_stints(t).select(*LAP, "stint_number", "compound"), LAP, "left"),
    f"""SELECT session_key, driver_number, l.lap_number, {r('lap_duration', 'lap_duration')}, {r('best_lap_seconds', 'best_lap_seconds')}, stint_number, compound FROM b_laps l
        LEFT JOIN x_lap_rollup USING (session_key, driver_number) LEFT JOIN (SELECT session_key, driver_number, lap_number, stint_number, compound FROM d_lap_stints) USING (session_key, driver_number, lap_number)""",
)
