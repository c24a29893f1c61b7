"""Queries for data-quality checks (Q)."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from pitwall.catalog.registry import register
from pitwall.catalog.scalars import r
from pitwall.operators import checks as c
from pitwall.plans import dashboard as x, laps as d
from pitwall.settings import COMPOUNDS
from pitwall.sources.scratch import scratch_path

def gappy_col():
    return F.when(F.col("c_nationkey") > 3, F.col("c_name"))


register(
    "q01_not_null",
    lambda t: c.violations(t.table("customer").withColumn("name", gappy_col()), c.not_null("name", only=F.col("c_mktsegment") == "BUILDING")).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE c_nationkey <= 3 AND c_mktsegment = 'BUILDING'",
)
register(
    "q02_unique", lambda t: c.duplicates(t.table("lineitem"), ["l_orderkey", "l_linenumber"]),
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
register(
    "q03_accepted_values",
    lambda t: c.violations(t.table("orders"), c.accepted_values("o_orderstatus", ["O", "F"], only=F.col("o_orderpriority").isNotNull())).select("o_orderkey", "o_orderstatus"),
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('O', 'F')",
)
register(
    "q04_relationships", lambda t: c.orphans(t.table("lineitem"), "l_partkey", t.table("part").filter("p_size > 5"), "p_partkey").select("l_orderkey", "l_linenumber", "l_partkey"),
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)",
)


def ranged(name: str, low, high, where: str) -> None:
    register(
        name, lambda t: c.violations(t.table("lineitem"), c.accepted_range("l_quantity", low, high)).select("l_orderkey", "l_linenumber", "l_partkey"),
        f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE {where}",
    )


ranged("q05_accepted_range", 5, 45, "l_quantity < 5 OR l_quantity > 45")
ranged("q06_one_sided_range", None, 40, "l_quantity > 40")
register(
    "q07_sensor_limits",
    lambda t: c.summary(t["car_data"].withColumn("rpm", F.col("rpm") + 200).withColumn("speed", F.col("speed") * 2), c.telemetry_rules()).select("rule", "violations", "passed"),
    """SELECT 'accepted_range_' || rule AS rule, CAST(n AS BIGINT) AS violations, n = 0 AS passed FROM (SELECT count_if(brake > 100) AS brake, count_if(throttle > 110) AS throttle,
       count_if(rpm + 200 > 15000) AS rpm, count_if(speed * 2 > 410) AS speed FROM b_car) UNPIVOT (n FOR rule IN (brake, throttle, rpm, speed))""",
)
ranged("q08_range_check", 10, 20, "l_quantity < 10 OR l_quantity > 20")
register(
    "q09_range_count",
    lambda t: c.summary(t.table("lineitem"), [c.accepted_range("l_quantity", 10, 20)]).select("violations", "passed"),
    "SELECT count(*) AS violations, count(*) = 0 AS passed FROM lineitem WHERE l_quantity < 10 OR l_quantity > 20",
)
register(
    "q10_drs_states", lambda t: c.violations(t["car_data"], c.drs_state()).select("session_key", "driver_number", "date", "drs"),
    "SELECT session_key, driver_number, date, drs FROM b_car WHERE drs BETWEEN 4 AND 7",
)


def _pedals(t):
    # pedal values above range, on readings that the event table places milliseconds apart or not
    k = F.col("k")
    return t.events().select(
        "event_id", "driver_number", "session_key", F.col("ts").alias("date"), (k + 60).alias("brake"), (k + 70).alias("throttle"), (k * 3).alias("speed"), (k * 150).alias("rpm")
    )


_PEDAL_SQL = """SELECT event_id, date FROM (SELECT event_id, ts AS date, lag(ts) OVER w AS before, lead(ts) OVER w AS after FROM e_all
       WHERE k + 60 > 105 AND k + 70 > 105 AND 3 * k > 50 AND 150 * k > 5000 WINDOW w AS ({part} ORDER BY ts))
       WHERE date_diff('millisecond', before, date) < 500 OR date_diff('millisecond', date, after) < 500"""
register("q11_pedal_faults", lambda t: c.pedal_faults(_pedals(t), "date").select("event_id", "date"), _PEDAL_SQL.format(part=""))
register(
    "q11_pedal_faults_per_car", lambda t: c.pedal_faults(_pedals(t), "date", ["session_key", "driver_number"]).select("event_id", "date"),
    _PEDAL_SQL.format(part="PARTITION BY session_key, driver_number"),
)
register(
    "q12_non_negative",
    lambda t: c.violations(t.table("lineitem").withColumn("x", F.col("l_quantity") - 10), c.non_negative("x")).select("l_orderkey", "l_linenumber", "l_partkey", "x"),
    f"SELECT l_orderkey, l_linenumber, l_partkey, {r('l_quantity - 10', 'x')} FROM lineitem WHERE l_quantity < 10",
)
def now_col():
    return F.lit(datetime.datetime(2024, 1, 20)).cast("timestamp_ntz")


register(
    "q13_not_in_future", lambda t: c.violations(t.table("events"), c.not_in_future("ts", now_col(), 2)).select("event_id", "ts"),
    "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 02:00:00'",
)
register(
    "q14_session_dates",
    lambda t: c.violations(
        d.sessions(t).withColumn("session_end_at", F.when(F.col("session_key") == 2, F.timestamp_add("DAY", F.lit(-30), F.col("session_end_at"))).otherwise(F.col("session_end_at"))),
        c.ordered_dates("session_start_at", "session_end_at"),
    ).select("session_key", "session_end_at"),
    "SELECT session_key, session_end_at - INTERVAL 30 DAY AS session_end_at FROM d_sessions WHERE session_key = 2",
)
register(
    "q15_pit_durations",
    lambda t: c.violations(d.pit(t).withColumn("stop_duration_seconds", F.col("stop_duration_seconds") * 5), c.pit_durations()).select("pit_stop_id", "stop_duration_seconds"),
    f"SELECT pit_stop_id, {r('stop_duration_seconds * 5', 'stop_duration_seconds')} FROM d_pit WHERE stop_duration_seconds * 5 > 120",
)
register(
    "q16_sector_times",
    lambda t: c.violations(x.laps(t).withColumn("sector_2_seconds", F.col("sector_2_seconds") - 20), c.sector_times(["sector_1_seconds", "sector_2_seconds", "sector_3_seconds"])).select("lap_id"),
    "SELECT lap_id FROM x_laps WHERE sector_2_seconds - 20 < 0",
)


def _suite(t):
    rules = [
        c.not_null("session_key"), c.accepted_range("speed", 0, 200, severity="warn"), c.drs_state(), c.accepted_values("brake", [0, 100]),
    ]
    path = scratch_path(t.spark, "failures")
    c.store_failures(t["car_data"], rules, path)
    kept = t.spark.read.schema("session_key bigint, rule string").parquet(path).groupBy("rule").agg(F.count("*").alias("stored"))
    return c.summary(t["car_data"], rules).join(kept, "rule", "left").select("rule", "severity", "violations", "passed", F.coalesce("stored", F.lit(0)).alias("stored"))


register(
    "q17_severity_and_failures", _suite,
    """SELECT * FROM (SELECT 'accepted_range_speed' AS rule, 'warn' AS severity, count(*) AS violations, count(*) = 0 AS passed, count(*) AS stored FROM b_car WHERE speed > 200
       UNION ALL SELECT 'accepted_values_drs', 'error', count(*), count(*) = 0, count(*) FROM b_car WHERE drs BETWEEN 4 AND 7
       UNION ALL SELECT 'not_null_session_key', 'error', 0, true, 0 UNION ALL SELECT 'accepted_values_brake', 'error', 0, true, 0)""",
)
register(
    "q03_compounds_warn", lambda t: c.violations(t["stints"], c.accepted_values("compound", COMPOUNDS[:3], severity="warn")).select("session_key", "driver_number", "stint_number", "compound"),
    "SELECT session_key, driver_number, stint_number, compound FROM b_stints WHERE compound NOT IN ('SOFT', 'MEDIUM', 'HARD')",
)
