"""Queries for scans, sinks and table maintenance (S): each writes to a scratch folder and reads back."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from pitwall.catalog.columns import COLUMNS
from pitwall.catalog.registry import block, query, register
from pitwall.catalog.scalars import r
from pitwall.plans import dashboard as x
from pitwall.plans.production import CAR
from pitwall.schemas import SCHEMAS
from pitwall.sources import landing, merge, tables
from pitwall.sources.scratch import scratch_path
from pitwall.sources.versions import VersionedTable


@query("s01_scan_landing", "SELECT meeting_key, session_key, driver_number, date, position FROM b_position WHERE session_key IN (1, 3)")
def _(t):
    root = scratch_path(t.spark, "landing")
    landing.write_landing(t["position"], root, "position")
    return landing.read_landing(t.spark, root, "position", [1, 3])


@query(
    "s02_scan_json",
    """SELECT meeting_key, session_key, driver_number, date, CASE WHEN gap_to_leader NOT IN ('None', 'null', 'NULL', '') THEN gap_to_leader END AS gap_to_leader,
       CASE WHEN "interval" NOT IN ('None', 'null', 'NULL', '') THEN "interval" END AS "interval" FROM b_intervals""",
)
def _(t):
    path = scratch_path(t.spark, "json")
    t["intervals"].withColumn("date", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).write.json(path)
    return landing.read_json_landing(t.spark, path, "intervals", array_files=False)


def _mixed(t) -> str:
    """Interval records whose gap is a number where it reads as one, and a text elsewhere, as JSON lines."""
    path, number = scratch_path(t.spark, "mixed"), F.col("gap_to_leader").try_cast("double")
    rows = t["intervals"].withColumn("date", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))

    def line(gap):
        return F.to_json(F.struct("meeting_key", "session_key", "driver_number", "date", "interval", gap.alias("gap_to_leader")))

    rows.select(F.when(number.isNotNull(), line(number)).otherwise(line(F.col("gap_to_leader"))).alias("value")).write.text(path)
    return path


@query(
    "s02_scan_variant",
    f"""SELECT session_key, driver_number, date, {r('TRY_CAST(gap_to_leader AS DOUBLE)', 'gap_seconds')}, CASE WHEN gap_to_leader NOT IN ('None', 'null', 'NULL', '') AND TRY_CAST(gap_to_leader AS DOUBLE) IS NULL THEN gap_to_leader END AS gap_text,
       CASE WHEN "interval" NOT IN ('None', 'null', 'NULL', '') THEN "interval" END AS "interval" FROM b_intervals""",
)
def _(t):
    """Gaps that are numbers in some records and texts in others, read as what they are."""
    records = landing.read_variant_landing(t.spark, _mixed(t), array_files=False)
    seconds = landing.field(F.col("record"), "gap_to_leader", "double").alias("gap_seconds")
    typed = landing.typed_records(records.select("record", seconds), SCHEMAS["intervals"], keep=["gap_seconds"])
    return typed.select("session_key", "driver_number", "date", "gap_seconds", F.when(F.col("gap_seconds").isNull(), F.col("gap_to_leader")).alias("gap_text"), "interval")


@query(
    "s11_infer_variant",
    """SELECT 'gap_to_leader' AS field, CASE WHEN count(DISTINCT TRY_CAST(gap_to_leader AS DOUBLE) IS NULL) = 2 THEN 'VARIANT' ELSE 'one kind' END AS kind FROM b_intervals WHERE gap_to_leader IS NOT NULL
       UNION ALL SELECT 'interval', CASE WHEN count("interval") > 0 THEN 'STRING' END FROM b_intervals UNION ALL SELECT 'driver_number', CASE WHEN count(driver_number) > 0 THEN 'BIGINT' END FROM b_intervals
       UNION ALL SELECT 'session_key', CASE WHEN count(session_key) > 0 THEN 'BIGINT' END FROM b_intervals""",
)
def _(t):
    """Types over all records: a field that is a number here and a text there is a VARIANT."""
    kinds = landing.variant_types(landing.read_variant_landing(t.spark, _mixed(t), array_files=False))
    return t.spark.createDataFrame([(f, kinds[f]) for f in ("gap_to_leader", "interval", "driver_number", "session_key")], "field string, kind string")


@query(
    "s03_conform",
    """SELECT session_key, meeting_key, driver_number, ts AS date, CAST(NULL AS INTEGER) AS rpm, CASE WHEN k % 2 = 0 THEN k END AS speed, k AS throttle, CAST(NULL AS INTEGER) AS brake,
       CAST(NULL AS INTEGER) AS n_gear, CAST(NULL AS INTEGER) AS drs FROM e_all""",
)
def _(t):
    loose = t.events().select(
        "session_key", F.col("meeting_key").cast("string"), "driver_number", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("date"),
        F.when(F.col("k") % 2 == 0, F.col("k").cast("string")).otherwise(F.lit("fast")).alias("speed"), F.get_json_object("props", "$.k").alias("throttle"), "event_id",
    )
    return landing.conform(loose, SCHEMAS["car_data"])


@query("s04_replace_sessions", "SELECT driver_number, date, meeting_key, CASE WHEN session_key = 2 THEN position + 100 ELSE position END AS position, session_key FROM b_position")
def _(t):
    path = scratch_path(t.spark, "replace")
    landing.replace_sessions(t["position"], path, "position")
    again = t["position"].filter(F.col("session_key") == 2).withColumn("position", F.col("position") + 100)
    for _ in range(2):
        landing.replace_sessions(again, path, "position")
    return t.spark.read.schema(t["position"].schema).parquet(path)


@query("s04_replace_versioned", "SELECT driver_number, date, meeting_key, CASE WHEN session_key = 2 THEN position + 100 ELSE position END AS position, session_key FROM b_position WHERE session_key <> 3")
def _(t):
    """The same as versions: each load, and the removal of a session, is whole or not there; a reader of an earlier version keeps its rows."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "versions"), "session_key")
    table.replace(t["position"])
    again = t["position"].filter(F.col("session_key") == 2).withColumn("position", F.col("position") + 100)
    for _ in range(2):
        table.replace(again)
    table.delete([3])
    return table.read()


@query("s05_selected_sessions", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(t):
    wanted = t.table("customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return landing.select_sessions(t.table("orders"), wanted.unionByName(wanted), ["o_custkey"]).select("o_orderkey", "o_custkey")


@query(
    "s06_discover_sessions",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def _(t):
    o = t.table("orders").select("o_custkey", "o_orderkey", "o_orderdate", F.col("o_orderdate").alias("begin"))
    return landing.discover_sessions(o, "o_custkey", "begin", "o_orderdate", datetime.datetime(1996, 1, 1), datetime.datetime(1997, 1, 1)).drop("begin")


@query("s07_absent_only", "SELECT event_id, session_key FROM e_all WHERE session_key NOT IN (SELECT session_key FROM b_sessions WHERE session_type = 'Race')")
def _(t):
    held = t["sessions"].filter("session_type = 'Race'")
    return landing.absent_only(t.events().select("event_id", "session_key"), held, ["session_key"])


@query(
    "s08_upsert",
    f"""SELECT o_orderkey, o_orderpriority, {r('CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END', 'o_totalprice')} FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""",
)
def _(t):
    path = scratch_path(t.spark, "upsert")
    o = t.table("orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    merge.upsert(t.spark, path, o.filter("o_orderkey % 3 <> 0"), ["o_orderkey"], "o_orderpriority")
    batch = o.filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for _ in range(2):
        merge.upsert(t.spark, path, batch, ["o_orderkey"], "o_orderpriority")
    return t.spark.read.parquet(path)


@query(
    "s08_upsert_versioned",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 14 = 0 THEN 'moved' ELSE o_orderpriority END AS part, {r('CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END', 'o_totalprice')}
        FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""",
)
def _(t):
    """A load, then a batch that changes, adds and moves rows, twice; the table is read at its last version."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "versions"), "part")
    o = t.table("orders").select("o_orderkey", F.col("o_orderpriority").alias("part"), "o_totalprice")
    table.upsert(o.filter("o_orderkey % 3 <> 0"), ["o_orderkey"])
    batch = o.filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("part", F.when(F.col("o_orderkey") % 14 == 0, "moved").otherwise(F.col("part")))
    for _ in range(2):
        table.upsert(batch, ["o_orderkey"])
    return table.read()


@query(
    "s08_merge_null_partition",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS part, CASE WHEN o_orderkey % 4 = 0 THEN 'new' ELSE 'old' END AS state FROM orders""",
)
def _(t):
    """Rows without a partition value lie in a partition of their own, and a batch that touches it leaves the others' rows there."""
    path = scratch_path(t.spark, "null-partition")
    o = t.table("orders").select("o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("part"), F.lit("old").alias("state"))
    merge.upsert(t.spark, path, o, ["o_orderkey"], "part")
    merge.upsert(t.spark, path, o.filter("o_orderkey % 4 = 0").withColumn("state", F.lit("new")), ["o_orderkey"], "part")
    return t.spark.read.parquet(path).select("o_orderkey", "part", "state")


@query(
    "s08_merge_moved_row",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND (o_orderpriority = '1-URGENT' OR o_orderkey % 3 = 0) THEN 'moved' ELSE o_orderpriority END AS part,
       o_orderstatus FROM orders""",
)
def _(t):
    """A batch moves rows to another partition, twice: each is there once; a partition that is left empty goes."""
    path, o = scratch_path(t.spark, "moved"), t.table("orders").select("o_orderkey", F.col("o_orderpriority").alias("part"), "o_orderstatus")
    merge.upsert(t.spark, path, o, ["o_orderkey"], "part")
    batch = o.filter("part = '1-URGENT' OR (part = '2-HIGH' AND o_orderkey % 3 = 0)").withColumn("part", F.lit("moved"))
    for _ in range(2):
        merge.upsert(t.spark, path, batch, ["o_orderkey"], "part")
    return t.spark.read.parquet(path).select("o_orderkey", "part", "o_orderstatus")


def _by_entity(feed: str, view: str, key: str, value: str, columns: str) -> None:
    """A feed is loaded, then every second row comes again with another value; rows are met by the feed's own merge key."""
    changed = f"CASE WHEN {key} % 2 = 0 THEN {value} + 1 ELSE {value} END"

    def build(t):
        path = scratch_path(t.spark, f"merge-{feed}")
        rows = t[feed].select(*columns.split(", "), value).distinct()
        merge.merge_feed(t.spark, path, rows, feed)
        merge.merge_feed(t.spark, path, rows.filter(f"{key} % 2 = 0").withColumn(value, (F.col(value) + 1).cast(rows.schema[value].dataType)), feed)
        return t.spark.read.schema(rows.schema).parquet(path).select(*columns.split(", "), value)

    register(f"s08_merge_by_entity_{feed}", build, f"SELECT {columns}, {r(changed, value) if value.endswith('duration') else changed + ' AS ' + value} FROM (SELECT DISTINCT {columns}, {value} FROM {view})")


_by_entity("laps", "b_laps", "lap_number", "lap_duration", "session_key, driver_number, lap_number, date_start")
_by_entity("car_data", "b_car", "driver_number", "speed", "meeting_key, session_key, driver_number, date")
_by_entity("position", "b_position", "driver_number", "position", "meeting_key, session_key, driver_number, date")


register(
    "s09_session_calendar",
    lambda t: landing.sessions_on(landing.session_calendar(t.table("orders"), "o_orderdate", ["o_custkey", "o_orderkey"]), datetime.date(1996, 3, 1)),
    "SELECT '1996-03-01' AS day, o_custkey, o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1996-03-01'",
)


@query("s10_incremental", "SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM x_position")
def _(t):
    """A first load that stops in the middle, then an incremental one: the same rows as a full build."""
    path, known = scratch_path(t.spark, "incremental"), F.lit("2024-01-20").cast("timestamp_ntz")
    merge.incremental_load(t.spark, path, lambda _: x.position(t).filter(F.col("timestamp_utc") < known), ["position_id"], "timestamp_utc", "event_date")
    merge.incremental_load(t.spark, path, lambda after: x.position(t, after), ["position_id"], "timestamp_utc", "event_date")
    return t.spark.read.parquet(path)


@query("s10_incremental_rollup", block("x_telemetry_minutes", *COLUMNS["x_telemetry_minutes"][:2]))
def _(t):
    """The same for a rollup: the bound is a stored minute, so no minute is ever rebuilt from part of its rows."""
    path, known = scratch_path(t.spark, "rollup"), F.lit("2024-01-20").cast("timestamp_ntz")
    for build in (lambda _: x.telemetry_minutes(t).filter(F.col("sample_minute") < known), lambda after: x.telemetry_minutes(t, after)):
        merge.incremental_load(t.spark, path, build, ["telemetry_minute_id"], "sample_minute", "event_date")
    return t.spark.read.parquet(path)


@query(
    "s12_sync_columns",
    "SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus FROM orders",
)
def _(t):
    """A batch with one more column: older rows keep NULL in it."""
    path, o = scratch_path(t.spark, "sync"), t.table("orders")
    merge.upsert(t.spark, path, o.select("o_orderkey", "o_orderpriority"), ["o_orderkey"], "o_orderpriority")
    batch = o.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    merge.upsert(t.spark, path, batch, ["o_orderkey"], "o_orderpriority", sync_columns=True)
    return merge.read_synced(t.spark, path)


@query(
    "s11_infer_by_name",
    f"SELECT event_type AS kind, ts AS created_at, {r('k', 'k')}, {r('value', 'value')}, k % 2 = 0 AS even FROM e_all",
)
def _(t):
    path = scratch_path(t.spark, "infer")
    t.events().select(
        F.col("event_type").alias("kind"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"), "k", "value", (F.col("k") % 2 == 0).alias("even")
    ).write.json(path)
    return landing.typed_by_name(t.spark.read.option("timestampFormat", "").option("inferTimestamp", False).json(path))


@query(
    "s12_audit_columns",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment, '2024-02-01' AS processed_date, TIMESTAMP '2024-02-01 06:00:00' AS created_at,
       TIMESTAMP '2024-02-01 06:00:00' AS updated_at FROM customer""",
)
def _(t):
    c = t.table("customer")
    old, new = c.filter("c_custkey % 2 = 1").select("c_custkey"), c.filter("c_custkey % 2 = 0").select("c_custkey", "c_mktsegment")
    return landing.with_audit(landing.sync_schema(old, new), datetime.datetime(2024, 2, 1, 6))


@query("s13_split_valid", "SELECT event_id, k % 4 <> 0 AND value > 5 AS valid FROM e_all")
def _(t):
    e = t.events().select("event_id", F.when(F.col("k") % 4 != 0, F.col("k")).alias("a"), F.when(F.col("value") > 5, F.col("value")).alias("b"))
    good, bad = landing.split_valid(e, ["a", "b"])
    return good.select("event_id", F.lit(True).alias("valid")).unionByName(bad.select("event_id", F.lit(False).alias("valid")))


register(
    "s14_standard_names",
    lambda t: landing.standard_names(t["intervals"].withColumn("gap_to_leader", F.nullif(F.col("gap_to_leader"), F.lit(""))), ["gap_to_leader", "interval"]),
    """SELECT meeting_key AS MEETING_KEY, session_key AS SESSION_KEY, driver_number AS DRIVER_NUMBER, date AS DATE, coalesce(nullif(gap_to_leader, ''), 'None') AS GAP_TO_LEADER, "interval" AS "INTERVAL"
       FROM b_intervals""",
)


@query(
    "s15_seed_lookup",
    """SELECT session_key, driver_number, date, drs, CASE WHEN drs IN (0, 1, 2) THEN 'OFF' WHEN drs = 8 THEN 'DETECTED' WHEN drs IN (10, 12, 14) THEN 'ON' WHEN drs IN (3, 9, 11, 13, 15) THEN 'UNKNOWN' END AS drs_label FROM b_car""",
)
def _(t):
    path = scratch_path(t.spark, "seed")
    tables.write_seed(t.spark, path)
    return tables.with_drs_label(t["car_data"].select("session_key", "driver_number", "date", "drs"), tables.read_seed(t.spark, path))


@query(
    "s16_materialise",
    f"SELECT session_key, driver_number, {r('min(lap_duration)', 'best')}, count(*) AS n FROM b_laps GROUP BY ALL",
)
def _(t):
    laps = tables.materialise(t.spark, t["laps"].select("session_key", "driver_number", "lap_duration"), "stg_laps", "view")
    best = laps.groupBy("session_key", "driver_number").agg(F.min("lap_duration").alias("best"), F.count("*").alias("n"))
    return tables.materialise(t.spark, best, "best_laps", "table", scratch_path(t.spark, "table"))


@query(
    "s17_bucketed_join",
    f"""SELECT c.session_key, c.driver_number, c.date, c.speed, {r('b.best', 'best')}, b.laps FROM b_car c
        JOIN (SELECT session_key, driver_number, min(lap_duration) AS best, count(*) AS laps FROM b_laps GROUP BY ALL) b ON b.session_key = c.session_key AND b.driver_number = c.driver_number""",
)
def _(t):
    """Laps and telemetry in equal buckets by car: the aggregate and the join with it need no exchange."""
    stem = scratch_path(t.spark, "bucketed")
    name = f"pitwall_{stem[-12:]}"
    cars = tables.write_bucketed(t["car_data"].select(*CAR, "date", "speed"), f"{name}_cars", f"{stem}/cars", CAR, 8)
    laps = tables.write_bucketed(t["laps"].select(*CAR, "lap_duration"), f"{name}_laps", f"{stem}/laps", CAR, 8)
    best = laps.groupBy(*CAR).agg(F.min("lap_duration").alias("best"), F.count("*").alias("laps"))
    return cars.hint("merge").join(best, CAR)


@query("s17_clustered_write", "SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM x_car_data")
def _(t):
    path = scratch_path(t.spark, "clustered")
    landing.write_clustered(x.car_data(t), path, ["event_date", "session_key", "driver_number", "timestamp_utc"])
    return t.spark.read.parquet(path)
