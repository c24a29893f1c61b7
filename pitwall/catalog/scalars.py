"""Queries for projections (P) and scalar functions (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall import functions as fx
from pitwall.catalog.oracle import _tok, _xsec, key, time
from pitwall.catalog.registry import query, register
from pitwall.settings import DEFAULTS


def r(expr: str, name: str) -> str:
    return f"round({expr} + 1e-9, 6) AS {name}"


# --- projections and filters -------------------------------------------------------------------------------

register(
    "p01_cast_rename",
    lambda t: t.table("lineitem").select(
        F.col("l_orderkey").cast("bigint").alias("session_key"), F.col("l_linenumber").cast("bigint").alias("lap_number"),
        F.col("l_quantity").cast("double").alias("lap_duration_seconds"), F.col("l_shipdate").cast("timestamp_ntz").alias("lap_start_at"),
    ),
    f"SELECT l_orderkey AS session_key, CAST(l_linenumber AS BIGINT) AS lap_number, {r('l_quantity', 'lap_duration_seconds')}, l_shipdate AS lap_start_at FROM lineitem",
)
register("p02_pass_through", lambda t: t.table("region").select("*"), "SELECT * FROM region")
register(
    "p03_key_not_null",
    lambda t: t.table("customer").withColumn("k", F.when(F.col("c_nationkey") > 3, F.col("c_custkey"))).dropna(subset=["k", "c_name"]).select("k", "c_name"),
    "SELECT c_custkey AS k, c_name FROM customer WHERE c_nationkey > 3 AND c_name IS NOT NULL",
)
register(
    "p04_range_filter",
    lambda t: t.table("lineitem").filter((F.col("l_quantity") > 10) & F.col("l_shipdate").isNotNull()).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"),
    f"SELECT l_orderkey, l_linenumber, l_partkey, {r('l_quantity', 'l_quantity')} FROM lineitem WHERE l_quantity > 10 AND l_shipdate IS NOT NULL",
)
register(
    "p05_in_list", lambda t: t.table("orders").filter(F.col("o_orderstatus").isin("O", "P")).select("o_orderkey", "o_orderstatus"),
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P')",
)


@query(
    "p06_nullable_flag",
    """SELECT l.session_key, l.driver_number, l.lap_number, l.is_pit_out_lap, coalesce(p.hit, false) AS is_pit_in_lap FROM b_laps l
       LEFT JOIN (SELECT DISTINCT session_key, driver_number, lap_number, true AS hit FROM b_pit) p USING (session_key, driver_number, lap_number)
       WHERE l.is_pit_out_lap OR coalesce(p.hit, false)""",
)
def _(t):
    keys = ["session_key", "driver_number", "lap_number"]
    hit = t["pit"].select(*keys).distinct().withColumn("hit", F.lit(True))
    flag = F.coalesce("hit", F.lit(False))
    out = t["laps"].join(hit, keys, "left").filter(F.col("is_pit_out_lap") | flag)
    return out.select(*keys, "is_pit_out_lap", flag.alias("is_pit_in_lap"))


register(
    "p07_filter_on_aggregate",
    lambda t: t.table("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("sample_laps")).filter(F.col("sample_laps") >= 600),
    "SELECT l_suppkey, count(*) AS sample_laps FROM lineitem GROUP BY 1 HAVING count(*) >= 600",
)
register(
    "p08_time_range",
    lambda t: t.table("events").filter(
        F.col("ts").between(F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz")) & (F.col("user_id") == 7)
    ).select("event_id", "ts", "value"),
    f"SELECT event_id, ts, {r('value', 'value')} FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12' AND user_id = 7",
)
register(
    "p09_distinct", lambda t: t.table("orders").select("o_orderstatus", "o_orderpriority").distinct(),
    "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
)
register(
    "p10_star_plus", lambda t: t.table("nation").select("*", F.upper("n_name").alias("label"), (F.col("n_nationkey") + 1).alias("next_key")),
    "SELECT *, upper(n_name) AS label, n_nationkey + 1 AS next_key FROM nation",
)
register(
    "p11_loaded_at",
    lambda t: t.table("nation").withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz")).select("n_nationkey", F.col("loaded_at").isNotNull().alias("stamped")),
    "SELECT n_nationkey, true AS stamped FROM nation",
)

# --- text --------------------------------------------------------------------------------------------------

def padded_col():
    return F.when(F.col("c_nationkey") < 3, F.lit("  ")).otherwise(F.concat(F.lit(" "), "c_name", F.lit(" ")))


register("f01_clean_text", lambda t: t.table("customer").select("c_custkey", fx.clean_text(padded_col()).alias("name")), "SELECT c_custkey, CASE WHEN c_nationkey >= 3 THEN c_name END AS name FROM customer")
register(
    "f02_clean_tokens", lambda t: t["intervals"].select("session_key", "driver_number", "date", fx.clean_token_text(F.col("gap_to_leader")).alias("gap")),
    f"SELECT session_key, driver_number, date, {_tok('gap_to_leader')} AS gap FROM b_intervals",
)
register(
    "f03_hex_colour",
    lambda t: t.table("part").select(
        "p_partkey", fx.hex_colour(F.col("p_brand")).alias("as_is"), fx.hex_colour_stripped(F.col("p_brand")).alias("stripped"),
        F.concat(F.lit("X"), F.left("p_type", F.lit(2))).alias("prefix"),
    ),
    "SELECT p_partkey, '#' || upper(p_brand) AS as_is, '#' || replace(upper(p_brand), '#', '') AS stripped, 'X' || left(p_type, 2) AS prefix FROM part",
)
def full_col():
    return F.when(F.col("c_nationkey") > 5, F.col("c_name"))


register(
    "f04_name_fallback", lambda t: t.table("customer").select("c_custkey", fx.full_name(full_col(), F.col("c_mktsegment"), F.when(F.col("c_nationkey") > 2, F.lit("x"))).alias("name")),
    "SELECT c_custkey, CASE WHEN c_nationkey > 5 THEN c_name WHEN c_nationkey > 2 THEN c_mktsegment || ' x' ELSE c_mktsegment END AS name FROM customer",
)
def odd_col():
    return F.when(F.col("n_nationkey") % 2 == 1, F.col("n_name"))


register(
    "f05_concat", lambda t: t.table("nation").select("n_nationkey", F.concat(odd_col(), F.lit(" ("), F.col("n_regionkey").cast("string"), F.lit(")")).alias("label")),
    "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 1 THEN n_name END || ' (' || n_regionkey || ')' AS label FROM nation",
)
register(
    "f06_concat_ws", lambda t: t.table("nation").select("n_nationkey", fx.strict_concat_ws(" - ", F.col("n_nationkey"), odd_col(), F.col("n_regionkey")).alias("label")),
    "SELECT n_nationkey, n_nationkey || ' - ' || CASE WHEN n_nationkey % 2 = 1 THEN n_name END || ' - ' || n_regionkey AS label FROM nation",
)
register(
    "f07_like", lambda t: t["intervals"].filter(F.col("gap_to_leader").like("%L%")).groupBy("gap_to_leader").count().withColumnRenamed("count", "n"),
    "SELECT gap_to_leader, count(*) AS n FROM b_intervals WHERE gap_to_leader LIKE '%L%' GROUP BY 1",
)
register(
    "f08_lapped", lambda t: t["intervals"].select("session_key", "driver_number", "date", "gap_to_leader", fx.is_lapped_gap(F.col("gap_to_leader")).alias("lapped")),
    "SELECT session_key, driver_number, date, gap_to_leader, regexp_full_match(upper(trim(gap_to_leader)), '\\+[0-9]+\\s*LAP') AS lapped FROM b_intervals",
)
register(
    "f09_gap_seconds", lambda t: t["intervals"].select("session_key", "driver_number", "date", fx.gap_seconds(F.col("gap_to_leader")).alias("gap")),
    f"SELECT session_key, driver_number, date, {r('TRY_CAST(gap_to_leader AS DOUBLE)', 'gap')} FROM b_intervals",
)
register(
    "f10_interval_seconds", lambda t: t["intervals"].select("session_key", "driver_number", "date", fx.interval_seconds(F.col("gap_to_leader")).alias("gap")),
    f"SELECT session_key, driver_number, date, {r(_xsec('gap_to_leader'), 'gap')} FROM b_intervals",
)
register(
    "f11_split_part", lambda t: t.table("pages").select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host")),
    "SELECT page_id, split_part(url, '/', 3) AS host FROM pages",
)
register(
    "f12_surrogate_key",
    lambda t: t.table("lineitem").select(
        "l_orderkey", "l_linenumber", fx.surrogate_key(F.col("l_orderkey"), F.when(F.col("l_quantity") > 25, F.col("l_linenumber")), fx.time_text(F.col("l_shipdate"))).alias("id")
    ),
    f"SELECT l_orderkey, l_linenumber, {key('l_orderkey', 'CASE WHEN l_quantity > 25 THEN l_linenumber END', time('l_shipdate'))} AS id FROM lineitem",
)

# --- times -------------------------------------------------------------------------------------------------


def events(name: str, sql: str, cols):
    """A projection of all events next to their id."""
    register(name, lambda t: t.events().select("event_id", *[c.alias(n) for n, c in cols().items()]), f"SELECT event_id, {sql} FROM e_all")


def ts_col():
    return F.col("ts")


events(
    "f13_trunc_second", "date_trunc('second', ts) AS at",
    lambda: dict(at=fx.trunc_to("second", ts_col())),
)
events(
    "f14_trunc_minute_date", "date_trunc('minute', ts) AS at, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date",
    lambda: dict(at=fx.trunc_to("minute", ts_col()), event_date=F.to_date(ts_col())),
)
events(
    "f15_time_slice", "time_bucket(INTERVAL 5 MINUTE, ts) AS at",
    lambda: dict(at=fx.slice_start(ts_col(), 5)),
)
events(
    "f16_add_seconds", "ts + to_seconds(CAST(round(value) AS BIGINT)) AS by_second, ts + to_milliseconds(CAST(round(value * 1000) AS BIGINT)) AS by_milli",
    lambda: dict(by_second=fx.add_seconds(ts_col(), F.col("value")), by_milli=fx.add_millis(ts_col(), F.col("value") * 1000)),
)
events(
    "f17_default_end", "coalesce(CASE WHEN k % 2 = 0 THEN ts + INTERVAL 1 MINUTE END, ts + INTERVAL 5 MINUTE) AS ends",
    lambda: dict(ends=F.coalesce(F.when(F.col("k") % 2 == 0, ts_col() + F.expr("INTERVAL 1 MINUTE")), ts_col() + F.expr("INTERVAL 5 MINUTE"))),
)
def new_year_col():
    return F.lit("2024-01-15 12:00:00.5").cast("timestamp_ntz")


events(
    "f18_time_difference", "abs(date_diff('second', ts, TIMESTAMP '2024-01-15 12:00:00.5')) AS seconds, date_diff('millisecond', ts, TIMESTAMP '2024-01-15 12:00:00.5') AS millis",
    lambda: dict(seconds=F.abs(fx.seconds_between(ts_col(), new_year_col())), millis=fx.millis_between(ts_col(), new_year_col())),
)
def iso_col():
    return F.when(F.col("k") % 10 == 0, F.lit("no time")).otherwise(F.concat(F.date_format(ts_col(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")))


events(
    "f19_parse_utc", "CASE WHEN k % 10 <> 0 THEN ts - INTERVAL 2 HOUR END AS at",
    lambda: dict(at=fx.utc(iso_col())),
)
events(
    "f20_parse_or_epoch", "CASE WHEN k % 10 <> 0 THEN date_trunc('millisecond', ts - INTERVAL 2 HOUR) ELSE TIMESTAMP '1970-01-01' END AS at",
    lambda: dict(at=fx.utc_or_epoch(iso_col())),
)

# --- numbers and flags -------------------------------------------------------------------------------------


def lines(name: str, sql: str, cols):
    register(name, lambda t: t.table("lineitem").select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in cols().items()]), f"SELECT l_orderkey, l_linenumber, {sql} FROM lineitem")


lines(
    "f21_pct_delta", r("(l_quantity - l_tax) / nullif(l_tax, 0)", "pct"),
    lambda: dict(pct=fx.pct_delta(F.col("l_quantity"), F.col("l_tax"))),
)
lines(
    "f22_round", "round(l_extendedprice) AS whole, round(l_quantity / 4) AS quarter",
    lambda: dict(whole=F.round(F.col("l_extendedprice")), quarter=F.round(F.col("l_quantity") / 4)),
)
lines(
    "f23_greatest", f"{r('greatest(CASE WHEN l_quantity > 30 THEN l_quantity END, l_tax * 100)', 'skip_null')}, {r('greatest(coalesce(CASE WHEN l_quantity > 30 THEN l_quantity END, 0), 5)', 'or_zero')}",
    lambda: dict(skip_null=F.greatest(F.when(F.col("l_quantity") > 30, F.col("l_quantity")), F.col("l_tax") * 100), or_zero=F.greatest(fx.or_zero(F.when(F.col("l_quantity") > 30, F.col("l_quantity"))), F.lit(5.0))),
)
def temp_col():
    return F.when(F.col("l_quantity") != 13, F.col("l_quantity"))


lines(
    "f24_bands", """CASE WHEN l_quantity = 13 THEN 'UNKNOWN' WHEN l_quantity < 25 THEN 'TRACK_COLD' WHEN l_quantity < 35 THEN 'TRACK_MODERATE' WHEN l_quantity < 45 THEN 'TRACK_HOT' ELSE 'TRACK_VERY_HOT' END AS track,
       CASE WHEN l_quantity = 13 THEN 'UNKNOWN' WHEN l_quantity * 2 < 40 THEN 'HUMIDITY_LOW' WHEN l_quantity * 2 < 70 THEN 'HUMIDITY_MEDIUM' ELSE 'HUMIDITY_HIGH' END AS humidity,
       CASE WHEN l_tax = 0 THEN 'RAIN' WHEN l_quantity = 13 THEN 'DRY' WHEN l_quantity * 2 >= 80 THEN 'HUMID' WHEN l_quantity * 2 >= 60 THEN 'MODERATE_HUMIDITY' ELSE 'DRY' END AS sky""",
    lambda: dict(track=fx.track_band(temp_col()), humidity=fx.humidity_band(temp_col() * 2), sky=fx.sky_band(F.col("l_tax") == 0, temp_col() * 2)),
)
register(
    "f25_points", lambda t: t.table("customer").select("c_custkey", fx.points_for(F.col("c_nationkey")).alias("points")),
    "SELECT c_custkey, coalesce(([25, 18, 15, 12, 10, 8, 6, 4, 2, 1])[nullif(c_nationkey, 0)], 0) AS points FROM customer",
)
lines(
    "f26_valid_ranges", "coalesce(CASE WHEN l_quantity <> 13 THEN l_quantity END BETWEEN 40 AND 300, false) AS lap_ok, l_quantity BETWEEN 5 AND 120 AS sector_ok",
    lambda: dict(lap_ok=fx.within(temp_col(), DEFAULTS.lap_seconds), sector_ok=fx.within(F.col("l_quantity"), DEFAULTS.sector_seconds)),
)
def stint_col():
    return F.when(F.col("stint_number") != 2, F.col("lap_end"))


register(
    "f27_stint_length",
    lambda t: t["stints"].select(
        "session_key", "driver_number", "stint_number", fx.stint_length(F.col("lap_start"), F.col("lap_end")).alias("plain"),
        fx.guarded_stint_length(F.col("lap_start"), stint_col()).alias("guarded"), fx.guarded_stint_length(F.col("lap_end"), F.col("lap_start")).alias("reversed"),
    ),
    """SELECT session_key, driver_number, stint_number, lap_end - lap_start + 1 AS plain, CASE WHEN stint_number <> 2 THEN lap_end - lap_start + 1 END AS guarded,
              CASE WHEN lap_start = lap_end THEN 1 END AS reversed FROM b_stints""",
)
register(
    "f28_tyre_age",
    lambda t: t["stints"].select("session_key", "driver_number", "stint_number", fx.tyre_age(F.col("lap_end"), F.col("lap_start"), F.col("tyre_age_at_start")).alias("age")),
    "SELECT session_key, driver_number, stint_number, coalesce(tyre_age_at_start, 1) + lap_end - lap_start AS age FROM b_stints",
)
register(
    "f29_telemetry_flags",
    lambda t: t["car_data"].select(
        "session_key", "driver_number", "date", fx.bool_int(F.col("brake") > 0).alias("braking"), fx.bool_int(F.col("throttle") >= DEFAULTS.full_throttle_from).alias("flat_out"),
        fx.drs_active(F.col("drs")).alias("drs_on"), fx.drs_detected(F.col("drs")).alias("drs_seen"),
    ),
    """SELECT session_key, driver_number, date, (brake > 0)::INT AS braking, (throttle >= 95)::INT AS flat_out, (drs IN (10, 12, 14))::INT AS drs_on,
              (drs IN (8, 10, 12, 14))::INT AS drs_seen FROM b_car""",
)
register(
    "f30_category", lambda t: t.table("part").select("p_partkey", fx.category(F.when(F.col("p_size") > 10, F.lower("p_type"))).alias("kind")),
    "SELECT p_partkey, CASE WHEN p_size > 10 THEN upper(p_type) ELSE 'UNKNOWN' END AS kind FROM part",
)
def loose_col():
    return F.when(F.col("k") % 3 == 0, F.lit("")).when(F.col("k") % 3 == 1, F.col("k").cast("string"))


events(
    "f31_int_or_default", "CASE WHEN k % 3 = 1 THEN k ELSE 0 END AS n",
    lambda: dict(n=fx.int_or_default(loose_col())),
)
register(
    "f32_coalesce",
    lambda t: t["sessions"].select("session_key", F.coalesce(F.when(F.col("session_key") > 1, F.col("country_name")), F.col("session_type")).alias("label")),
    "SELECT session_key, CASE WHEN session_key > 1 THEN country_name ELSE session_type END AS label FROM b_sessions",
)
events(
    "f33_json_path", "CAST(json_extract(props, '$.k') AS INTEGER) AS by_path, CAST(json_extract(props, '$.k') AS BIGINT) AS by_schema",
    lambda: dict(by_path=F.get_json_object("props", "$.k").cast("int"), by_schema=F.from_json("props", "k bigint")["k"]),
)
events(
    "f34_json_row", """'{"event_id":' || event_id || ',"event_type":"' || event_type || '","k":' || k || '}' AS body""",
    lambda: dict(body=F.to_json(F.struct("event_id", "event_type", "k"))),
)
register(
    "f35_arrays",
    lambda t: t.table("embeddings").select("vec_id", F.array_size("embedding").alias("n"), F.element_at("embedding", 1).alias("head"), F.element_at("embedding", -1).alias("tail")),
    f"SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, {r('CAST(embedding[1] AS DOUBLE)', 'head')}, {r('CAST(embedding[-1] AS DOUBLE)', 'tail')} FROM embeddings",
)
events(
    "f36_stable_record_id", f"{key('session_key', 'driver_number', time('ts'), 'event_type')} AS id",
    lambda: dict(id=fx.surrogate_key(F.col("session_key"), F.col("driver_number"), fx.time_text(ts_col()), F.col("event_type"))),
)
events(
    "f37_stream_key", "event_type || ':' || driver_number AS stream_key",
    lambda: dict(stream_key=fx.stream_key(F.col("event_type"), F.col("driver_number"))),
)
register(
    "f38_null_or_non_negative",
    lambda t: t.table("lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") != 13, F.col("l_quantity") - 20).alias("x")).filter(fx.null_or_non_negative(F.col("x"))),
    f"SELECT l_orderkey, l_linenumber, {r('CASE WHEN l_quantity <> 13 THEN l_quantity - 20 END', 'x')} FROM lineitem WHERE l_quantity = 13 OR l_quantity >= 20",
)
