"""Queries for aggregates (A), unions and reshaping (U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall import functions as fx
from pitwall.catalog.oracle import corr
from pitwall.catalog.registry import query, register
from pitwall.catalog.scalars import r
from pitwall.operators.reshape import append_all, sectors_long
from pitwall.operators.stats import distinct_counts, exact_quantiles, min_by_first, ordered_entries, ordered_list_text, safe_corr, with_median
from pitwall.plans import production as p
from pitwall.settings import Settings


def grouped(name: str, keys: str, sql: str, aggs, table: str = "lineitem"):
    """Aggregates of one table by the given keys."""
    names = keys.split()
    register(name, lambda t: t.table(table).groupBy(*names).agg(*[a.alias(n) for n, a in aggs().items()]), f"SELECT {', '.join(names)}, {sql} FROM {table} GROUP BY ALL")


def some_col():
    return F.when(F.col("l_quantity") > 20, F.col("l_quantity"))


grouped(
    "a01_counts", "l_suppkey", "count(*) AS n, count(CASE WHEN l_quantity > 20 THEN 1 END) AS some",
    lambda: dict(n=F.count("*"), some=F.count(some_col())),
)
grouped(
    "a02_basic", "l_suppkey l_returnflag", f"{r('min(l_quantity)', 'lo')}, {r('max(l_quantity)', 'hi')}, {r('avg(l_quantity)', 'mean')}, {r('sum(l_extendedprice)', 'total')}",
    lambda: dict(lo=F.min(F.col("l_quantity")), hi=F.max(F.col("l_quantity")), mean=F.avg(F.col("l_quantity")), total=F.sum(F.col("l_extendedprice"))),
)
grouped(
    "a03_count_distinct", "l_returnflag", "count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts, count(*) AS n",
    lambda: dict(suppliers=F.count_distinct("l_suppkey"), parts=F.count_distinct("l_partkey"), n=F.count("*")),
)
register(
    "a03_distinct_bitmaps",
    lambda t: distinct_counts(t.table("lineitem"), ["l_returnflag", "l_linestatus"], {"suppliers": "l_suppkey", "parts": "l_partkey", "orders": "l_orderkey"}),
    """SELECT l_returnflag, l_linestatus, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders
       FROM lineitem GROUP BY ALL""",
)


def open_col():
    return F.col("l_linestatus") == "O"


grouped(
    "a04_conditional", "l_suppkey", f"{r('avg(l_quantity) FILTER (l_linestatus = $$O$$)', 'mean')}, {r('min(l_quantity) FILTER (l_linestatus = $$O$$)', 'lo')}, {r('max(l_quantity) FILTER (l_linestatus = $$O$$)', 'hi')}, count(*) FILTER (l_linestatus = 'O') AS n",
    lambda: dict(mean=F.avg(F.when(open_col(), F.col("l_quantity"))), lo=F.min(F.when(open_col(), F.col("l_quantity"))), hi=F.max(F.when(open_col(), F.col("l_quantity"))), n=F.count(F.when(open_col(), 1))),
)
grouped(
    "a05_count_if", "o_orderpriority", "CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS n",
    lambda: dict(n=F.count_if(F.col("o_orderstatus") == "F")), "orders",
)


@query(
    "a06_flag_share",
    f"""SELECT session_key, driver_number, CAST(count_if(brake > 0) AS BIGINT) AS braking, {r('count_if(brake > 0) / nullif(count_if(throttle >= 50), 0)', 'share')} FROM b_car GROUP BY ALL""",
)
def _(t):
    braking, open_throttle = F.sum(fx.bool_int(F.col("brake") > 0)), F.sum(fx.bool_int(F.col("throttle") >= 50))
    return t["car_data"].groupBy(*p.CAR).agg(braking.alias("braking"), F.try_divide(braking, open_throttle).alias("share"))


@query("a07_median", f"SELECT l_suppkey, l_returnflag, {r('median(l_extendedprice)', 'middle')} FROM lineitem GROUP BY ALL")
def _(t):
    li, keys = t.table("lineitem"), ["l_suppkey", "l_returnflag"]
    return with_median(li.select(*keys).distinct(), li, keys, "l_extendedprice", "middle")


@query(
    "a07_quantiles",
    f"""SELECT l_returnflag, {r('quantile_cont(l_extendedprice, 0.1)', 'low')}, {r('quantile_cont(l_extendedprice, 0.5)', 'middle')}, {r('quantile_cont(l_extendedprice, 0.99)', 'high')}
        FROM lineitem GROUP BY ALL""",
)
def _(t):
    """Three quantiles of few large groups, found together by histogram rounds."""
    return exact_quantiles(t.table("lineitem"), ["l_returnflag"], "l_extendedprice", {"low": 0.1, "middle": 0.5, "high": 0.99})


@query(
    "a08_correlation",
    f"SELECT l_partkey, l_returnflag, {r(corr('l_quantity', 'l_extendedprice'), 'c')}, {r(corr('l_quantity', 'CASE WHEN l_tax > 0.02 THEN l_discount END'), 'partial')} FROM lineitem GROUP BY ALL",
)
def _(t):
    return t.table("lineitem").groupBy("l_partkey", "l_returnflag").agg(safe_corr(F.col("l_quantity"), F.col("l_extendedprice")).alias("c"), safe_corr(F.col("l_quantity"), F.when(F.col("l_tax") > 0.02, F.col("l_discount"))).alias("partial"))


grouped(
    "a09_min_by", "l_suppkey", "first(l_partkey ORDER BY l_quantity, l_partkey) AS part",
    lambda: dict(part=min_by_first(F.col("l_partkey"), F.col("l_quantity"))),
)
register(
    "a10_list_ordered", lambda t: ordered_list_text(t["pit"], p.CAR, "lap_number", "laps"),
    "SELECT session_key, driver_number, string_agg(CAST(lap_number AS VARCHAR), ', ' ORDER BY lap_number) AS laps FROM b_pit GROUP BY ALL",
)
register(
    "a11_list_distinct", lambda t: ordered_list_text(t.table("part"), ["p_brand"], "p_type", "kinds", distinct=True),
    "SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS kinds FROM part GROUP BY 1",
)
register(
    "a10_list_long", lambda t: ordered_entries(t["pit"], p.CAR, "lap_number", "place", "n"),
    """SELECT session_key, driver_number, lap_number, row_number() OVER (PARTITION BY session_key, driver_number ORDER BY lap_number) AS place, n
       FROM (SELECT session_key, driver_number, lap_number, count(*) AS n FROM b_pit WHERE lap_number IS NOT NULL GROUP BY ALL)""",
)
register(
    "a11_list_long", lambda t: ordered_entries(t.table("part"), ["p_brand"], "p_type", "place", "n").drop("n"),
    "SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY p_type) AS place FROM (SELECT DISTINCT p_brand, p_type FROM part)",
)
register(
    "a12_array_distinct", lambda t: t["drivers"].groupBy("session_key").agg(F.sort_array(F.collect_set("team_name")).alias("teams")),
    "SELECT session_key, array_to_string(list_sort(array_agg(DISTINCT team_name)), '|') AS teams FROM b_drivers GROUP BY 1",
)
register(
    "a13_boolean_max", lambda t: t["weather"].groupBy("session_key", F.to_date("date").alias("day")).agg(F.max(fx.bool_int(F.col("rainfall"))).alias("wet")),
    "SELECT session_key, CAST(CAST(date AS DATE) AS VARCHAR) AS day, max(CASE WHEN rainfall THEN 1 ELSE 0 END) AS wet FROM b_weather GROUP BY ALL",
)
grouped(
    "a14_max_of_greatest", "l_suppkey", r("max(greatest(CASE WHEN l_quantity > 20 THEN l_quantity ELSE 0 END, l_tax * 300))", "top"),
    lambda: dict(top=F.max(F.greatest(fx.or_zero(some_col()), F.col("l_tax") * 300))),
)


@query(
    "a15_two_level",
    f"SELECT l_returnflag, {r('avg(mean)', 'mean_of_means')}, {r('max(hi)', 'hi')}, CAST(sum(n) AS BIGINT) AS n FROM (SELECT l_returnflag, l_suppkey, avg(l_quantity) AS mean, max(l_quantity) AS hi, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1",
)
def _(t):
    inner = t.table("lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.avg(F.col("l_quantity")).alias("mean"), F.max(F.col("l_quantity")).alias("hi"), F.count("*").alias("n"))
    return inner.groupBy("l_returnflag").agg(F.avg("mean").alias("mean_of_means"), F.max("hi").alias("hi"), F.sum("n").alias("n"))


@query(
    "a16_categorised",
    f"""SELECT *, CASE WHEN longest >= 2 AND mean > 1.5 THEN 'Long' WHEN mean > 1.2 THEN 'Mixed' ELSE 'Short' END AS kind FROM (
        SELECT session_key, compound, {r('avg(lap_end - lap_start + 1)', 'mean')}, max(lap_end - lap_start + 1) AS longest FROM b_stints GROUP BY ALL)""",
)
def _(t):
    length = fx.stint_length(F.col("lap_start"), F.col("lap_end"))
    out = t["stints"].groupBy("session_key", "compound").agg(F.avg(length).alias("mean"), F.max(length).alias("longest"))
    kind = F.when((F.col("longest") >= 2) & (F.col("mean") > 1.5), "Long").when(F.col("mean") > 1.2, "Mixed").otherwise("Short")
    return out.withColumn("kind", kind)


grouped(
    "a17_group_keys", "l_returnflag l_linestatus l_linenumber", f"{r('sum(l_quantity)', 'total')}",
    lambda: dict(total=F.sum(F.col("l_quantity"))),
)
register(
    "a18_text_extremes", lambda t: t["intervals"].groupBy("session_key", "driver_number").agg(F.min("gap_to_leader").alias("lo"), F.max("gap_to_leader").alias("hi")),
    "SELECT session_key, driver_number, min(gap_to_leader) AS lo, max(gap_to_leader) AS hi FROM b_intervals GROUP BY ALL",
)
register(
    "a19_max_numeric_gap", lambda t: t["intervals"].groupBy("session_key", "driver_number").agg(F.max(fx.numeric_gap(F.col("gap_to_leader"))).alias("gap")),
    f"SELECT session_key, driver_number, {r('max(TRY_CAST(gap_to_leader AS DOUBLE))', 'gap')} FROM b_intervals GROUP BY ALL",
)


@query(
    "a20_zero_for_missing",
    "SELECT d.session_key, d.driver_number, coalesce(n, 0) AS stops FROM b_drivers d LEFT JOIN (SELECT session_key, driver_number, count(*) AS n FROM b_pit GROUP BY ALL) USING (session_key, driver_number)",
)
def _(t):
    return t["drivers"].select(*p.CAR).join(p.pit_stops(t), p.CAR, "left").select(*p.CAR, fx.or_zero(F.col("pit_stop_count")).alias("stops"))


@query(
    "a21_session_totals",
    f"""SELECT session_key, count(DISTINCT driver_number) AS drivers, CAST(sum(n) AS BIGINT) AS laps, {r('min(best)', 'best')}, {r('avg(w)', 'track')} FROM (
        SELECT session_key, driver_number, count(*) AS n, min(lap_duration) AS best FROM b_laps GROUP BY ALL)
        LEFT JOIN (SELECT session_key, avg(track_temperature) AS w FROM b_weather GROUP BY 1) USING (session_key) GROUP BY 1""",
)
def _(t):
    cars = t["laps"].groupBy(*p.CAR).agg(F.count("*").alias("n"), F.min("lap_duration").alias("best"))
    cars = cars.groupBy("session_key").agg(F.count_distinct("driver_number").alias("drivers"), F.sum("n").alias("laps"), F.min("best").alias("best"))
    return cars.join(t["weather"].groupBy("session_key").agg(F.avg("track_temperature").alias("track")), "session_key", "left")


# --- the two quirks of the source that `compat` reproduces --------------------------------------------------

register(
    "a18_race_history_text_gaps", lambda t: p.race_history(t, Settings(compat=True)).select(*p.LAP, "min_gap_to_leader", "max_gap_to_next"),
    """SELECT l.session_key, l.driver_number, l.lap_number, min(i.gap_to_leader) AS min_gap_to_leader, max(i.gap_to_next) AS max_gap_to_next FROM p_laps l
       LEFT JOIN p_intervals i ON i.session_key = l.session_key AND i.driver_number = l.driver_number AND date_trunc('second', i.date) BETWEEN l.date_start AND l.date_end GROUP BY ALL""",
)
register(
    "j15_race_summary_fan_out", lambda t: p.race_summary(t, Settings(compat=True)).select("session_key", "total_teams", "total_pit_stops", "average_speed"),
    f"""SELECT session_key, count(DISTINCT team_name) AS total_teams, CAST(sum(stops) AS BIGINT) AS total_pit_stops, {r('avg(mean)', 'average_speed')}
        FROM (SELECT session_key, team_name, sum(pit_stop_count) AS stops FROM p_leaderboard GROUP BY ALL)
        JOIN (SELECT session_key, driver_number, avg(speed) AS mean FROM p_car_data GROUP BY ALL) USING (session_key) GROUP BY 1""",
)

# --- unions and reshaping ----------------------------------------------------------------------------------

register(
    "u01_union_all",
    lambda t: append_all([t.table("lineitem").filter(open_).select("l_orderkey", "l_linenumber", "l_partkey", F.lit(name).alias("part")) for name, open_ in (("open", F.col("l_linestatus") == "O"), ("rest", ~F.col("l_linestatus").eqNullSafe("O")))]),
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linestatus = 'O' THEN 'open' ELSE 'rest' END AS part FROM lineitem",
)
register(
    "u02_wide_to_long",
    lambda t: sectors_long(t.table("lineitem"), ["l_orderkey", "l_partkey"], ["l_quantity", "l_discount", "l_tax"], "sector_number", "seconds"),
    " UNION ALL ".join(f"SELECT l_orderkey, l_partkey, {i} AS sector_number, {r(c, 'seconds')} FROM lineitem" for i, c in enumerate(("l_quantity", "l_discount", "l_tax"), 1)),
)
register(
    "u03_append_chunks",
    lambda t: append_all([t.events().filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part).select("event_id", "ts") for part in range(3)]),
    "SELECT event_id, ts FROM events",
)
